"""Registered queries: each a Spark plan with an independent SQL text."""

from __future__ import annotations

from importlib import import_module

MODULES = ["metering_queries", "rating_queries", "invoice_queries", "control_queries", "stream_queries"]


def load():
    """(queries, SQL texts) of all query modules."""
    for name in MODULES:
        import_module(f"tallymark.plans.{name}")
    from tallymark.plans import registry

    return registry.QUERIES, registry.ORACLES
