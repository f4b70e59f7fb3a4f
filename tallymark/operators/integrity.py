"""Stored-table rules as queries for violating rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tallymark.operators.skew import keyed_join
from tallymark.session import materialise


VIOLATION = ["rule", "row_key"]
#: A task that counts the values of a unique key takes about this many rows.
ROWS_PER_PART = 500_000


@dataclass(frozen=True)
class Rules:
    """What a table must satisfy.

    ``checks``   {name: SQL predicate}, null counts as satisfied
    ``unique``   {name: (columns, SQL filter or None)}
    ``references`` {name: (column, other table, its key)}
    """

    key: str
    checks: dict[str, str] = field(default_factory=dict)
    unique: dict[str, tuple[list[str], str | None]] = field(default_factory=dict)
    references: dict[str, tuple[str, str, str]] = field(default_factory=dict)


RULES: dict[str, Rules] = {
    "customers": Rules(
        "customer_id",
        {"customer_status": "status IN ('active', 'suspended', 'cancelled')"},
        {"customer_key": (["customer_id"], None), "customer_external_id": (["external_id"], "external_id IS NOT NULL")},
    ),
    "telemetry_events": Rules(
        "event_id",
        {"event_time": "event_time <= ingestion_time + INTERVAL 1 DAY"},
        {"event_key": (["event_id"], None)},
    ),
    "aggregated_usage": Rules(
        "aggregation_id",
        {"window_order": "window_start < window_end", "positive_value": "value >= 0"},
        {
            "usage_key": (["aggregation_id"], None),
            "usage_window": (["customer_id", "metric_type", "window_start", "window_end"], "rerating_job_id IS NULL"),
        },
    ),
    "price_books": Rules(
        "price_book_id",
        {"effective_dates": "effective_until IS NULL OR effective_from < effective_until"},
        {"book_key": (["price_book_id"], None), "version_start": (["parent_id", "effective_from"], "parent_id IS NOT NULL")},
        {"book_parent": ("parent_id", "price_books", "price_book_id")},
    ),
    "price_rules": Rules(
        "rule_id",
        {"pricing_model": "pricing_model IN ('flat', 'per_unit', 'tiered', 'volume', 'committed')"},
        {"rule_key": (["rule_id"], None), "rule_metric": (["price_book_id", "metric_type"], None)},
        {"rule_book": ("price_book_id", "price_books", "price_book_id")},
    ),
    "rated_charges": Rules(
        "charge_id",
        {"positive_subtotal": "subtotal >= 0"},
        {"charge_key": (["charge_id"], None)},
        {
            "charge_usage": ("aggregation_id", "aggregated_usage", "aggregation_id"),
            "charge_book": ("price_book_id", "price_books", "price_book_id"),
            "charge_rule": ("rule_id", "price_rules", "rule_id"),
            "charge_superseded": ("supersedes_charge_id", "rated_charges", "charge_id"),
        },
    ),
    "invoices": Rules(
        "invoice_id",
        {
            "billing_period": "billing_period_start < billing_period_end",
            "invoice_type": "invoice_type IN ('standard', 'correction', 'credit_memo')",
            "invoice_status": "status IN ('draft', 'issued', 'paid', 'void', 'overdue')",
        },
        {"invoice_key": (["invoice_id"], None), "invoice_number": (["invoice_number"], None)},
        {"invoice_reference": ("reference_invoice_id", "invoices", "invoice_id")},
    ),
    "invoice_line_items": Rules(
        "line_item_id",
        {"line_number": "line_number > 0"},
        {"line_key": (["line_item_id"], None)},
        {"line_invoice": ("invoice_id", "invoices", "invoice_id")},
    ),
    "invoice_adjustments": Rules(
        "adjustment_id",
        {},
        {"adjustment_key": (["adjustment_id"], None)},
        {
            "adjustment_invoice": ("invoice_id", "invoices", "invoice_id"),
            "adjustment_credit": ("credit_id", "customer_credits", "credit_id"),
        },
    ),
    "customer_credits": Rules(
        "credit_id",
        {"credit_amount": "remaining_amount >= 0 AND remaining_amount <= amount"},
        {"credit_key": (["credit_id"], None)},
        {"credit_customer": ("customer_id", "customers", "customer_id")},
    ),
}


def violations(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, row_key) of every violation in one table.

    References are checked against the tables given; others are left out.  Checks and
    references are judged in one pass over the rows; each unique key is one aggregate, over
    as many parts as the table needs.
    """
    rules, table = RULES[name], tables[name]
    references = {rule: r for rule, r in rules.references.items() if r[1] in tables}
    row_key = F.col(rules.key).cast("string").alias("row_key")
    found = []
    if rules.checks:
        # One pass for all checks of a row.
        failed = F.array_compact(F.array(*[F.when(F.expr(f"NOT ({check})"), F.lit(rule)) for rule, check in rules.checks.items()]))
        found.append(table.select(F.explode(failed).alias("rule"), row_key))
    if references:
        found.append(_dangling(table, references, tables, row_key))
    parts = -(-table.count() // ROWS_PER_PART) if rules.unique else 0
    for rule, (columns, only) in rules.unique.items():
        found.append(
            _repeated(table.filter(only) if only else table, columns, parts).select(
                F.lit(rule).alias("rule"), F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("row_key")
            )
        )
    return reduce(DataFrame.unionByName, found)


def _repeated(table: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Values of ``columns`` in more than one row, by tasks of bounded size.

    Parts of an aggregate are merged by bytes, and values that pack well may all end in a few
    tasks.  So the rows of a large table are dealt into a given number of parts, and counted
    twice: by value and a hash of the row, which splits values in very many rows, then by value.
    """
    if parts <= 1:
        return table.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    nested = (ArrayType, MapType, StructType, VariantType)
    place = F.pmod(F.xxhash64(*[f.name for f in table.schema.fields if not isinstance(f.dataType, nested)]), F.lit(parts))
    dealt = table.select(*columns, place.alias("_place")).repartition(parts, *columns, "_place")
    some = dealt.groupBy(*columns, "_place").agg(F.count(F.lit(1)).alias("n"))
    return some.repartition(parts, *columns).groupBy(*columns).agg(F.sum("n").alias("n")).filter("n > 1")


def _dangling(table: DataFrame, references: dict, tables: dict[str, DataFrame], row_key: Column) -> DataFrame:
    """(rule, row_key) of the references to rows that are not there, for all references in one join.

    Values are made distinct first, so a value in very many rows is one row of the join, and
    rows without a reference take no part.  Only values that are missing meet the table again.
    """
    named = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("value")) for rule, (column, _, _) in references.items()])
    given = F.explode(F.filter(named, lambda r: r["value"].isNotNull())).alias("r")
    there = [tables[other].select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("value")) for rule, (_, other, key) in references.items()]
    values = table.select(given).select("r.rule", "r.value").distinct()
    missing = materialise(values.join(reduce(DataFrame.unionByName, there), ["rule", "value"], "left_anti"))
    rows = table.select(row_key, given).select("r.rule", "r.value", "row_key")
    return keyed_join(rows, missing, ["rule", "value"], ["row_key"], "inner").select("rule", "row_key")


def violation_counts(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    return violations(name, tables).groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
