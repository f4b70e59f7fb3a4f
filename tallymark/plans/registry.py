"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.operators.scans import numbered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with SQL that gives the same rows."""

    def register(function):
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def placed(ordered: DataFrame, name: str = "place", few: bool = False) -> DataFrame:
    """An ordered table with the place of each row, as it comes out, so that its order is compared as well.

    ``few`` says that a limit bounds the rows, which are then numbered in one task.
    """
    if not few:
        return numbered(ordered, name)
    counted = ordered.withColumn(name, F.monotonically_increasing_id())
    return counted.withColumn(name, F.row_number().over(Window.orderBy(name)))


def ts(column, name: str | None = None) -> Column:
    """Timestamp as text, so that both engines print the same."""
    column = F.col(column) if isinstance(column, str) else column
    out = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return out.alias(name) if name else out


def ts_sql(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def iso_sql(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def money(column, name: str | None = None) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    out = column.cast("decimal(18,2)")
    return out.alias(name) if name else out


def id_sql(*columns: str) -> str:
    """SQL for the ids made by ``stable_id``."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"sha256(concat_ws('|', {parts}))"
