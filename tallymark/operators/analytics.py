"""Searches, lists and revenue reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.functions import values as V
from tallymark.operators.skew import keyed_join

REVENUE = "decimal(18,2)"


def search_events(events: DataFrame, customer_id=None, event_type: str | None = None, limit: int = 100) -> DataFrame:
    """Newest events first, optionally of one customer and one type."""
    found = _matching(events, customer_id, event_type)
    return found.orderBy(F.col("event_time").desc(), F.col("event_id").asc()).limit(limit)


def search_count(events: DataFrame, customer_id=None, event_type: str | None = None, limit: int = 100) -> DataFrame:
    """Number of events a search returns."""
    return _matching(events, customer_id, event_type).limit(limit).agg(F.count(F.lit(1)).alias("count"))


def _matching(events: DataFrame, customer_id, event_type) -> DataFrame:
    if customer_id is not None:
        events = events.filter(F.col("customer_id") == customer_id)
    if event_type:
        events = events.filter(F.col("event_type") == event_type)
    return events


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    """One row by key."""
    return table.filter(F.col(key) == value)


def lookup_many(table: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows found, ids not found)."""
    asked = ids.select(key).distinct()
    return table.join(asked, key, "left_semi"), asked.join(table.select(key), key, "left_anti")


def newest_first(table: DataFrame, time: str, key: str) -> DataFrame:
    return table.orderBy(F.col(time).desc_nulls_first(), F.col(key).asc())


def oldest_first(table: DataFrame, time: str, key: str) -> DataFrame:
    return table.orderBy(F.col(time).asc_nulls_last(), F.col(key).asc())


def monthly_revenue(invoices: DataFrame, months: int | None = None, as_of=None, by_currency: bool = False) -> DataFrame:
    """Billed totals per month of the period start; all months unless ``months`` is given."""
    billed = invoices.filter(F.col("status").isin(settings.BILLED_STATUSES))
    if months is not None:
        first = F.add_months(F.date_trunc("month", V.moment(as_of)), -(months - 1))
        billed = billed.filter(F.col("billing_period_start") >= first)
    keys = [V.month_key("billing_period_start").alias("month")] + (["currency"] if by_currency else [])
    return (
        billed.groupBy(*keys)
        .agg(
            F.sum("total").cast(REVENUE).alias("total_revenue"),
            F.sum("subtotal").cast(REVENUE).alias("subtotal_revenue"),
            F.sum("tax").cast(REVENUE).alias("total_tax"),
        )
        .orderBy("month")
    )


def revenue_by_metric(lines: DataFrame) -> DataFrame:
    """Line amounts and quantities per metric, whatever the invoice status."""
    return (
        lines.groupBy("metric_type")
        .agg(
            F.sum("amount").cast(REVENUE).alias("revenue"),
            F.sum("quantity").cast("decimal(28,6)").alias("total_quantity"),
        )
        .orderBy(F.col("revenue").desc(), "metric_type")
    )


def top_customers(invoices: DataFrame, n: int = 10) -> DataFrame:
    """Customers with the highest billed total."""
    return (
        invoices.filter(F.col("status").isin(settings.BILLED_STATUSES))
        .groupBy("customer_id")
        .agg(F.sum("total").cast(REVENUE).alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), F.col("customer_id").asc())
        .limit(n)
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, t in tables.items()]
    out = counts[0]
    for count in counts[1:]:
        out = out.unionByName(count)
    return out


def events_per_window(events: DataFrame, size: str = settings.WINDOW_SIZE, sample: int = 3) -> DataFrame:
    """Events per window with the ids of its first few events.

    The rank filter keeps only ``sample`` rows per window and task before the shuffle.
    """
    start = V.window_start("event_time", size)
    counts = events.groupBy(start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("event_time").alias("first_event_at"),
        F.max("event_time").alias("last_event_at"),
    )
    keyed = events.select(start.alias("window_start"), "event_time", "event_id")
    firsts = first_rows(keyed, ["window_start"], ["event_time", "event_id"], sample)
    listed = firsts.groupBy("window_start").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("event_time", "event_id"))), lambda e: e["event_id"].cast("string")
            ),
            ",",
        ).alias("first_events")
    )
    return counts.join(listed, "window_start")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Up to ``n`` rows per key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def monthly_usage(usage: DataFrame) -> DataFrame:
    """Final usage per customer, metric and month."""
    return (
        usage.filter("is_final")
        .groupBy("customer_id", "metric_type", F.date_trunc("month", "window_start").alias("month"))
        .agg(
            F.sum("value").cast("decimal(28,6)").alias("total_usage"),
            F.count(F.lit(1)).alias("aggregation_count"),
            F.max("window_end").alias("last_window_end"),
        )
    )


def usage_of_customer(usage: DataFrame, customer_id) -> DataFrame:
    return usage.filter(F.col("customer_id") == customer_id)


def charges_of_customer(charges: DataFrame, customer_id) -> DataFrame:
    return charges.filter(F.col("customer_id") == customer_id)


def charges_of_invoices(line_items: DataFrame, line_charges: DataFrame, charges: DataFrame, **limits) -> DataFrame:
    """Charges with the invoice and line they appear on."""
    lines = line_items.select("line_item_id", "invoice_id", "line_number")
    placed = keyed_join(line_charges, lines, ["line_item_id"], ["charge_id"], "inner", small=False, **limits)
    return charges.join(placed, "charge_id")
