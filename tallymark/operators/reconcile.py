"""Do events, usage, charges, invoices and ledger agree?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.functions import values as V
from tallymark.operators.agreement import differences  # noqa: F401
from tallymark.operators.skew import keyed_join

MONEY = "decimal(18,2)"


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def events_to_usage(events: DataFrame, usage: DataFrame, size: str = settings.WINDOW_SIZE) -> DataFrame:
    """Event counts per customer, metric and window against the stored windows."""
    keys = ["customer_id", "metric_type", "window_start"]
    counted = events.groupBy("customer_id", "metric_type", V.window_start("event_time", size).alias("window_start")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    stored = usage.groupBy(*keys).agg(F.sum("event_count").alias("usage_count"), F.count(F.lit(1)).alias("window_rows"))
    status = (
        F.when(F.col("usage_count").isNull(), "missing_aggregation")
        .when(F.col("event_count").isNull(), "extra_aggregation")
        .when(F.col("window_rows") > 1, "extra_aggregation")
        .when(F.col("event_count") != F.col("usage_count"), "count_mismatch")
        .otherwise("match")
    )
    return counted.join(stored, keys, "full_outer").withColumn("status", status)


def usage_to_charges(usage: DataFrame, charges: DataFrame) -> DataFrame:
    """Final windows against charges that are not replacements."""
    final = usage.filter("is_final").select("aggregation_id", F.col("value").alias("used"))
    rated = (
        charges.filter(F.col("supersedes_charge_id").isNull() & F.col("aggregation_id").isNotNull())
        .groupBy("aggregation_id")
        .agg(F.sum("quantity").cast("decimal(28,6)").alias("charged"), F.count(F.lit(1)).alias("charge_count"))
    )
    status = (
        F.when(F.col("charged").isNull(), "missing_charge")
        .when(F.col("used").isNull() | (F.col("charge_count") > 1), "extra_charge")
        .when(F.col("used") != F.col("charged"), "quantity_mismatch")
        .otherwise("match")
    )
    return final.join(rated, "aggregation_id", "full_outer").withColumn("status", status)


def charges_to_invoices(charges: DataFrame, invoices: DataFrame) -> DataFrame:
    """Charge sums per customer and month against invoices that are not void."""
    charged = charges.groupBy("customer_id", V.month_key("calculated_at").alias("month")).agg(
        F.sum("subtotal").cast(MONEY).alias("charged")
    )
    billed = (
        invoices.filter(F.col("status") != "void")
        .groupBy("customer_id", V.month_key("billing_period_start").alias("month"))
        .agg(F.sum("subtotal").cast(MONEY).alias("invoiced"), F.count(F.lit(1)).alias("invoice_count"))
    )
    status = (
        F.when(F.col("invoice_count").isNull(), "no_invoice")
        .when(F.col("charged").isNull(), "no_charges")
        .when(F.col("charged") == F.col("invoiced"), "match")
        .when(F.col("invoice_count") > 1, "multiple_invoices")
        .otherwise("total_mismatch")
    )
    return charged.join(billed, ["customer_id", "month"], "full_outer").withColumn("status", status)


def invoices_to_ledger(invoices: DataFrame, ledger: DataFrame, account: str = "revenue") -> DataFrame:
    """Billed totals per issue month against revenue entries."""
    billed = (
        invoices.filter(F.col("status").isin(settings.BILLED_STATUSES))
        .groupBy(V.month_key("issued_at").alias("month"))
        .agg(F.sum("total").cast(MONEY).alias("total_invoiced"))
    )
    booked = (
        ledger.filter(F.col("account") == account)
        .groupBy(V.month_key("transaction_date").alias("month"))
        .agg(F.sum("amount").cast(MONEY).alias("total_revenue"))
    )
    difference = (_zero("total_invoiced") - _zero("total_revenue")).cast(MONEY)
    return (
        billed.join(booked, "month", "full_outer")
        .withColumn("difference", difference)
        .withColumn("status", F.when(F.col("difference") == 0, "tied").otherwise("discrepancy"))
    )


def daily_event_report(events: DataFrame, usage: DataFrame) -> DataFrame:
    """Events received and aggregated per day of the event."""
    received = events.groupBy(F.to_date("event_time").alias("day")).agg(F.count(F.lit(1)).alias("events_ingested"))
    processed = usage.groupBy(F.to_date("window_start").alias("day")).agg(
        F.sum("event_count").alias("events_processed"),
        F.count(F.lit(1)).alias("aggregations_created"),
        F.count_if("is_final").alias("aggregations_finalized"),
    )
    joined = received.join(processed, "day", "full_outer").fillna(
        0, ["events_ingested", "events_processed", "aggregations_created", "aggregations_finalized"]
    )
    missing = F.greatest(F.col("events_ingested") - F.col("events_processed"), F.lit(0))
    clean = F.col("events_ingested") == F.col("events_processed")
    return joined.withColumns(
        {"missing_events": missing, "status": F.when(clean, "clean").otherwise("discrepancies")}
    )


def monthly_invoice_report(charges: DataFrame, invoices: DataFrame) -> DataFrame:
    """Charges and invoices per month; balanced below one cent."""
    charged = charges.groupBy(V.month_key("calculated_at").alias("month")).agg(
        F.sum("subtotal").cast(MONEY).alias("total_charges")
    )
    billed = (
        invoices.filter(F.col("status") != "void")
        .groupBy(V.month_key("billing_period_start").alias("month"))
        .agg(
            F.sum("subtotal").cast(MONEY).alias("total_invoiced"),
            F.sum("credits_applied").cast(MONEY).alias("total_credits"),
            F.sum("total").cast(MONEY).alias("net_billed"),
            F.count(F.lit(1)).alias("invoice_count"),
            F.countDistinct("customer_id").alias("customer_count"),
        )
    )
    joined = charged.join(billed, "month", "full_outer").fillna(0, ["invoice_count", "customer_count"])
    rounding = F.abs(_zero("total_charges") - _zero("total_invoiced")).cast(MONEY)
    return joined.withColumn("rounding_difference", rounding).withColumn(
        "status", F.when(F.col("rounding_difference") < 0.01, "balanced").otherwise("discrepancies")
    )


def orphan_events(events: DataFrame, usage_events: DataFrame) -> DataFrame:
    """Events that no usage window counted."""
    return events.join(usage_events.select("event_id"), "event_id", "left_anti")


def duplicate_charges(charges: DataFrame) -> DataFrame:
    """Windows charged more than once, with the charge to keep (the newest)."""
    return (
        charges.filter(F.col("supersedes_charge_id").isNull() & F.col("aggregation_id").isNotNull())
        .groupBy("aggregation_id")
        .agg(
            F.count(F.lit(1)).alias("charge_count"),
            F.max(F.struct("calculated_at", "charge_id"))["charge_id"].alias("kept_charge_id"),
        )
        .filter("charge_count > 1")
    )


def charges_to_void(charges: DataFrame) -> DataFrame:
    """All but the newest charge of windows charged more than once."""
    repeated = duplicate_charges(charges)
    counts = repeated.select("aggregation_id", F.col("charge_count").alias("n"))
    originals = charges.filter(F.col("supersedes_charge_id").isNull())
    joined = keyed_join(
        originals, repeated.drop("charge_count"), ["aggregation_id"], ["charge_id"], "inner", small=False, counts=counts
    )
    return joined.filter(F.col("charge_id") != F.col("kept_charge_id")).drop("kept_charge_id")


def quality_metrics(events: DataFrame, as_of, size: str = settings.WINDOW_SIZE, lateness: str = settings.ALLOWED_LATENESS) -> DataFrame:
    """Event count, late share and lag in seconds (mean, maximum, approximate 99th percentile)."""
    late = V.window_start("event_time", size) < V.before(as_of, lateness)
    lag = (F.unix_micros(V.moment(as_of)) - F.unix_micros("event_time")) / 1_000_000
    return events.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(late).alias("late_events"),
        (F.count_if(late) / F.count(F.lit(1))).cast("decimal(9,6)").alias("late_rate"),
        F.max(lag).cast("decimal(18,3)").alias("max_lag_seconds"),
        F.avg(lag).cast("decimal(18,3)").alias("mean_lag_seconds"),
        F.percentile_approx(lag, 0.99, 10000).cast("decimal(18,3)").alias("p99_lag_seconds"),
    )


def alerts(metrics: DataFrame, max_lag_p99: int = 300, max_late_rate: float = 0.01) -> DataFrame:
    return metrics.select(
        (F.col("p99_lag_seconds") > max_lag_p99).alias("lag_alert"),
        (F.col("late_rate") > max_late_rate).alias("late_alert"),
    )


def stuck_watermarks(progress: DataFrame, as_of, limit: str = "30 minutes") -> DataFrame:
    """Partitions whose watermark last moved longer ago than ``limit``.

    ``progress`` has partition, observed_at and watermark.
    """
    moved = progress.groupBy("partition", "watermark").agg(F.min("observed_at").alias("since"))
    latest = moved.groupBy("partition").agg(F.max(F.struct("watermark", "since")).alias("_last"))
    return latest.select("partition", "_last.watermark", "_last.since").filter(F.col("since") < V.before(as_of, limit))


def partition_watermarks(events: DataFrame, partition: Column) -> DataFrame:
    """Latest event time per source partition."""
    return events.groupBy(partition.alias("partition")).agg(F.max("event_time").alias("watermark"))


def global_watermark(events: DataFrame, partition: Column) -> DataFrame:
    """The slowest partition decides."""
    return partition_watermarks(events, partition).agg(
        F.min("watermark").alias("watermark"), F.count(F.lit(1)).alias("partitions")
    )


def is_material(adjustment: Column, invoice_total: Column, amount=1, share: float = 0.001) -> Column:
    """Corrections below one currency unit or 0.1 % of the invoice are absorbed."""
    size = F.abs(adjustment)
    return (size >= F.lit(amount)) & (size >= F.abs(invoice_total) * F.lit(str(share)).cast("decimal(9,6)"))


def correction_balance(corrections: DataFrame, ledger: DataFrame) -> DataFrame:
    """Debits of original and correction against the expected revenue.

    ``corrections`` has invoice_id, reference_invoice_id, total and expected_total;
    ``ledger`` has invoice_id and amount.
    """
    booked = ledger.groupBy(F.col("invoice_id").alias("reference_invoice_id")).agg(
        F.sum("amount").cast(MONEY).alias("original_debit")
    )
    joined = corrections.join(booked, "reference_invoice_id", "left").withColumns(
        {
            "original_debit": _zero("original_debit").cast(MONEY),
            "correction_debit": F.greatest("total", F.lit(0)).cast(MONEY),
            "correction_credit": F.greatest(-F.col("total"), F.lit(0)).cast(MONEY),
        }
    )
    net = F.col("original_debit") + F.col("correction_debit") - F.col("correction_credit")
    return joined.withColumn("discrepancy", (net - F.col("expected_total")).cast(MONEY)).withColumn(
        "is_balanced", F.col("discrepancy") == 0
    )


def conservation(events: DataFrame, usage: DataFrame) -> DataFrame:
    """Is every event counted in exactly one window?"""
    counted = usage.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("counted_events"))
    return (
        events.agg(F.count(F.lit(1)).alias("event_count"))
        .withColumn("counted_events", counted.scalar())
        .withColumn("conserved", F.col("event_count") == F.col("counted_events"))
    )
