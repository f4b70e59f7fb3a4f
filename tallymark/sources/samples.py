"""Sample reference data and events for trying things out."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import values as V
from tallymark.schemas import TIERS

CUSTOMERS = [
    ("harbour", "H-17", "North Harbour Weather", "ledger@northharbour.example", "USD", "monthly"),
    ("orchard", "O-04", "Orchard Maps", "bills@orchardmaps.example", "USD", "monthly"),
    ("quarry", "Q-92", "Quarry Street Robotics", "payables@quarrystreet.example", "USD", "quarterly"),
]
EFFECTIVE_FROM = "2024-01-01 00:00:00"
BOOKS = [
    ("list", "List prices", "One price per unit of each metric"),
    ("graded", "Graded prices", "Cheaper units from each limit on"),
    ("agreed", "Agreed prices", "Prices of a yearly agreement"),
]
UNITS = {"api_call": "count", "storage_gb_hours": "gb_hours", "compute_hours": "hours"}
# book -> metric -> [(up to, unit price)]; one tier is a flat price.
PRICES = {
    "list": {"api_call": [(None, 0.02)], "storage_gb_hours": [(None, 0.1)], "compute_hours": [(None, 0.5)]},
    "graded": {
        "api_call": [(1000, 0.02), (10000, 0.015), (100000, 0.01), (None, 0.005)],
        "storage_gb_hours": [(1000, 0.1), (10000, 0.08), (None, 0.05)],
        "compute_hours": [(100, 0.5), (1000, 0.4), (None, 0.3)],
    },
    "agreed": {"api_call": [(None, 0.01)], "storage_gb_hours": [(None, 0.06)], "compute_hours": [(None, 0.35)]},
}


def sample_customers(spark: SparkSession) -> DataFrame:
    names = "customer_id string, external_id string, name string, email string, billing_currency string, billing_cycle string"
    return spark.createDataFrame(CUSTOMERS, names).withColumns(
        {"status": F.lit("active"), "tax_region": F.lit(None).cast("string"), "created_at": F.lit(EFFECTIVE_FROM).cast("timestamp")}
    )


def sample_books(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOOKS, "price_book_id string, name string, description string").withColumns(
        {
            "parent_id": F.lit(None).cast("string"),
            "version": F.lit("v1"),
            "effective_from": F.lit(EFFECTIVE_FROM).cast("timestamp"),
            "effective_until": F.lit(None).cast("timestamp"),
            "currency": F.lit("USD"),
            "created_at": F.lit(EFFECTIVE_FROM).cast("timestamp"),
        }
    )


def sample_rules(spark: SparkSession) -> DataFrame:
    rows = []
    for book, metrics in PRICES.items():
        for metric, tiers in metrics.items():
            steps = [{"tier": i + 1, "upTo": up_to, "unitPrice": price, "flatFee": 0} for i, (up_to, price) in enumerate(tiers)]
            rows.append((f"{book}-{metric}", book, metric, "flat" if len(tiers) == 1 else "tiered", UNITS[metric], json.dumps(steps)))
    names = "rule_id string, price_book_id string, metric_type string, pricing_model string, unit string, tiers string"
    return spark.createDataFrame(rows, names).withColumn("tiers", F.from_json("tiers", TIERS))


def sample_events(spark: SparkSession, as_of, customer_id: str = "harbour", per_window: int = 5) -> DataFrame:
    """Events in the three hours up to ``as_of``, plus one from the hour before."""
    count = 3 * per_window
    hour = (F.col("id") / per_window).cast("int")
    minute = (F.col("id") % per_window) * F.lit(60 // per_window)
    this_hour = F.date_trunc("hour", V.moment(as_of))
    inside = this_hour - F.make_dt_interval(hours=2 - hour, mins=-minute.cast("int"))
    return spark.range(count + 1).select(
        F.concat(F.lit("evt-"), F.col("id").cast("string")).alias("event_id"),
        F.lit("api_call").alias("event_type"),
        F.lit("api_call").alias("metric_type"),
        F.lit(customer_id).alias("customer_id"),
        F.when(F.col("id") < count, inside).otherwise(this_hour - F.expr("interval 3 hours")).alias("event_time"),
        F.lit('{"path":"/tides","cached":false}').alias("metadata"),
    )
