"""Only usage whose price changed is rated again; the rest would have come out the same."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import rating, rerating
from tallymark.schemas import TIERS


def rules_of(spark, rows):
    listed = [(r, b, m, model, "count", json.dumps([{"tier": i + 1, "upTo": u, "unitPrice": p, "flatFee": f} for i, (u, p, f) in enumerate(tiers)])) for r, b, m, model, tiers in rows]
    table = spark.createDataFrame(listed, "rule_id string, price_book_id string, metric_type string, pricing_model string, unit string, tiers string")
    return table.withColumn("tiers", F.from_json("tiers", TIERS))


def books_of(spark, rows):
    day = lambda c: F.timestamp_micros(F.col(c) * 86_400_000_000)
    table = spark.createDataFrame(rows, "price_book_id string, a long, b long")
    return table.select("price_book_id", F.col("price_book_id").alias("version"), day("a").alias("effective_from"), day("b").alias("effective_until"))


def usage_of(spark):
    rng = random.Random(2)
    rows = [(f"u{n}", rng.choice(["api", "band", "peak", "other"]), str(rng.choice([0, 1, 5, 9.5, 10, 10.000001, 12, 49, 50, 51, 99, 500])), rng.randrange(0, 40)) for n in range(600)]
    rows += [("null", "api", None, 5), ("undated", "api", "3", None)]
    table = spark.createDataFrame(rows, "aggregation_id string, metric_type string, q string, d long")
    return table.select(
        F.lit("c").alias("customer_id"), "metric_type", F.col("q").cast("decimal(20,6)").alias("quantity"),
        F.timestamp_micros(F.col("d") * 86_400_000_000).alias("effective_date"), "aggregation_id", F.lit(None).cast("string").alias("source_event_id"),
    )


BOOKS = [("a", 0, 20), ("b", 20, None), ("promo", 10, 12)]
RULES = [
    ("a1", "a", "api", "tiered", [(10, 0.10, 0), (50, 0.08, 1.0), (None, 0.05, 0)]),
    ("a2", "a", "band", "volume", [(10, 0.5, 0), (50, 0.4, 2.0)]),
    ("a3", "a", "peak", "flat", [(None, 3.5, 0)]),
    ("b1", "b", "api", "tiered", [(10, 0.10, 0), (50, 0.08, 1.0), (None, 0.05, 0)]),
    ("b2", "b", "band", "committed", [(10, 0.5, 0), (None, 0.75, 0)]),
    ("p1", "promo", "api", "per_unit", [(None, 0.01, 0)]),
]


def replaced(rule, tiers):
    return [(r, b, m, model, tiers if r == rule else t) for r, b, m, model, t in RULES]


CASES = {
    "one tier": (BOOKS, replaced("a1", [(10, 0.10, 0), (50, 0.07, 1.0), (None, 0.05, 0)])),
    "a limit": (BOOKS, replaced("a2", [(12, 0.5, 0), (50, 0.4, 2.0)])),
    "a tier cut in two": (BOOKS, replaced("a2", [(5, 0.5, 0), (10, 0.5, 0), (50, 0.4, 2.0)])),
    "a rule gone": (BOOKS, [r for r in RULES if r[0] != "a3"]),
    "a book moved": ([("a", 0, 25), ("b", 25, None), ("promo", 10, 12)], RULES),
    "an unusable rule": (BOOKS, [(*r[:3], "custom", r[4]) if r[0] == "a3" else r for r in RULES]),
    "no books": ([("z", 900, 901)], RULES),
}
# Where only some prices change, a few of the usage rows are rated.
FEW = {"one tier": 60, "a limit": 23, "a tier cut in two": 0}


@pytest.mark.parametrize(("name", "lookup"), [*((n, "book_first") for n in sorted(CASES)), ("one tier", "rule_first")])
def test_the_same_differences_as_rating_everything(spark, name, lookup):
    options = rating.RatingOptions(lookup=lookup, trail=False, committed_mode="overage" if lookup == "rule_first" else "per_unit")
    old = books_of(spark, BOOKS), rules_of(spark, RULES)
    new = books_of(spark, CASES[name][0]), rules_of(spark, CASES[name][1])
    usage = usage_of(spark).cache()
    at = F.lit("2024-01-01").cast("timestamp")
    stored, all_new = (rating.rate(usage, *side, at, options)[0] for side in (old, new))
    want = {(r.aggregation_id, r.difference) for r in rerating.charge_differences(stored, all_new).collect()}
    changed = rerating.changed_usage(usage, rerating.price_changes(old, new, options)).cache()
    _, differences = rerating.rerate(changed, stored, *new, at, options)
    assert {(r.aggregation_id, r.difference) for r in differences.collect()} == want
    assert bool(want) == (name != "a tier cut in two")
    assert changed.count() <= FEW.get(name, 600)
    if name != "a limit":
        return
    # Shuffled instead of broadcast, with a metric that is split over tasks.
    spread = rerating.changed_usage(usage, rerating.price_changes(old, new, options), broadcast_rows=0, rows_per_task=20)
    assert spread.count() == changed.count()
