"""Rating a period again and comparing with what was charged."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions import values as V
from tallymark.operators.pricebooks import attach_book, price_steps, search
from tallymark.operators.rating import RatingOptions, rate
from tallymark.operators.skew import keyed_join
from tallymark.session import materialise


def in_scope(
    usage: DataFrame,
    start,
    end,
    customers: DataFrame | None = None,
    metrics: list[str] | None = None,
) -> DataFrame:
    """Usage windows of a re-rating job; no customers or metrics means all of them."""
    scope = usage.filter((F.col("window_start") >= V.moment(start)) & (F.col("window_end") <= V.moment(end)))
    if "rerating_job_id" in usage.columns:
        scope = scope.filter(F.col("rerating_job_id").isNull())
    if metrics:
        scope = scope.filter(F.col("metric_type").isin(metrics))
    if customers is not None:
        scope = keyed_join(scope, customers.select("customer_id").distinct(), ["customer_id"], ["aggregation_id"], "inner")
    return scope


def price_changes(old: tuple[DataFrame, DataFrame], new: tuple[DataFrame, DataFrame], options: RatingOptions = RatingOptions()) -> DataFrame:
    """Where two price functions differ, each given as (books, rules).

    A price function is a formula for every metric, time and quantity.  At every date on which
    a book of either side begins or ends, the steps of the book in force then are compared;
    they stay the same up to the next such date.  Returns per metric one sorted array
    ``spans`` of (begins, ranges): from that microsecond on, quantities in the ranges (low,
    high] cost something else; no ranges: nothing changed.  The work is that of the
    catalogues, whatever the usage.
    """
    sides = {"old": old, "new": new}
    dates = _change_dates(sides, options)
    for side, (books, rules) in sides.items():
        keys, versions = [], books
        if options.lookup == "rule_first":
            keys, versions = ["metric_type"], books.join(rules.select("price_book_id", "metric_type"), "price_book_id")
        dated = attach_book(dates, versions, "at", ["metric_type", "at"], keys, options.broadcast_rows, options.rows_per_task)
        listed = _listed_steps(rules, options).withColumnRenamed("steps", f"_{side}")
        dates = dated.join(listed, ["price_book_id", "metric_type"], "left").drop("price_book_id", "price_version")
    spans = F.array_sort(F.collect_list(F.struct(F.unix_micros("at").alias("begins"), _differing_ranges().alias("ranges"))))
    return materialise(dates.groupBy("metric_type").agg(spans.alias("spans")).filter(F.exists("spans", lambda s: F.size(s["ranges"]) > 0)))


def _change_dates(sides: dict, options: RatingOptions) -> DataFrame:
    """(metric_type, at): every date on which a price of the metric can change."""
    found = []
    for books, rules in sides.values():
        ends = F.explode(F.array("effective_from", "effective_until")).alias("at")
        if options.lookup == "rule_first":
            found.append(books.join(rules.select("price_book_id", "metric_type"), "price_book_id").select("metric_type", ends))
        else:
            # A book without a rule for a metric takes its price away as well.
            metrics = [r.select("metric_type") for _, r in sides.values()]
            every = metrics[0].unionByName(metrics[1]).agg(F.collect_set("metric_type").alias("m"))
            found.append(books.select(ends).select(F.explode(every.scalar()).alias("metric_type"), "at"))
    return found[0].unionByName(found[1]).filter(F.col("at").isNotNull()).distinct()


def _listed_steps(rules: DataFrame, options: RatingOptions) -> DataFrame:
    """The price steps of a book and metric as one sorted array of (low, high, formula)."""
    steps = price_steps(rules, options.price_scale, options.flat_mode, options.committed_mode, trail=False)
    parts = ["base", "step_start", "step_price", "step_fee"]
    priced = reduce(and_, [F.col(c).isNotNull() for c in parts])
    graduated = F.col("pricing_model") == "tiered"
    if options.committed_mode == "overage":
        graduated = F.col("pricing_model").isin("tiered", "committed")
    formula = F.when(priced, F.struct(graduated.alias("graduated"), *parts))
    step = F.struct(F.col("quantity_from").alias("low"), F.col("quantity_to").alias("high"), formula.alias("formula"))
    return steps.groupBy("price_book_id", "metric_type").agg(F.array_sort(F.collect_list(step)).alias("steps"))


def _differing_ranges() -> Column:
    """Ranges of quantity in which the steps ``_old`` and ``_new`` have other formulas."""
    none = F.array().cast("array<decimal(20,6)>")
    limits = [F.coalesce(F.col(side)[end], none) for side in ("_old", "_new") for end in ("low", "high")]
    limits = F.array_sort(F.array_distinct(F.array_compact(F.concat(*limits))))
    # One range more than there are limits: from below all to above all.
    open_end = F.array(F.lit(None).cast("decimal(20,6)"))
    ranges = F.zip_with(F.concat(open_end, limits), F.concat(limits, open_end), lambda low, high: F.struct(low.alias("low"), high.alias("high")))

    def formula(steps: str, r: Column) -> Column:
        """That of the step which holds the range; limits of steps are limits of ranges."""
        from_below = lambda s: s["low"].isNull() | F.coalesce(s["low"] <= r["low"], F.lit(False))
        to_above = lambda s: s["high"].isNull() | F.coalesce(s["high"] >= r["high"], F.lit(False))
        return F.get(F.filter(steps, lambda s: from_below(s) & to_above(s)), F.lit(0))["formula"]

    return F.filter(ranges, lambda r: ~formula("_old", r).eqNullSafe(formula("_new", r)))


def changed_usage(usage: DataFrame, changes: DataFrame, **limits) -> DataFrame:
    """The usage whose price differs between the two price functions of ``price_changes``.

    ``usage`` has the columns that ``rate`` takes.  A row finds the span of its date by halving.
    """
    longest = changes.agg(F.max(F.size("spans")).alias("n")).first()["n"] or 0
    row_id = ["customer_id", "effective_date", "aggregation_id", "source_event_id"]
    found = keyed_join(usage, changes.withColumnRenamed("spans", "_spans"), ["metric_type"], row_id, "inner", **limits)
    span = search("_spans", "begins", F.unix_micros("effective_date"), longest.bit_length())
    quantity = F.col("quantity")
    inside = lambda r: (r["low"].isNull() | (quantity > r["low"])) & (r["high"].isNull() | (quantity <= r["high"]))
    return found.filter(F.exists(span["ranges"], inside)).select(*usage.columns)


def rerate(
    changed: DataFrame, stored: DataFrame, books: DataFrame, rules: DataFrame, calculated_at, options: RatingOptions = RatingOptions()
) -> tuple[DataFrame, DataFrame]:
    """(new charges, their differences from the ``stored`` ones) of a re-rating job.

    ``changed`` is the usage whose price is another one (``changed_usage``): only that is
    rated, and of the stored charges only its own are compared.
    """
    limits = {"broadcast_rows": options.broadcast_rows, "rows_per_task": options.rows_per_task}
    rerated, _ = rate(changed, books, rules, calculated_at, options)
    touched = changed.select("aggregation_id").distinct()
    originals = keyed_join(stored, touched, ["aggregation_id"], ["charge_id"], "inner", **limits)
    return rerated, charge_differences(originals, rerated)


def charge_differences(original: DataFrame, rerated: DataFrame) -> DataFrame:
    """Original and new charge of every usage window that differ."""
    old = original.select(
        "aggregation_id", "customer_id", F.col("charge_id").alias("original_charge_id"), F.col("subtotal").alias("original_subtotal")
    )
    new = rerated.select(
        "aggregation_id",
        F.col("customer_id").alias("_customer"),
        F.col("charge_id").alias("rerated_charge_id"),
        F.col("subtotal").alias("rerated_subtotal"),
    )
    zero = F.lit(0)
    joined = old.join(new, "aggregation_id", "full_outer").withColumn("customer_id", F.coalesce("customer_id", "_customer"))
    difference = (F.coalesce("rerated_subtotal", zero) - F.coalesce("original_subtotal", zero)).cast("decimal(18,2)")
    return joined.drop("_customer").withColumn("difference", difference).filter(F.col("difference") != 0)


def superseding_charges(rerated: DataFrame, differences: DataFrame, job_id: str) -> DataFrame:
    """New charges that replace differing ones; the originals are never changed."""
    replaced = differences.filter(F.col("rerated_charge_id").isNotNull()).select(
        F.col("rerated_charge_id").alias("charge_id"), F.col("original_charge_id").alias("_old")
    )
    return (
        rerated.join(replaced, "charge_id")
        .withColumns(
            {
                "charge_id": V.stable_id(F.lit(job_id), "charge_id"),
                "rerating_job_id": F.lit(job_id),
                "supersedes_charge_id": F.col("_old"),
            }
        )
        .drop("_old")
    )


def job_corrections(differences: DataFrame, job_id: str) -> DataFrame:
    """One correction per customer; the same job and customer always give the same key."""
    return (
        differences.groupBy("customer_id")
        .agg(F.sum("difference").cast("decimal(18,2)").alias("adjustment"), F.count(F.lit(1)).alias("changed_charges"))
        .withColumn("rerating_job_id", F.lit(job_id))
        .withColumn("idempotency_key", F.concat_ws(":", F.lit(job_id), F.col("customer_id").cast("string")))
    )


def new_corrections(corrections: DataFrame, stored: DataFrame) -> DataFrame:
    """Corrections not created by an earlier run of the same job."""
    return corrections.join(stored.select("idempotency_key"), "idempotency_key", "left_anti")


def job_result(corrections: DataFrame, job_id: str) -> DataFrame:
    """Counters of a finished job."""
    return corrections.agg(
        F.coalesce(F.sum("changed_charges"), F.lit(0)).alias("charges_created"),
        F.count(F.lit(1)).alias("correction_count"),
        F.coalesce(F.sum("adjustment"), F.lit(0)).cast("decimal(18,2)").alias("total_adjustment_amount"),
    ).withColumn("job_id", F.lit(job_id))
