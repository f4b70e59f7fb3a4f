"""Usage to charges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.functions import values as V
from tallymark.functions.money import plain_number
from tallymark.operators.pricebooks import attach_book, price_lookup, price_steps
from tallymark.operators.skew import at_most, keyed_join
from tallymark.schemas import TIERS_APPLIED as APPLIED
from tallymark.session import materialise


@dataclass(frozen=True)
class RatingOptions:
    """How prices are read.

    ``lookup``          'book_first': one book for all metrics on a date, then its rule;
                        'rule_first': latest book that has a rule for the metric
    ``price_scale``     decimals kept of unit prices before multiplying
    ``flat_mode``       'once' or 'per_unit'
    ``committed_mode``  'per_unit' or 'overage'
    ``trail``           add the calculation trail to every charge
    """

    lookup: str = "book_first"
    price_scale: int = 2
    flat_mode: str = "once"
    committed_mode: str = "per_unit"
    trail: bool = True
    broadcast_rows: int = settings.BROADCAST_ROWS
    rows_per_task: int = settings.ROWS_PER_TASK


def usage_to_rate(usage: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Final usage windows in the shape ``rate`` takes: priced at the window start.

    Usage without an ``is_final`` column counts as final; ``carry`` keeps columns.
    """
    if "is_final" in usage.columns:
        usage = usage.filter("is_final")
    return usage.select(
        "customer_id",
        "metric_type",
        F.col("value").alias("quantity"),
        F.col("window_start").alias("effective_date"),
        "aggregation_id",
        F.lit(None).cast("string").alias("source_event_id"),
        *carry,
    )


def late_events_to_rate(late: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Late events, each its own charge, priced at the event time; ``carry`` keeps columns."""
    return late.select(
        "customer_id",
        "metric_type",
        V.late_value("metadata").alias("quantity"),
        F.col("event_time").alias("effective_date"),
        F.lit(None).cast("string").alias("aggregation_id"),
        F.col("event_id").cast("string").alias("source_event_id"),
        *carry,
    )


def period_usage(usage: DataFrame) -> DataFrame:
    """Usage summed per customer, metric and calendar month, so that tiers cover the month."""
    month = F.date_trunc("month", "window_start")
    return usage.groupBy("customer_id", "metric_type", month.alias("window_start")).agg(
        F.sum("value").cast("decimal(20,6)").alias("value"),
        F.sum("event_count").alias("event_count"),
    ).withColumns(
        {
            "unit": V.unit_of("metric_type"),
            "aggregation_id": V.stable_id("customer_id", "metric_type", V.utc_text("window_start"), F.lit("month")),
        }
    )


def priced(usage: DataFrame, books: DataFrame, rules: DataFrame, options: RatingOptions = RatingOptions()) -> DataFrame:
    """Usage with its price step and amount; ``reason`` says why there is none.

    Two lookups against small sides: the facts are not shuffled.
    """
    row_id = ["customer_id", "metric_type", "effective_date", "aggregation_id", "source_event_id"]
    limits = {"broadcast_rows": options.broadcast_rows, "rows_per_task": options.rows_per_task}
    if options.lookup == "rule_first":
        versions = books.join(rules.select("price_book_id", "metric_type"), "price_book_id")
        dated = attach_book(usage, versions, "effective_date", row_id, ["metric_type"], **limits)
    elif options.lookup == "book_first":
        dated = attach_book(usage, books, "effective_date", row_id, **limits)
    else:
        raise ValueError("lookup must be 'book_first' or 'rule_first'")

    steps = price_steps(rules, options.price_scale, options.flat_mode, options.committed_mode, options.trail)
    stepped = price_lookup(dated, rules, steps, row_id, **limits)
    units = F.col("quantity") - F.col("step_start")
    # Tiers never take a negative number of units.
    graduated = F.col("pricing_model") == "tiered"
    if options.committed_mode == "overage":
        graduated = F.col("pricing_model").isin("tiered", "committed")
    units = F.when(graduated, F.greatest(units, F.lit(0))).otherwise(units).try_cast("decimal(20,6)")
    no_amount = reduce(or_, [F.col(c).isNull() for c in ("base", "step_start", "step_price", "step_fee")])
    return (
        stepped.withColumn("step_units", units)
        .withColumn(
            "step_charge",
            ((F.col("step_price") * F.col("step_units")).try_cast("decimal(18,2)") + F.col("step_fee")).try_cast("decimal(18,2)"),
        )
        # Amounts that are too large become null instead of ending the job.
        .withColumn("subtotal", (F.col("base") + F.col("step_charge")).try_cast("decimal(12,2)").cast("decimal(18,2)"))
        .withColumn(
            "reason",
            F.when(F.col("price_book_id").isNull(), _no_book(options))
            .when(F.col("quantity").isNull(), "CALCULATION_ERROR")
            .when(F.col("rule_id").isNull(), "NO_PRICE_RULE")
            .when(no_amount, "INVALID_PRICE_RULE")
            .when(F.col("subtotal").isNull() | (F.col("subtotal") < 0), "CALCULATION_ERROR"),
        )
    )


def _no_book(options: RatingOptions) -> Column:
    return F.lit("NO_PRICE_BOOK_FOR_DATE" if options.lookup == "book_first" else "NO_PRICE_RULE")


def rate(
    usage: DataFrame,
    books: DataFrame,
    rules: DataFrame,
    calculated_at,
    options: RatingOptions = RatingOptions(),
) -> tuple[DataFrame, DataFrame]:
    """(charges, unrated usage with reason).

    ``usage`` has customer_id, metric_type, quantity, effective_date, aggregation_id
    and source_event_id.  ``calculated_at`` is a time or a column of ``usage``.
    """
    rows = priced(usage.withColumn("calculated_at", V.moment(calculated_at)), books, rules, options)
    charges = rows.filter(F.col("reason").isNull()).select(*_charge_columns(options))
    unrated = rows.filter(F.col("reason").isNotNull()).select(*usage.columns, "price_book_id", "reason")
    return charges, unrated


def _charge_columns(options: RatingOptions) -> list[Column]:
    columns = [
        V.stable_id("customer_id", "metric_type", "aggregation_id", "source_event_id", "rule_id", V.utc_text("effective_date")).alias("charge_id"),
        F.col("customer_id"),
        F.col("metric_type"),
        F.col("aggregation_id"),
        F.col("source_event_id"),
        F.col("price_book_id"),
        F.col("price_version"),
        F.col("rule_id"),
        F.col("quantity").cast("decimal(20,6)").alias("quantity"),
        F.col("unit_price"),
        F.col("subtotal").cast("decimal(12,2)").alias("subtotal"),
        F.lit(settings.DEFAULT_CURRENCY).alias("currency"),
        F.col("effective_date"),
        F.col("calculated_at"),
        F.col("calculated_at").alias("created_at"),
        F.lit(None).cast("string").alias("rerating_job_id"),
        F.lit(None).cast("string").alias("supersedes_charge_id"),
    ]
    return columns + ([calculation_trail(options).alias("calculation_metadata")] if options.trail else [])


def calculation_trail(options: RatingOptions = RatingOptions()) -> Column:
    """How the amount came about: model, formula, tiers used, effective date."""
    model = F.col("pricing_model")
    if options.committed_mode == "per_unit":
        model = F.when(model == "committed", "per_unit").otherwise(model)
    flat = (model == "flat") & F.lit(options.flat_mode == "once")
    volume = model == "volume"
    graduated = F.col("lower_tiers").isNotNull()
    entered = F.col("tier").isNotNull()
    quantity, price, fee = plain_number("quantity"), plain_number("tier_price"), plain_number("step_fee")

    last = F.struct(
        F.col("tier").alias("tier"),
        F.col("step_units").alias("units"),
        F.col("tier_price").alias("unitPrice"),
        F.col("step_fee").alias("flatFee"),
        F.col("step_charge").alias("charge"),
    )
    tiers = F.when(graduated & entered, F.concat("lower_tiers", F.array(last))).when(graduated, F.col("lower_tiers"))
    here = F.concat(F.lit("("), price, F.lit(" × "), plain_number("step_units"), F.lit(" + "), fee, F.lit(")"))
    steps = (
        F.when(~entered, F.col("lower_formula"))
        .when(F.col("lower_formula") == "", here)
        .otherwise(F.concat("lower_formula", F.lit(" + "), here))
    )
    product = F.concat(price, F.lit(" × "), quantity)
    formula = (
        F.when(graduated, steps)
        .when(volume, F.concat(product, F.lit(" + "), fee))
        .when(flat, price)
        .otherwise(product)
    )
    return F.struct(
        model.alias("model"),
        formula.alias("formula"),
        F.when(~flat, quantity).alias("quantity"),
        F.when(~graduated, price).alias("unitPrice"),
        F.when(volume, fee).alias("flatFee"),
        tiers.cast(APPLIED).alias("tiersApplied"),
        V.iso("effective_date").alias("effectiveDate"),
    )


def charges_for_periods(
    charges: DataFrame,
    periods: DataFrame,
    basis: str = "created_at",
    row_id: str = "charge_id",
    **limits,
) -> DataFrame:
    """Charges whose ``basis`` time lies in a billing period, both ends included.

    ``periods`` has customer_id, period_start, period_end and any further columns; they may
    overlap and be of any length.  A period is filed under the one or two slots of time of
    the shortest unit that covers it with so few; a charge asks its own slot of every unit in
    use.  So a charge is compared with the few periods around it, whatever the number of its
    customer's periods, and each pair is met in one slot only.
    """
    # Written out once, since the units in use are asked for before the join.
    filed = materialise(_filed(periods))
    units = sorted(r.unit for r in filed.select(F.col("_slots.unit").alias("unit")).distinct().collect())
    if not units:
        units = [len(V.SLOTS) - 1]
    asked = F.array(*[F.struct(F.lit(u).alias("_unit"), V.slot(basis, V.SLOTS[u]).alias("_slot")) for u in units])
    asking = charges.filter(F.col(basis).isNotNull() & F.col("customer_id").isNotNull())
    dated = asking.withColumn("_at", F.explode(asked) if len(units) > 1 else asked[0]).select(*charges.columns, "_at.*")
    spread = filed.withColumn("_slot", F.explode("_slots.slots")).withColumn("_unit", F.col("_slots.unit")).drop("_slots")
    inside = F.col(basis).between(F.col("period_start"), F.col("period_end"))
    keys = ["customer_id", "_unit", "_slot"]
    small = limits.pop("small", None)
    if small is None:
        small = at_most(spread, limits.get("broadcast_rows", settings.BROADCAST_ROWS))
    counts = None
    if not small:
        # No slot holds more charges than its customer, and these are counted before they ask several units.
        per_customer = asking.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
        if per_customer.filter(F.col("n") > limits.get("rows_per_task", settings.ROWS_PER_TASK)).isEmpty():
            counts = dated.select(*keys, F.lit(0).alias("n")).limit(0)
    found = keyed_join(dated, spread, keys, [row_id], "inner", inside, small=small, counts=counts, **limits)
    return found.drop("_unit", "_slot")


def _filed(periods: DataFrame) -> DataFrame:
    """Periods with ``_slots``: the shortest unit that covers them with one or two slots, and these.

    The slots of both ends are columns of their own, so that each is worked out once a period.
    """
    ends = {f"_{end}{n}": V.slot(f"period_{name}", unit) for n, unit in enumerate(V.SLOTS) for end, name in (("a", "start"), ("b", "end"))}
    usable = periods.filter(F.col("period_start") <= F.col("period_end")).withColumns(ends)
    slots = F.lit(None)
    # Both ends of a period lie in the last unit's only slot.
    for n in range(len(V.SLOTS) - 1, -1, -1):
        near = F.col(f"_b{n}") - F.col(f"_a{n}") <= 1
        slots = F.when(near, F.struct(F.lit(n).alias("unit"), F.col(f"_a{n}").alias("a"), F.col(f"_b{n}").alias("b"))).otherwise(slots)
    placed = usable.withColumn("_near", slots).drop(*ends)
    both = F.array_distinct(F.array("_near.a", "_near.b"))
    return placed.withColumn("_slots", F.struct("_near.unit", both.alias("slots"))).drop("_near")
