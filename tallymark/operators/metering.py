"""Events to usage windows: lateness, aggregation, finalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.functions import values as V

USAGE_KEY = ["customer_id", "metric_type", "window_start"]


def with_window(events: DataFrame, size: str = settings.WINDOW_SIZE, event_time: str = "event_time") -> DataFrame:
    """Add the half-open event-time window [window_start, window_end)."""
    window = F.window(event_time, size)
    return events.withColumn("_window", window).withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    ).drop("_window")


def is_late(as_of, size: str = settings.WINDOW_SIZE, lateness: str = settings.ALLOWED_LATENESS) -> Column:
    """A window that started before ``as_of - lateness`` takes no more events."""
    return V.window_start("event_time", size) < V.before(as_of, lateness)


def split_late(
    events: DataFrame, as_of, size: str = settings.WINDOW_SIZE, lateness: str = settings.ALLOWED_LATENESS
) -> tuple[DataFrame, DataFrame]:
    """(on-time, late) events; every event is in exactly one of them."""
    late = F.coalesce(is_late(as_of, size, lateness), F.lit(False))
    return events.filter(~late), events.filter(late)


def late_envelope(late: DataFrame, as_of, lateness: str = settings.ALLOWED_LATENESS) -> DataFrame:
    """Late events with the receipt time and the watermark that refused them."""
    return late.withColumns({"received_at": V.moment(as_of), "watermark": V.before(as_of, lateness)})


def event_values(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, refused) events with ``value`` read from the metadata."""
    # Exploded, so that metadata is parsed and the value read once, and not again for every use of them.
    parsed = events.withColumn("_parsed", F.explode(F.array(F.try_parse_json("metadata"))))
    valued = parsed.withColumn("value", F.explode(F.array(V.parsed_value(F.col("_parsed"), "metric_type")))).drop("_parsed")
    refused = valued.filter(F.col("value").isNull()).withColumn("reason", F.lit("CALCULATION_ERROR"))
    return valued.filter(F.col("value").isNotNull()), refused


def meter(events: DataFrame, size: str = settings.WINDOW_SIZE, with_average: bool = False) -> DataFrame:
    """Usage per customer, metric and window.

    Needs customer_id, metric_type, event_time, value.  Sum, maximum and count are
    computed together with a partial step on the scan side; the metric then picks
    one.  The window start carries the grouping, its end follows from it.
    """
    start = V.window_start("event_time", size)
    grouped = events.groupBy("customer_id", "metric_type", start.alias("window_start"))
    return _pick(grouped.agg(*partial_aggregates(with_average)), size, with_average)


def partial_aggregates(with_average: bool = False) -> list[Column]:
    """Mergeable parts of a usage value."""
    parts = [
        F.sum("value").alias("sum_value"),
        F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("event_count"),
    ]
    return parts + ([F.count("value").alias("valued_count")] if with_average else [])


def merge_partials(partials: DataFrame, size: str = settings.WINDOW_SIZE) -> DataFrame:
    """Usage from partial aggregates of several batches."""
    return _pick(add_partials(partials), size, False)


def add_partials(partials: DataFrame, keys: Sequence[str] = USAGE_KEY) -> DataFrame:
    """One row per window from partial aggregates of several batches, with the columns and types of these."""
    kinds = {f.name: f.dataType for f in partials.schema.fields}
    merged = partials.groupBy(*keys).agg(
        F.sum("sum_value").alias("sum_value"),
        F.max("max_value").alias("max_value"),
        F.sum("event_count").alias("event_count"),
    )
    return merged.select(*[F.col(c).cast(kinds[c]) for c in merged.columns])


def window_id(size: str = settings.WINDOW_SIZE) -> Column:
    """Id of a usage window."""
    return V.stable_id("customer_id", "metric_type", V.utc_text("window_start"), F.lit(size))


def _pick(grouped: DataFrame, size: str, with_average: bool) -> DataFrame:
    kind = V.strategy("metric_type")
    value = (
        F.when(kind == "sum", F.col("sum_value"))
        .when(kind == "max", F.greatest(F.col("max_value"), F.lit(0)))
        .otherwise(F.col("event_count"))
    )
    columns = [
        window_id(size).alias("aggregation_id"),
        *USAGE_KEY,
        (F.col("window_start") + F.expr(f"interval {size}")).alias("window_end"),
        value.cast("decimal(20,6)").alias("value"),
        V.unit_of("metric_type").alias("unit"),
        F.col("event_count"),
    ]
    if with_average:
        columns.append((F.col("sum_value") / F.col("valued_count")).cast("decimal(20,6)").alias("average_value"))
    return grouped.select(*columns)


def usage_events(
    events: DataFrame, size: str = settings.WINDOW_SIZE, event_id: str = "event_id", carry: Sequence[str] = ()
) -> DataFrame:
    """(aggregation_id, event_id): which window an event was counted in.

    The id of a window is a hash of its key, so this is a projection.  It replaces an
    id list on the usage row, which would grow without bound.  ``carry`` adds columns
    of the event, which saves joining the events again when tracing.
    """
    start = V.window_start("event_time", size)
    keyed = events.withColumn("window_start", start)
    return keyed.select(window_id(size).alias("aggregation_id"), F.col(event_id), *carry)


def finalise(usage: DataFrame, as_of, lateness: str = settings.ALLOWED_LATENESS) -> DataFrame:
    """Mark windows that ended by ``as_of - lateness`` as final."""
    done = F.col("window_end") <= V.before(as_of, lateness)
    return usage.withColumns({"is_final": done, "computed_at": V.moment(as_of)})


def finalisable(usage: DataFrame, as_of, lateness: str = settings.ALLOWED_LATENESS) -> DataFrame:
    """Open windows that are due: ``usage`` has ``is_final`` from an earlier run."""
    return usage.filter(~F.col("is_final") & (F.col("window_end") <= V.before(as_of, lateness)))


def bump_versions(current: DataFrame, update: DataFrame) -> DataFrame:
    """Apply recomputed windows to a usage snapshot.

    A window whose value or count changed gets the next version; new windows start
    at 1; the rest stays as it is.
    """
    new = update.select(
        *USAGE_KEY,
        F.col("value").alias("_value"),
        F.col("event_count").alias("_count"),
        F.lit(True).alias("_given"),
    )
    joined = current.select(*USAGE_KEY, "value", "event_count", "version").join(new, USAGE_KEY, "full_outer")
    changed = F.col("_given") & (
        ~F.col("value").eqNullSafe(F.col("_value")) | ~F.col("event_count").eqNullSafe(F.col("_count"))
    )
    return joined.select(
        *USAGE_KEY,
        F.coalesce("_value", "value").alias("value"),
        F.coalesce("_count", "event_count").alias("event_count"),
        F.when(F.col("version").isNull(), 1)
        .when(changed, F.col("version") + 1)
        .otherwise(F.col("version"))
        .cast("int")
        .alias("version"),
    )


def sliding_usage(events: DataFrame, size_minutes: int, slide_minutes: int, keys: Sequence[str]) -> DataFrame:
    """Count, sum and average per key in windows that overlap.

    Events are first reduced to panes of one slide; only panes are copied to the
    windows they belong to, not events.
    """
    if size_minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    pane = V.window_start("event_time", f"{slide_minutes} minutes")
    panes = events.groupBy(*keys, pane.alias("pane")).agg(
        F.sum("value").alias("sum_value"), F.count("value").alias("n")
    )
    steps = size_minutes // slide_minutes
    starts = F.sequence(
        F.col("pane") - F.expr(f"interval {(steps - 1) * slide_minutes} minutes"),
        F.col("pane"),
        F.expr(f"interval {slide_minutes} minutes"),
    )
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy(*keys, "window_start")
        .agg(F.sum("sum_value").alias("sum_value"), F.sum("n").alias("event_count"))
        .select(
            *keys,
            "window_start",
            (F.col("window_start") + F.expr(f"interval {size_minutes} minutes")).alias("window_end"),
            "event_count",
            F.col("sum_value").cast("decimal(20,6)").alias("sum_value"),
            (F.col("sum_value") / F.col("event_count")).cast("decimal(20,6)").alias("average_value"),
        )
    )


def session_usage(events: DataFrame, gap_minutes: int, keys: Sequence[str]) -> DataFrame:
    """Bursts of events closer together than the gap.

    Two events in the same gap-wide slot always share a session, so events are
    reduced to one row per slot first; what is ordered per key is at most one row
    per slot of time, whatever the number of events.
    """
    slot = V.window_start("event_time", f"{gap_minutes} minutes")
    slots = events.groupBy(*keys, slot.alias("_slot")).agg(
        F.min("event_time").alias("_from"),
        F.max("event_time").alias("_to"),
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("v"),
    )
    by_time = Window.partitionBy(*keys).orderBy("_from")
    gap = F.expr(f"interval {gap_minutes} minutes")
    starts = F.lag("_to").over(by_time).isNull() | (F.col("_from") >= F.lag("_to").over(by_time) + gap)
    numbered = slots.withColumn("_starts", starts.cast("int")).withColumn(
        "_session", F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.min("_from").alias("session_start"),
            (F.max("_to") + gap).alias("session_end"),
            F.sum("n").alias("event_count"),
            F.sum("v").cast("decimal(20,6)").alias("value"),
        )
        .drop("_session")
    )
