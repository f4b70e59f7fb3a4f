"""Streams: late routing, running usage, late charges."""

from __future__ import annotations

import logging
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymark import settings
from tallymark.functions import values as V
from tallymark.operators import dedup, lags, metering
from tallymark.operators.rating import RatingOptions, late_events_to_rate, rate
from tallymark.session import materialise
from tallymark.sources import files
from tallymark.sources.known_ids import KnownIds
from tallymark.sources.levels import LeveledTable
from tallymark.sources.tables import MONTH
from tallymark.sources.topics import event_message, messages, usage_message

BATCH = "batch_id"
# Marks of earlier runs of the finalising job that are kept.
KEPT_MARKS = 8
LOG = logging.getLogger(__name__)


def route_events(
    events: DataFrame,
    folder: str,
    checkpoint: str,
    clock: Column | None = None,
    size: str = settings.WINDOW_SIZE,
    lateness: str = settings.ALLOWED_LATENESS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Split a stream of metered events into partial usage and late events.

    Lateness is a test of each event against the batch's processing time, so no event
    is dropped and no state is kept.  On-time events are reduced to mergeable parts of
    their windows; the parts of all batches add up to the usage (``current_usage``) and
    are merged as batches come in, so that they stay in few files (``usage_store``).
    What a batch writes is replaced when it is repeated, so a restart counts nothing twice.
    """
    stamped = events.withColumn("received_at", F.current_timestamp() if clock is None else clock)

    def write(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch):
            on_time, late = metering.split_late(batch, F.col("received_at"), size, lateness)
            parts = on_time.groupBy(
                "customer_id", "metric_type", V.window_start("event_time", size).alias("window_start")
            ).agg(*metering.partial_aggregates())
            replace = {"mode": "overwrite"}
            usage_store(batch.sparkSession, folder).add(batch_id, parts.withColumn(MONTH, V.month_key("window_start")))
            metering.usage_events(on_time, size).write.parquet(f"{folder}/usage_events/{BATCH}={batch_id}", **replace)
            enveloped = late.withColumn("watermark", V.before(F.col("received_at"), lateness))
            enveloped.write.parquet(f"{folder}/late_events/{BATCH}={batch_id}", **replace)

    return _start(stamped, checkpoint, write, trigger)


def usage_store(spark: SparkSession, folder: str, fanout: int = 4) -> LeveledTable:
    """Parts of all windows, by month: a row per window and run, few runs."""
    return LeveledTable(spark, f"{folder}/usage_parts", [MONTH], lambda rows: metering.add_partials(rows, [*metering.USAGE_KEY, MONTH]), fanout)


def current_usage(spark: SparkSession, folder: str, size: str = settings.WINDOW_SIZE, since=None) -> DataFrame:
    """Usage windows as far as all batches have counted them.

    ``since`` leaves out windows that started earlier; other months are not read.
    """
    where = None
    if since is not None:
        where = (F.col(MONTH) >= V.month_key(V.moment(since))) & (F.col("window_start") >= V.moment(since))
    return metering.merge_partials(usage_store(spark, folder).read(where), size)


def final_usage(spark: SparkSession, folder: str, as_of, size: str = settings.WINDOW_SIZE, since=None) -> DataFrame:
    """Windows due at ``as_of``, for a timed run; ``since`` skips those already final."""
    marked = metering.finalise(current_usage(spark, folder, size, since), as_of)
    return marked.filter("is_final")


def finalise_due(
    spark: SparkSession,
    folder: str,
    as_of,
    run: str,
    publish: Callable[[DataFrame], None] | None = None,
    size: str = settings.WINDOW_SIZE,
    lateness: str = settings.ALLOWED_LATENESS,
) -> DataFrame:
    """Store windows that are due at ``as_of`` as final, publish them, and return them; for a timed job.

    A window becomes final once: runs leave out what others stored, and a run that is
    repeated replaces its own rows.  Final windows lie by month and run.  A run reads only
    the months that windows due since the latest earlier run can lie in, of the parts as of
    the final windows; when that run was is in the name of a small file.
    """
    at = spark.range(1).select(F.unix_micros(V.moment(as_of))).first()[0]
    marks, final = f"{folder}/final_runs", f"{folder}/final_usage"
    earlier = [(int(time), name) for time, name in (n.split("-", 1) for n in files.children(spark, marks) if n[0].isdigit()) if name != run]
    since = None
    if earlier:
        # Nothing on time arrives any more for windows that start earlier.
        since = V.before(V.before(F.timestamp_micros(F.lit(max(earlier)[0])), lateness), size)
    due = metering.finalise(current_usage(spark, folder, size, since), as_of, lateness).filter("is_final")
    stamped = due.withColumns({"finalised_at": V.moment(as_of), MONTH: V.month_key("window_start"), "run": F.lit(run)})
    if earlier:
        first = spark.range(1).select(V.month_key(since)).first()[0]
        others = _months(spark, final, stamped.schema, first)
        if others is not None:
            stamped = stamped.join(others.filter(F.col("run") != run).select("aggregation_id"), "aggregation_id", "left_anti").select(*stamped.columns)
    writer = stamped.hint("rebalance", F.col(MONTH)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH, "run").parquet(final)
    mark = f"{marks}/{at}-{run}"
    if not files.exists(spark, mark):
        files.put_new(spark, mark, "")
    # The latest runs are enough to know where the next one begins.
    for time, name in sorted(earlier)[:-KEPT_MARKS]:
        files.remove(spark, f"{marks}/{time}-{name}")
    stored = spark.read.schema(stamped.schema).parquet(final).filter(F.col("run") == run)
    if publish is not None:
        publish(messages(stored, usage_message()))
    return stored


def finalised_usage(spark: SparkSession, folder: str) -> DataFrame:
    """All windows stored as final."""
    return spark.read.parquet(f"{folder}/final_usage")


def _months(spark: SparkSession, path: str, schema, first: str) -> DataFrame | None:
    """A table by month from ``first`` on; folders of earlier months are not even listed."""
    names = [n for n in files.children(spark, path) if n.startswith(f"{MONTH}=") and n >= f"{MONTH}={first}"]
    if not names:
        return None
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of parts, or nothing where none was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def store_and_publish(
    events: DataFrame, folder: str, checkpoint: str, publish: Callable[[DataFrame], None], trigger: dict | None = None
) -> StreamingQuery:
    """Store accepted events once per id, then publish them.

    An id is refused for ever once it is stored: each batch is looked up in the index of
    known ids, which opens only what may hold one of them, and refused copies are written
    with their number and the reason.  A failed delivery does not undo the write.
    """
    index = KnownIds(events.sparkSession, f"{folder}/known_ids")


    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _kept(batch):
            first, again = dedup.first_copies(batch), dedup.later_copies(batch)
            known = materialise(index.known(first, batch_id))
            seen = dedup.already_stored(first, known).withColumn("copies", F.lit(1).cast("bigint"))
            path = f"{folder}/events/{BATCH}={batch_id}"
            dedup.not_stored(first, known).write.mode("overwrite").parquet(path)
            again.unionByName(seen).write.mode("overwrite").parquet(f"{folder}/refused/{BATCH}={batch_id}")
            index.add(batch_id, spark.read.parquet(path))
        try:
            publish(messages(spark.read.parquet(path), event_message()))
        except Exception as error:  # the events are stored; delivery can be repeated
            LOG.warning("batch %s was stored but not published: %s", batch_id, error)

    return _start(events, checkpoint, write, trigger)


@contextmanager
def _kept(batch: DataFrame):
    """The batch stays in memory while it is written, and no longer."""
    batch.persist()
    try:
        yield
    finally:
        batch.unpersist()


def rate_late_events(
    late: DataFrame,
    books: DataFrame,
    rules: DataFrame,
    folder: str,
    checkpoint: str,
    options: RatingOptions = RatingOptions(trail=False),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Rate every late event at once as a charge of its own; failures go to quarantine."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch):
            wanted = late_events_to_rate(batch, carry=["received_at"])
            charges, unrated = rate(wanted, books, rules, F.col("received_at"), options)
            charges.write.mode("overwrite").parquet(f"{folder}/charges/{BATCH}={batch_id}")
            unrated.write.mode("overwrite").parquet(f"{folder}/unrated/{BATCH}={batch_id}")

    return _start(late, checkpoint, write, trigger)


def watch_lags(
    events: DataFrame, folder: str, checkpoint: str, partition: Column, received: Column | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Count the lags of events and note how far each source partition has come, batch by batch.

    What is stored adds up and is merged on the way; ``lags_of`` and ``progress_of`` read it
    while the stream runs, without a look at events.
    """
    stamped = events.withColumns({"_received": F.current_timestamp() if received is None else received, "_partition": partition.cast("string")})

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with _kept(batch):
            counted = lags.lag_counters(batch, F.col("_received"), F.col("_partition"))
            _lag_store(spark, folder).add(batch_id, counted.withColumn(MONTH, V.month_key("hour")))
            come = lags.progress(batch, F.col("_received"), F.col("_partition"))
            _progress_store(spark, folder).add(batch_id, come.withColumn(MONTH, V.month_key("observed_at")))

    return _start(stamped, checkpoint, write, trigger)


def _lag_store(spark: SparkSession, folder: str) -> LeveledTable:
    return LeveledTable(spark, f"{folder}/lags", [MONTH], lambda rows: lags.add_counters(rows, ("hour", "partition", MONTH)))


def _progress_store(spark: SparkSession, folder: str) -> LeveledTable:
    def moves(rows: DataFrame) -> DataFrame:
        """When each watermark was first seen is all that matters later."""
        return rows.groupBy("partition", "watermark").agg(F.min("observed_at").alias("observed_at")).withColumn(MONTH, V.month_key("observed_at"))

    return LeveledTable(spark, f"{folder}/progress", [MONTH], moves)


def lags_of(spark: SparkSession, folder: str, where=None) -> DataFrame:
    """Counters of lags (hour, partition, slot, n, month) as far as batches have come."""
    return _lag_store(spark, folder).read(where)


def progress_of(spark: SparkSession, folder: str, where=None) -> DataFrame:
    """(partition, observed_at, watermark), as ``reconcile.stuck_watermarks`` takes it."""
    return _progress_store(spark, folder).read(where)


def windowed_sessions(events: DataFrame, gap: str, lateness: str, keys: list[str]) -> DataFrame:
    """Bursts of events closer together than the gap, kept and merged in Spark's own session state.

    In append mode a session comes out once, when the watermark has passed its end; two that a
    later event connects become one.  The state survives a restart of the stream.
    """
    grouped = (
        events.withWatermark("event_time", lateness)
        .groupBy(*keys, F.session_window("event_time", gap).alias("_session"))
        .agg(F.count(F.lit(1)).alias("event_count"), F.sum("value").cast("decimal(20,6)").alias("value"))
    )
    return grouped.select(*keys, F.col("_session.start").alias("session_start"), F.col("_session.end").alias("session_end"), "event_count", "value")


def windowed_usage(events: DataFrame, size: str = settings.WINDOW_SIZE, lateness: str = settings.ALLOWED_LATENESS) -> DataFrame:
    """Usage with Spark's own event-time state.

    In update mode it gives running windows, in append mode a window once the
    watermark (largest event time minus lateness) has passed its end.  Events behind
    the watermark are dropped, so split late events off first.
    """
    grouped = (
        events.withWatermark("event_time", lateness)
        .groupBy("customer_id", "metric_type", F.window("event_time", size).alias("_window"))
        .agg(*metering.partial_aggregates())
    )
    kind = V.strategy("metric_type")
    value = (
        F.when(kind == "sum", F.col("sum_value"))
        .when(kind == "max", F.greatest("max_value", F.lit(0)))
        .otherwise(F.col("event_count"))
    )
    return grouped.select(
        "customer_id",
        "metric_type",
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        value.cast("decimal(20,6)").alias("value"),
        "event_count",
    )


def _start(stream: DataFrame, checkpoint: str, write, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 minutes"}))
        .start()
    )
