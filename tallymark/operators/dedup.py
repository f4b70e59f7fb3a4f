"""First copy wins: duplicate events, latest versions of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.operators.skew import keyed_join
from tallymark.session import materialise

KEY = "_key"


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter lets Spark keep one row per key and task before the shuffle,
    so many copies of one key do not travel.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_copies(events: DataFrame, key: str = "event_id", arrival: str = "ingestion_time") -> DataFrame:
    """The accepted copy of every event."""
    others = [F.col(c) for c in events.columns if c not in (key, arrival)]
    return best_row(events, [key], [F.col(arrival).asc_nulls_last(), *others])


def later_copies(
    events: DataFrame,
    key: str = "event_id",
    arrival: str = "ingestion_time",
    rows_per_task: int = settings.ROWS_PER_TASK,
) -> DataFrame:
    """Refused copies with their number in ``copies``.

    Repeated ids are found first, by a hash aggregate over two columns; only their
    events are looked at in full.  Events of a heavily repeated id are picked by
    broadcast (there are at most rows / rows_per_task such ids), and equal rows are
    counted before the shuffle.  Events without an id are copies of one event, and a
    copy without an arrival time comes after those with one, as in ``first_copies``:
    first copies and refused copies add up to the events.
    """
    others = [c for c in events.columns if c not in (key, arrival)]
    # A struct equals another one where both hold null.
    events = events.withColumn(KEY, F.struct(F.col(key).alias("id")))
    repeated = materialise(
        events.groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("n"), F.min(arrival).alias("_first"))
        .filter("n > 1")
    )
    heavy = repeated.filter(F.col("n") > rows_per_task)
    light = repeated.filter(F.col("n") <= rows_per_task)
    often = events.join(F.broadcast(heavy.drop("n")), KEY)
    rarely = events.join(F.broadcast(heavy.select(KEY)), KEY, "left_anti")
    row_id, sizes = [arrival, *others], {"rows_per_task": rows_per_task}
    rare = keyed_join(rarely, light.drop("n"), [KEY], row_id, "inner", counts=light.select(KEY, "n"), **sizes)
    found = often.unionByName(rare)
    variants = materialise(found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("copies")))
    # Compared as ``first_copies`` orders them; a struct also equals one with the same nulls.
    rest = F.struct(*[F.col(c) for c in others])
    earliest = F.col(arrival).eqNullSafe(F.col("_first"))
    winner = variants.filter(earliest).groupBy(KEY).agg(F.min(rest).alias("_winner"))
    is_winner = earliest & (rest == F.col("_winner"))
    # An id may have very many variants: they are spread over tasks.
    return (
        keyed_join(variants, winner, [KEY], row_id, "inner", counts=repeated.select(KEY, "n"), **sizes)
        .withColumn("copies", F.col("copies") - F.when(is_winner, 1).otherwise(0))
        .filter("copies > 0")
        .withColumn("reason", F.lit("DUPLICATE_EVENT_ID"))
        .drop("_first", "_winner", KEY)
    )


def conflicts(events: DataFrame, key: str = "event_id", arrival: str = "ingestion_time") -> DataFrame:
    """One row per repeated event: copies, first and last arrival."""
    return (
        events.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(arrival).alias("first_arrival"),
            F.max(arrival).alias("last_arrival"),
        )
        .filter("copies > 1")
    )


def not_stored(events: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Events whose id is not in the stored table yet; ``events`` has each id once."""
    return events.join(stored.select(key), key, "left_anti")


def already_stored(events: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    return events.join(stored.select(key), key, "left_semi").withColumn("reason", F.lit("DUPLICATE_EVENT_ID"))
