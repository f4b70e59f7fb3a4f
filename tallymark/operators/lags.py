"""Quantiles of lags from counters that add up, and partitions whose watermark stands still.

A lag is counted in a slot: values below 128 have one each, larger ones share a slot with
those that agree in their first eight bits.  Slots are a fixed rule, so counters of any
batches, hours and partitions add up to the counters of the whole, and a quantile read from
them is at most 1/128 above the exact one.  Events are read once, when they come in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions import values as V

#: Bits of a value that tell slots apart.
BITS = 8


def slot_of(value: Column) -> Column:
    """Number of the slot of a whole number of 0 or more; slots of larger numbers are larger."""
    cut = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return (cut * (1 << (BITS - 1)) + F.call_function("shiftright", value, cut)).cast("int")


def slot_end(slot: Column) -> Column:
    """Largest number of a slot."""
    half = 1 << (BITS - 1)
    cut = F.greatest(F.floor(slot / half) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (slot - cut * half + 1).cast("bigint"), cut) - 1


def lag_counters(events: DataFrame, received: Column, partition: Column) -> DataFrame:
    """(hour, partition, slot, n): lags in milliseconds, by hour of receipt; events of the future have none."""
    lag = F.greatest(F.floor((F.unix_micros(received) - F.unix_micros("event_time")) / 1000), F.lit(0)).cast("bigint")
    hour = V.window_start(received, "1 hour")
    rows = events.select(hour.alias("hour"), partition.alias("partition"), slot_of(lag).alias("slot"))
    return rows.filter(F.col("slot").isNotNull()).groupBy("hour", "partition", "slot").agg(F.count(F.lit(1)).alias("n"))


def add_counters(counters: DataFrame, keys: Sequence[str] = ("hour", "partition")) -> DataFrame:
    return counters.groupBy(*keys, "slot").agg(F.sum("n").alias("n"))


def lag_quantile(counters: DataFrame, share: float, keys: Sequence[str] = ("hour", "partition")) -> DataFrame:
    """(keys, events, lag_ms): the least slot end that ``share`` of the lags of each group do not exceed.

    A group has a few thousand slots at most, whatever the number of its events.
    """
    keys = list(keys)
    upto = Window.partitionBy(*keys).orderBy("slot")
    every = Window.partitionBy(*keys)
    counted = add_counters(counters, keys).withColumns({"seen": F.sum("n").over(upto), "events": F.sum("n").over(every)})
    reached = counted.filter(F.col("seen") >= F.ceil(F.col("events") * F.lit(share)))
    least = reached.groupBy(*keys).agg(F.first("events").alias("events"), F.min("slot").alias("slot"))
    return least.select(*keys, "events", slot_end(F.col("slot")).alias("lag_ms"))


def progress(events: DataFrame, observed_at: Column, partition: Column) -> DataFrame:
    """(partition, observed_at, watermark): how far each partition has come; one row per partition of a batch."""
    return events.groupBy(partition.alias("partition")).agg(F.max(observed_at).alias("observed_at"), F.max("event_time").alias("watermark"))
