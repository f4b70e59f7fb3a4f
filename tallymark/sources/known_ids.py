"""Ids that were stored, for ever, and which of a batch are among them.

Ids lie in buckets by hash (more of them for more ids), in a table of few runs (``levels``).  Beside every run lies a
Bloom filter: rows of 4,096 bytes, one for each slice of a bucket, made and read with Spark's
bitmap functions.  A batch looks its ids up in the filters first, which takes two bytes per
stored id, and opens only those buckets of those runs where the filter says that one of its
ids may be; there the ids themselves decide.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.operators.skew import at_most
from tallymark.session import materialise
from tallymark.sources.levels import LeveledTable, Run

BUCKETS = 16
#: Bits of a filter row, bits kept per id, and bits set for each.
ROW_BITS, BITS_AN_ID, HASHES = 8 * 4096, 16, 5


class KnownIds:
    """Ids of all batches so far, below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "event_id", fanout: int = 4, buckets: int = BUCKETS):
        self.spark, self.folder, self.key, self.buckets = spark, folder, key, buckets
        self.table = _WithFilters(spark, folder, buckets, fanout)

    def add(self, batch: int, ids: DataFrame) -> None:
        """Note the ids a batch stored, each once; a repeated batch is noted once."""
        self.table.add(batch, self._keyed(ids).select("id", "bucket", F.lit(batch).cast("long").alias("batch")))

    def known(self, ids: DataFrame, batch: int | None = None) -> DataFrame:
        """Those of ``ids``, each once, that were stored, by another batch than ``batch`` if given."""
        runs = [r for r in self.table.runs() if r.rows]
        maybe = materialise(self.maybe(ids, runs)) if runs else None
        opened = [] if maybe is None else self.opened(maybe, runs)
        if not opened:
            return ids.select(self.key).limit(0)
        stored = self.spark.read.schema("id string, batch long").parquet(*opened)
        if batch is not None:
            stored = stored.filter(F.col("batch") != batch)
        # Few ids pass the filters; a batch of copies of stored ids is the exception.
        found = maybe.select(self.key, "id").distinct()
        few = at_most(found, settings.BROADCAST_ROWS)
        hits = stored.select("id").join(F.broadcast(found.select("id")) if few else found.select("id"), "id", "left_semi")
        return found.join(hits, "id", "left_semi").select(self.key)

    def _keyed(self, ids: DataFrame) -> DataFrame:
        text = F.col(self.key).cast("string")
        return ids.select(self.key, text.alias("id"), F.pmod(F.xxhash64(text), F.lit(self.buckets)).cast("int").alias("bucket")).filter("id IS NOT NULL")

    def opened(self, maybe: DataFrame, runs: list[Run]) -> list[str]:
        """Folders of the buckets that may hold one of the ids; at most buckets times runs."""
        places = {(r.run, r.bucket) for r in maybe.select("run", "bucket").distinct().collect()}
        return [f"{self.table.path(runs[n])}/bucket={b}" for n, b in sorted(places)]

    def maybe(self, ids: DataFrame, runs: list[Run]) -> DataFrame:
        """(key, id, bucket, run) for which all bits are set in the run's filter."""
        sizes = F.array(*[F.struct(F.lit(n).alias("run"), F.lit(_filter_rows(r.rows, self.buckets)).alias("slices")) for n, r in enumerate(runs)])
        asked = self._keyed(ids).withColumn("at", F.explode(sizes))
        asked = asked.select(self.key, "id", "bucket", "at.run", F.pmod(_hash("id", HASHES), F.col("at.slices")).alias("slice"))
        filters = reduce(DataFrame.unionByName, [self.spark.read.parquet(self.table.filter_path(r)).withColumn("run", F.lit(n)) for n, r in enumerate(runs)])
        held = reduce(and_, [_is_set(F.col("bits"), _position("id", n)) for n in range(HASHES)])
        return asked.join(filters, ["run", "bucket", "slice"]).filter(held).select(self.key, "id", "bucket", "run")


class _WithFilters(LeveledTable):
    """Runs of ids with a filter each, written before the run counts."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, fanout: int):
        super().__init__(spark, folder, ["bucket"], lambda rows: rows.groupBy("id", "bucket").agg(F.min("batch").alias("batch")), fanout)
        self.buckets = buckets

    def path(self, run: Run) -> str:
        return self._path(run.name)

    def filter_path(self, run: Run) -> str:
        return f"{self.folder}/filters/{run.name}"

    def _write(self, rows: DataFrame, name: str, level: int, first: int, last: int) -> Run:
        run = super()._write(rows, name, level, first, last)
        ids = self.spark.read.schema(rows.schema).parquet(self._path(name))
        positions = F.explode(F.array(*[_position("id", n) for n in range(HASHES)]))
        slices = F.pmod(_hash("id", HASHES), F.lit(_filter_rows(run.rows, self.buckets)))
        bits = ids.select("bucket", slices.alias("slice"), positions.alias("at"))
        filters = bits.groupBy("bucket", "slice").agg(F.bitmap_construct_agg("at").alias("bits"))
        filters.write.mode("overwrite").parquet(self.filter_path(run))
        return run


def _hash(column: str, seed: int) -> Column:
    return F.xxhash64(F.col(column), F.lit(seed))


def _position(column: str, seed: int) -> Column:
    return F.pmod(_hash(column, seed), F.lit(ROW_BITS))


def _filter_rows(ids: int, buckets: int) -> int:
    """Filter rows of every bucket of a run."""
    return max(1, -(-ids * BITS_AN_ID // (buckets * ROW_BITS)))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1
