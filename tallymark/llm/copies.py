"""Exact copies found by stateful streaming over keyed state on disk.

Two streams run over a folder of Parquet files.  The intake gives every row its digest (of
the text with A-Z lower-cased) and its place (file and row), and writes these, without the
text.  The index groups them by digest; its state lives in RocksDB below the checkpoint, is
kept for ever, and holds per digest the first row seen (number of its batch and place), the
row that stays (largest id) and the number of rows.  Rows are combined per task before they
reach the state, so that a text with very many copies costs one entry per task.

A digest alone decides nothing.  Once the index has taken in what is new, the texts of all
new rows whose digest was seen before or more than once are read again at their places,
together with the first row's, and compared byte for byte: texts are grouped as a whole,
within tasks first.  Only files with such rows are read, once in a run however many batches
it has.  Digests with two different texts are written down, and the groups of their rows are
formed from the whole texts instead of the digest.  Every row is compared, so a digest that
is not written down has one text.

A stopped run goes on where it stopped: both streams keep their offsets, files of a batch
that are complete are not written again, hits of a batch are replaced, and what was compared
is noted last.

Defined cases: null texts are empty texts.  Of rows with equal texts and equal ids, one
stays, the one at the last place.  Null ids are smaller than all others; a group of them
keeps a row and has a null keep_id.  Texts are read whole, one at a time, however long.
An empty table or an empty folder gives no rows.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import BROADCAST_BYTES, col
from tallymark.operators.skew import keyed_join
from tallymark.session import materialise
from tallymark.sources import files

#: Parquet bytes a batch of the intake gives every core; rows of the index take about a thirtieth of their texts.
BYTES_A_CORE, INDEX_SHARE = 32 << 20, 30
#: Bytes of a row with digest and place in memory, rounded up.
ROW_BYTES = 512
#: Files that a filter may name; more of them are found by the join alone.
FILES_NAMED = 10_000
#: A digest with more rows is joined by several tasks.
ROWS_A_TASK = 500_000

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A store reserves megabytes for files that stay small where there are many stores.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLACE = ["file", "pos"]


def normal_text(text: Column) -> Column:
    """The text that counts as equal: A-Z in lower case, nothing else changed; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


class CopyIndex:
    """Copies among the rows of the Parquet files in or at ``source``, indexed below ``folder``.

    ``advance`` takes in what is new; ``rows`` gives the present answer for all rows.
    ``digest`` maps the text to a string; a weak one costs time, never a wrong answer.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        folder: str,
        id_col: str = "doc_id",
        text_col: str = "text",
        digest: Callable[[Column], Column] = sha256,
        bytes_a_batch: int | None = None,
        rows_a_task: int = ROWS_A_TASK,
    ):
        self.spark, self.source, self.folder = spark, source, folder
        self.id_col, self.text_col, self.digest, self.rows_a_task = id_col, text_col, digest, rows_a_task
        self.bytes_a_batch = bytes_a_batch or BYTES_A_CORE * spark.sparkContext.defaultParallelism

    def advance(self) -> None:
        """Take in all files that are there and were not yet, batch by batch."""
        with _settings(self.spark, _STATE):
            self._run(self._texts(self._stream()).select("id", *_PLACE, self.digest(F.col("norm")).alias("digest")), "intake", "append", self._take_in)
            if self._read("rows") is not None:
                self._run(self._grouped(), "index", "update", self._note_hits)
                self._compare()

    def rows(self) -> DataFrame:
        """Id, keep_id, group_size, kept and digest of every row taken in, with its file and place."""
        taken = self._read("rows")
        if taken is None:
            return self.spark.createDataFrame([], f"`{self.id_col}` long, keep_id long, group_size long, kept boolean, digest string, file string, pos long")
        taken = taken.select("id", *_PLACE, "digest")
        state = self.state()
        found, mixed = self._read("mixed"), None
        if found is not None and not found.isEmpty():
            mixed = F.broadcast(found.distinct()) if found.count() * ROW_BYTES <= BROADCAST_BYTES else found.distinct()
        alike = taken if mixed is None else taken.join(mixed, "digest", "left_anti")
        several = state.filter("n > 1").select("digest", "keep", "n")
        out = self._answer(alike, several, ["digest"])
        if mixed is not None:
            texts = self._at(taken.join(mixed, "digest", "left_semi"))
            groups = texts.groupBy("digest", "norm").agg(_last().alias("keep"), F.count(F.lit(1)).alias("n"))
            out = out.unionByName(self._answer(texts, groups, ["digest", "norm"]))
        return out

    def kept(self) -> DataFrame:
        """The rows of the source that stay, with all their columns."""
        stay = self.rows().filter("kept").select(*[F.col(c).alias(f"_at_{c}") for c in _PLACE])
        source = self.spark.read.parquet(self.source)
        at = (F.col("_metadata.file_path") == F.col("_at_file")) & (F.col("_metadata.row_index") == F.col("_at_pos"))
        return source.join(stay, at, "left_semi")

    def state(self) -> DataFrame:
        """(digest, first, last, keep, n) of every digest, from the stored state itself."""
        stored = self.spark.read.format("statestore").load(f"{self.folder}/index_state")
        # Buffers come in the order of the aggregates in _grouped, some with equal names.
        place = "file: string, pos: bigint"
        value = F.col("value").cast(f"struct<first: struct<batch: bigint, {place}>, last: bigint, keep: struct<id: bigint, {place}>, n: bigint>")
        return stored.select("key.digest", value.alias("v")).select("digest", "v.*")

    def _stream(self) -> DataFrame:
        batch = self.spark.read.parquet(self.source)
        reader = self.spark.readStream.schema(batch.schema).option("maxBytesPerTrigger", str(self.bytes_a_batch))
        # A pattern that matches the path alone: a stream takes a folder or a pattern, not one file.
        path = self.source.rstrip("/")
        return reader.parquet(f"{path[:-1]}[{path[-1]}]")

    def _texts(self, source: DataFrame) -> DataFrame:
        place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"))
        return source.select(col(self.id_col).cast("long").alias("id"), normal_text(col(self.text_col)).alias("norm"), *place)

    def _take_in(self, batch: DataFrame, number: int) -> None:
        path = f"{self.folder}/rows/batch={number}"
        if not files.exists(self.spark, f"{path}/_SUCCESS"):
            batch.write.mode("overwrite").parquet(path)

    def _grouped(self) -> DataFrame:
        taken = self._read("rows")
        size = max(1, self.bytes_a_batch // INDEX_SHARE)
        stream = self.spark.readStream.schema(taken.schema).option("maxBytesPerTrigger", str(size)).parquet(f"{self.folder}/rows")
        first = F.min(F.struct(F.col("batch").cast("long").alias("batch"), *_PLACE))
        return stream.groupBy("digest").agg(
            first.alias("first"), F.max(F.col("batch").cast("long")).alias("last"), _last().alias("keep"), F.count(F.lit(1)).alias("n")
        )

    def _note_hits(self, changed: DataFrame, number: int) -> None:
        """Digests of a batch of the index that have several rows; written at once, since each use of the batch would update the state."""
        changed.filter("n > 1").select("digest", "first", "last").write.mode("overwrite").parquet(f"{self.folder}/hits/at={number}")

    def _compare(self) -> None:
        """Compare the texts of all new rows behind hits; earlier rows were compared with the first one, so it stands for them."""
        spark = self.spark
        done = [[int(x) for x in n.split("-")] for n in files.children(spark, f"{self.folder}/compared") if n[0].isdigit()]
        upto, since = max(done, default=[-1, 0])
        hits = spark.read.parquet(f"{self.folder}/hits").filter(F.col("at") > upto)
        found = hits.agg(F.max("at").alias("at"), F.max("last").alias("last")).first()
        if found["at"] is None:
            return
        hits = hits.groupBy("digest").agg(F.min("first").alias("first"))
        few = hits.count() * ROW_BYTES <= BROADCAST_BYTES
        new = spark.read.parquet(f"{self.folder}/rows").filter(F.col("batch").between(since, found["last"])).select("digest", *_PLACE)
        new = new.join(F.broadcast(hits.select("digest")) if few else hits.select("digest"), "digest", "left_semi")
        before = hits.filter(F.col("first.batch") < since).select("digest", *[F.col(f"first.{c}").alias(c) for c in _PLACE])
        texts = self._at(materialise(new.unionByName(before)))
        different = texts.groupBy("digest", "norm").agg(F.lit(1).alias("one")).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
        different.filter("n > 1").select("digest").write.mode("overwrite").parquet(f"{self.folder}/mixed/at={found['at']}")
        files.put_new(spark, f"{self.folder}/compared/{found['at']}-{max(since, found['last'])}", "")

    def _at(self, places: DataFrame) -> DataFrame:
        """The given rows (digest, file, pos, ...) with their normal text, read at their places."""
        source = places.sparkSession.read.parquet(self.source)
        named = [r.file for r in places.select("file").distinct().limit(FILES_NAMED + 1).collect()]
        if len(named) <= FILES_NAMED:
            # Other files are not opened.
            source = source.filter(F.col("_metadata.file_path").isin(named))
        few = places.count() * ROW_BYTES <= BROADCAST_BYTES
        return self._texts(source).drop("id").join(F.broadcast(places) if few else places, _PLACE)

    def _answer(self, rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
        counts = groups.select(*keys, "n")
        joined = keyed_join(rows, groups, keys, _PLACE, "left", broadcast_rows=BROADCAST_BYTES // ROW_BYTES, rows_per_task=self.rows_a_task, counts=counts)
        alone = F.col("n").isNull()
        stays = (F.col("keep.file") == F.col("file")) & (F.col("keep.pos") == F.col("pos"))
        return joined.select(
            F.col("id").alias(self.id_col),
            F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            (alone | stays).alias("kept"),
            "digest",
            *_PLACE,
        )

    def _run(self, stream: DataFrame, name: str, mode: str, write) -> None:
        started = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{self.folder}/{name}_state").trigger(availableNow=True).start()
        started.awaitTermination()

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{name}")
        except AnalysisException:
            return None


def _last() -> Column:
    return F.max(F.struct("id", *_PLACE))


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as the block runs; streams keep those they were started with."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
