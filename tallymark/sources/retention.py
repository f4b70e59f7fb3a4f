"""Old rows move to an archive in two phases, so that a stopped run can be repeated.

A run first copies the rows before its limit to a folder of its own, then says so in a small
file, and only then takes them out of the live table.  The file is the turning point: readers
see rows before the limit in the live table until it is there, and in the archive from then
on, so a row is never missing and never seen twice, whatever of the rest has been done.  A
run that is repeated goes on at the step it had reached.  While a run is under way, nothing
older than its limit is to be written to the live table; what comes later is left to the next.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallymark.functions import values as V
from tallymark.sources import files
from tallymark.sources.levels import RUN
from tallymark.sources.tables import MONTH

COPIED, DONE = "copied", "done"


class Retention:
    """Live table and archive, both by month of ``time``, with the notes of the runs below the archive."""

    def __init__(self, spark: SparkSession, live: str, archive: str, time: str):
        self.spark, self.live_path, self.archive_path, self.time = spark, live, archive, time

    def run(self, name: str, as_of, keep: str = "30 days") -> None:
        """Move what is older than ``keep`` at ``as_of``; ``name`` tells runs apart and is given again on a repeat."""
        self.copy(name, as_of, keep)
        self.drop(name)

    def copy(self, name: str, as_of, keep: str = "30 days") -> None:
        """First phase: the rows are in the archive for readers as well, once this returns."""
        if not self._noted(name, COPIED):
            limit = self.spark.range(1).select(F.unix_micros(V.before(as_of, keep))).first()[0]
            self._copy(name, limit)
            self._note(name, COPIED, limit)

    def drop(self, name: str) -> None:
        """Second phase: the live table no longer holds them."""
        if not self._noted(name, DONE):
            self._drop(name, self._limit(name))
            self._note(name, DONE, self._limit(name))

    def live(self) -> DataFrame:
        """Rows that were not archived."""
        rows = self._stored()
        for name in self._copied():
            if not self._noted(name, DONE):
                rows = rows.filter(~self._older(self._limit(name)))
        return rows

    def archived(self) -> DataFrame:
        """Rows of all runs that have copied theirs."""
        schema = self._stored().schema
        paths = [self._copy_path(n) for n in self._copied()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        named = StructType([*schema.fields, StructField(RUN, StringType())])
        return self.spark.read.schema(named).option("basePath", f"{self.archive_path}/rows").parquet(*paths).drop(RUN)

    def _older(self, limit: int):
        return F.coalesce(F.unix_micros(self.time) < limit, F.lit(False))

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.live_path)

    def _copy_path(self, name: str) -> str:
        return f"{self.archive_path}/rows/{RUN}={name}"

    def _copy(self, name: str, limit: int) -> None:
        """Rows of the run; a copy that was stopped is replaced."""
        rows = self.live().filter(self._older(limit))
        rows.hint("rebalance", F.col(MONTH)).write.mode("overwrite").partitionBy(MONTH).parquet(self._copy_path(name))

    def _drop(self, name: str, limit: int) -> None:
        """Take the rows before the limit out of the live table.

        Whole months go with their folders.  The month of the limit is written aside first,
        and put in place from there, since a folder cannot be read and replaced at once.
        """
        last = self.spark.range(1).select(V.month_key(F.timestamp_micros(F.lit(limit)))).first()[0]
        staged = f"{self.archive_path}/staged/run={name}"
        months = [n.split("=", 1)[1] for n in files.children(self.spark, self.live_path) if n.startswith(f"{MONTH}=")]
        if last in months:
            if not files.exists(self.spark, f"{staged}/_SUCCESS"):
                stay = self._stored().filter((F.col(MONTH) == last) & ~self._older(limit))
                stay.write.mode("overwrite").parquet(staged)
            stay = self.spark.read.schema(self._stored().schema).parquet(staged)
            if stay.isEmpty():
                files.remove(self.spark, f"{self.live_path}/{MONTH}={last}")
            else:
                writer = stay.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy(MONTH).parquet(self.live_path)
        for month in months:
            if month < last:
                files.remove(self.spark, f"{self.live_path}/{MONTH}={month}")
        files.remove(self.spark, staged)

    def _copied(self) -> list[str]:
        """Runs that have copied their rows."""
        return [n.removesuffix(f".{COPIED}") for n in files.children(self.spark, f"{self.archive_path}/notes") if n.endswith(f".{COPIED}")]

    def _limit(self, name: str) -> int:
        """Limit of a run in microseconds."""
        return json.loads(files.read_text(self.spark, f"{self.archive_path}/notes/{name}.{COPIED}"))["limit"]

    def _noted(self, name: str, step: str) -> bool:
        return files.exists(self.spark, f"{self.archive_path}/notes/{name}.{step}")

    def _note(self, name: str, step: str, limit: int) -> None:
        files.put_new(self.spark, f"{self.archive_path}/notes/{name}.{step}", json.dumps({"limit": limit}))
