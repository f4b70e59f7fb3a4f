"""A table that grows by batches and stays in few files.

Every batch is a run of files.  When a level holds ``fanout`` runs they are merged into one
run of the next level, so that n batches leave less than ``fanout`` runs on each of about
log(n) levels, and a row is written once per level.  Which runs make up the table is listed
in a manifest, one small file per version: a run counts once a version names it, and until
then a stopped write or merge has changed nothing.  There is one writer; readers may be many.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallymark.sources import files

#: Versions of the manifest that keep their runs, for readers that started before a merge.
KEPT_VERSIONS = 4
RUN = "run_name"


@dataclass(frozen=True)
class Run:
    """Files with the rows of batches ``first`` to ``last``."""

    name: str
    level: int
    first: int
    last: int
    rows: int


def _digits(name: str) -> int:
    return int(name.split(".")[0])


class LeveledTable:
    """Rows partitioned by ``partition``; ``combine`` makes one set of rows of those of several batches."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        partition: Sequence[str],
        combine: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        fanout: int = 4,
    ):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.folder, self.partition, self.combine, self.fanout = spark, folder, list(partition), combine, fanout

    def add(self, batch: int, rows: DataFrame) -> None:
        """Store a batch, later ones with larger numbers.  One that is repeated replaces its rows, or was merged already."""
        runs = self.runs()
        if any(r.level > 0 and r.first <= batch <= r.last for r in runs):
            return
        run = self._write(rows, f"batch-{batch}", 0, batch, batch)
        self._commit([*(r for r in runs if (r.level, r.first) != (0, batch)), run], rows.schema)
        self._merge()

    def read(self, where=None, runs: Sequence[Run] | None = None) -> DataFrame | None:
        """Rows of all batches, not combined; ``where`` should name the partition columns.  None before the first batch."""
        version = self._version()
        if version is None:
            return None
        known, schema = self._load(version)
        paths = [self._path(r.name) for r in (known if runs is None else runs) if r.rows]
        if not paths:
            return self.spark.createDataFrame([], schema)
        named = StructType([*schema.fields, StructField(RUN, StringType())])
        rows = self.spark.read.schema(named).option("basePath", f"{self.folder}/runs").parquet(*paths).drop(RUN)
        return rows if where is None else rows.filter(where)

    def runs(self) -> list[Run]:
        """The runs that make up the table, oldest first."""
        version = self._version()
        return [] if version is None else self._load(version)[0]

    def _merge(self) -> None:
        """Merge full levels, from the lowest."""
        while True:
            runs = self.runs()
            full = [same for level in sorted({r.level for r in runs}) if len(same := [r for r in runs if r.level == level]) >= self.fanout]
            if not full:
                return
            old = full[0][: self.fanout]
            rows, schema = self.read(runs=old), self._load(self._version())[1]
            name = f"merged-{old[0].first}-{old[-1].last}"
            new = self._write(self.combine(rows).select(*schema.names), name, old[0].level + 1, old[0].first, old[-1].last)
            self._commit(sorted([new, *(r for r in runs if r not in old)], key=lambda r: r.first), schema)

    def _write(self, rows: DataFrame, name: str, level: int, first: int, last: int) -> Run:
        path = self._path(name)
        # Light partitions share a task, heavy ones are split.
        spread = rows.hint("rebalance", *[F.col(c) for c in self.partition])
        spread.write.mode("overwrite").partitionBy(*self.partition).parquet(path)
        return Run(name, level, first, last, self.spark.read.schema(rows.schema).parquet(path).count())

    def _path(self, name: str) -> str:
        return f"{self.folder}/runs/{RUN}={name}"

    def _version(self) -> int | None:
        names = [n for n in files.children(self.spark, f"{self.folder}/manifest") if n.endswith(".json")]
        return _digits(names[-1]) if names else None

    def _load(self, version: int) -> tuple[list[Run], StructType]:
        listed = json.loads(files.read_text(self.spark, self._manifest(version)))
        return [Run(**r) for r in listed["runs"]], StructType.fromJson(listed["schema"])

    def _manifest(self, version: int) -> str:
        return f"{self.folder}/manifest/{version:012d}.json"

    def _commit(self, runs: list[Run], schema: StructType) -> None:
        last = self._version()
        version = 0 if last is None else last + 1
        text = json.dumps({"runs": [asdict(r) for r in runs], "schema": schema.jsonValue()})
        files.put_new(self.spark, self._manifest(version), text)
        self._clear(version)

    def _clear(self, version: int) -> None:
        """Remove versions that are too old, and the runs only they named."""
        old, kept, gone = [], set(), set()
        for name in files.children(self.spark, f"{self.folder}/manifest"):
            if name.endswith(".json"):
                recent = _digits(name) > version - KEPT_VERSIONS
                (kept if recent else gone).update(r.name for r in self._load(_digits(name))[0])
                old += [] if recent else [name]
        for name in gone - kept:
            files.remove(self.spark, self._path(name))
        for name in old:
            files.remove(self.spark, f"{self.folder}/manifest/{name}")
