"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A lookup table of at most this many bytes may be broadcast.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null counts as the empty text."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a step builds for a batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of ``key``; the same ones on every run.

    A bound on the hash, from the number of rows, leaves few more than are wanted, so that
    no task sorts or sends its whole part.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    bound = int((1 << 30) * min(1.0, 1.5 * rows / max(1, df.count())))
    return df.filter(place <= bound).orderBy(place, F.xxhash64(*[col(c) for c in df.columns])).limit(rows)


def free_name(taken, wanted: str) -> str:
    """``wanted``, with underscores before it until no column has that name."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns c0, c1, ..., and which is which; ``mapInArrow`` does not take names with dots."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names
