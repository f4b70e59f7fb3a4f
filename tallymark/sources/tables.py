"""Stored tables: scans, snapshots, change sets, retention.

There is no in-place update: a change writes the next snapshot of a table, and
append-only tables grow by partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.functions import values as V
from tallymark.operators.skew import keyed_join
from tallymark.schemas import TABLES

# Event-like tables are laid out by month of these times, so that scans prune.
TIME_COLUMNS = {
    "telemetry_events": "event_time",
    "aggregated_usage": "window_start",
    "rated_charges": "created_at",
    "invoices": "billing_period_start",
}
MONTH = "month"


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Scan with the declared schema; the month partition is added where there is one."""
    schema = TABLES[name]
    if name in TIME_COLUMNS:
        schema += f", {MONTH} string"
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str, name: str, mode: str = "append") -> None:
    """Write with the declared columns, partitioned by month where the table has a time."""
    fields = StructType.fromDDL(TABLES[name]).fields
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in fields if f.name in df.columns])
    if name not in TIME_COLUMNS:
        rows.write.mode(mode).parquet(path)
        return
    write_by_month(rows, TIME_COLUMNS[name], path, mode)


def write_by_month(rows: DataFrame, time: str, path: str, mode: str) -> None:
    """Rows of a month meet in few files; a heavy month is split, light ones merged."""
    dated = rows.withColumn(MONTH, V.month_key(time))
    dated.hint("rebalance", F.col(MONTH)).write.mode(mode).partitionBy(MONTH).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int) -> DataFrame:
    """Parallel scan of a database table, split by a numeric key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts)


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Next snapshot: new rows added, given fields replaced, null fields kept.

    ``changes`` has at most one row per key and any of the table's columns.
    """
    given = [c for c in changes.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in given])
    joined = current.join(new, key, "full_outer")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in given else F.col(c) for c in current.columns]
    )


def delete(current: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(next snapshot, ids that were not there)."""
    asked = ids.select(key).distinct()
    return current.join(asked, key, "left_anti"), asked.join(current.select(key), key, "left_anti")


def append_checked(
    current: DataFrame, new: DataFrame, parents: DataFrame, parent_key: str, reason: str
) -> tuple[DataFrame, DataFrame]:
    """(table with the new rows whose parent exists, refused rows with reason); many rows may have one parent."""
    known = parents.select(parent_key).distinct().withColumn("_known", F.lit(True))
    judged = keyed_join(new, known, [parent_key], [c for c in new.columns if c != parent_key])
    accepted = judged.filter("_known").select(*new.columns)
    refused = judged.filter("_known IS NULL").select(*new.columns).withColumn("reason", F.lit(reason))
    return current.unionByName(accepted), refused


def split_by_age(table: DataFrame, time: str, as_of, keep: str = "30 days") -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows for the archive)."""
    old = F.col(time) < V.before(as_of, keep)
    return table.filter(~old), table.filter(old)


def archive(table: DataFrame, time: str, as_of, live_path: str, archive_path: str, keep: str = "30 days") -> None:
    """Write both parts, each laid out by month; the source is left as it is."""
    live, old = split_by_age(table, time, as_of, keep)
    write_by_month(old, time, archive_path, "append")
    write_by_month(live, time, live_path, "overwrite")
