"""Tables that grow by batches: few files, nothing lost by a stop, known ids found without reading all."""

import pytest
from pyspark.sql import functions as F

from tallymark.operators import metering
from tallymark.plans import workload
from tallymark.sources import files
from tallymark.sources.known_ids import KnownIds
from tallymark.sources.levels import LeveledTable
from tallymark.streaming import jobs


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def summed(rows):
    return rows.groupBy("k", "month").agg(F.sum("n").alias("n"))


def batch_rows(spark, batch):
    """Three keys in two months, one key in every batch."""
    values = [("all", "2024-01", batch), (f"k{batch % 7}", "2024-02", 1), ("all", "2024-02", 1)]
    return spark.createDataFrame(values, "k string, month string, n long").coalesce(1)


def files_by_month(table):
    found = {}
    for file in table.read().inputFiles():
        month = next(p for p in file.split("/") if p.startswith("month="))
        found[month] = found.get(month, 0) + 1
    return found


def test_a_hundred_batches_stay_in_few_files(spark, tmp_path):
    table = LeveledTable(spark, str(tmp_path / "t"), ["month"], summed)
    most = 0
    for batch in range(100):
        table.add(batch, batch_rows(spark, batch))
        most = max(most, len(table.runs()))
    assert most <= 10 and len(table.runs()) == 4
    assert max(files_by_month(table).values()) <= 10
    got = {(r.k, r.month): r.n for r in summed(table.read()).collect()}
    assert got[("all", "2024-01")] == sum(range(100)) and got[("all", "2024-02")] == 100
    assert sum(n for (k, _), n in got.items() if k != "all") == 100
    # One month is read from its own folders alone, and merged runs are gone from the disk.
    one = table.read(F.col("month") == "2024-01")
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()
    kept, there = {f"run_name={r.name}" for r in table.runs()}, files.children(spark, str(tmp_path / "t" / "runs"))
    assert kept <= set(there) and len(there) < 20
    # A batch that comes again counts once, whether it was merged or not.
    for batch in (3, 99):
        table.add(batch, batch_rows(spark, batch))
    assert {(r.k, r.month): r.n for r in summed(table.read()).collect()} == got


@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_a_stopped_merge_loses_nothing(spark, tmp_path, step, monkeypatch):
    table = LeveledTable(spark, str(tmp_path / "t"), ["month"], summed, fanout=3)
    for batch in range(2):
        table.add(batch, batch_rows(spark, batch))
    plain = getattr(table, step)

    def stop(*args):
        """The write itself of the third batch passes, the merge after it does not."""
        merging = args[2] > 0 if step == "_write" else any(r.level for r in args[0])
        if not merging:
            return plain(*args)
        if step == "_write":
            plain(*args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(table, step, stop)
    with pytest.raises(RuntimeError):
        table.add(2, batch_rows(spark, 2))
    again = LeveledTable(spark, str(tmp_path / "t"), ["month"], summed, fanout=3)
    assert [r.level for r in again.runs()] == [0, 0, 0] and again.read().count() == 9
    again.add(2, batch_rows(spark, 2))
    assert [(r.level, r.first, r.last) for r in again.runs()] == [(1, 0, 2)]
    assert {(r.k, r.month): r.n for r in summed(again.read()).collect()}[("all", "2024-01")] == 3


def test_empty_batches_and_tables(spark, tmp_path):
    table = LeveledTable(spark, str(tmp_path / "t"), ["month"], summed, fanout=2)
    assert table.read() is None and table.runs() == []
    none = batch_rows(spark, 0).filter("n < 0")
    for batch in range(3):
        table.add(batch, none)
    assert table.read().count() == 0
    table.add(3, batch_rows(spark, 3))
    assert table.read().count() == 3
    with pytest.raises(ValueError):
        LeveledTable(spark, "x", ["month"], fanout=1)


def ids_of(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("event-"), F.col("id")).alias("event_id"))


def test_known_ids_open_only_what_may_hold_them(spark, tmp_path):
    index = KnownIds(spark, str(tmp_path / "ids"), buckets=16, fanout=4)
    for batch in range(6):
        index.add(batch, ids_of(spark, batch * 2000, batch * 2000 + 2000))
    runs = index.table.runs()
    assert [(r.first, r.last) for r in runs] == [(0, 3), (4, 4), (5, 5)]
    stored = len(index.table.read().inputFiles())
    # New ids open next to nothing, copies of three ids their buckets alone.
    fresh = ids_of(spark, 100_000, 102_000)
    maybe = index.maybe(fresh, runs)
    assert maybe.count() <= 25 and index.known(fresh).count() == 0
    few = ids_of(spark, 10_500, 10_503)
    opened = index.opened(index.maybe(few, runs), runs)
    read = spark.read.parquet(*opened).inputFiles()
    assert 1 <= len(read) <= 4 < stored
    assert {r.event_id for r in index.known(few.union(fresh)).collect()} == {f"event-{n}" for n in (10_500, 10_501, 10_502)}
    # All ids there are, each once, and none of the batch that asks.
    every = ids_of(spark, 0, 13_000)
    assert index.known(every).count() == 12_000 and index.known(every, 5).count() == 10_000
    assert index.known(every, 2).count() == 10_000
    # A batch noted twice, and rows without an id.
    index.add(5, ids_of(spark, 10_000, 12_000))
    index.add(6, spark.createDataFrame([(None,), ("event-1x",)], "event_id string"))
    assert index.known(every).count() == 12_000 and index.known(spark.createDataFrame([(None,)], "event_id string")).count() == 0


def test_ids_of_other_types(spark, tmp_path):
    index = KnownIds(spark, str(tmp_path / "ids"))
    ids = spark.range(5).withColumnRenamed("id", "event_id")
    assert index.known(ids).count() == 0
    index.add(0, ids)
    got = index.known(spark.range(3, 9).withColumnRenamed("id", "event_id"))
    assert got.schema["event_id"].dataType.typeName() == "long" and sorted(r.event_id for r in got.collect()) == [3, 4]


def test_merged_parts_are_the_usage_and_final_runs_read_their_months(spark, sf_dir, tmp_path):
    events = workload.telemetry(spark, sf_dir)
    out = str(tmp_path / "out")
    store = jobs.usage_store(spark, out, fanout=2)
    on_time, _ = metering.split_late(events, F.col("ingestion_time"))
    keys = ["customer_id", "metric_type", F.window("event_time", "1 hour")["start"].alias("window_start")]
    for batch in range(5):
        parts = on_time.filter(F.col("event_id") % 5 == batch).groupBy(*keys).agg(*metering.partial_aggregates())
        store.add(batch, parts.withColumn("month", F.date_format("window_start", "yyyy-MM")))
    assert [r.level for r in store.runs()] == [2, 0]
    assert same(jobs.current_usage(spark, out), metering.meter(on_time))
    whole = metering.finalise(metering.meter(on_time), "2024-02-02 00:00:00").filter("is_final")
    for run, as_of in (("a", "2024-01-10 00:30:00"), ("b", "2024-01-20 12:30:00"), ("b", "2024-01-20 12:30:00"), ("c", "2024-02-02 00:00:00")):
        stored = jobs.finalise_due(spark, out, as_of, run)
        assert stored.count() > 0
    final = jobs.finalised_usage(spark, out)
    assert same(final.select("aggregation_id", "value", "event_count"), whole.select("aggregation_id", "value", "event_count"))
    assert files.children(spark, f"{out}/final_usage")[-1] == "month=2024-01"
