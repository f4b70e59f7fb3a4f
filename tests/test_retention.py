import pytest
from pyspark.sql import functions as F

from tallymark.sources import files, tables
from tallymark.sources.retention import Retention


class Stopped(Exception):
    pass


@pytest.fixture
def moved(spark, tmp_path):
    rows = spark.range(0, 90).select("id", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int"))).alias("at"))
    rows = rows.withColumn("at", F.when(F.col("id") != 7, F.col("at")))
    live = str(tmp_path / "live")
    tables.write_by_month(rows, "at", live, "overwrite")
    return Retention(spark, live, str(tmp_path / "archive"), "at")


def parts(moved):
    live, old = (sorted(r.id for r in df.collect()) for df in (moved.live(), moved.archived()))
    return live, old


def days(limit):
    """Rows before and from day ``limit`` on; the row without a time is never old."""
    return sorted([*range(limit, 90), *([7] if limit > 7 else [])]), [n for n in range(limit) if n != 7]


@pytest.mark.parametrize("step", ["_copy", "_note", "_drop", "_note:done", "between"])
def test_a_stop_at_any_step_is_repeated(spark, moved, step, monkeypatch):
    before = parts(moved)
    name, _, only = step.partition(":")

    def stop(*args):
        if only and args[1] != only:
            return plain(*args)
        if name in ("_copy", "_drop"):
            plain(*args)
        raise Stopped

    if step == "between":
        # The months before the limit are gone, its own month is not yet put in place.
        plain_remove = files.remove
        monkeypatch.setattr(files, "remove", lambda s, p: (plain_remove(s, p), (_ for _ in ()).throw(Stopped()))[0])
    else:
        plain = getattr(moved, name)
        monkeypatch.setattr(moved, name, stop)
    with pytest.raises(Stopped):
        moved.run("a", "2024-03-15", "30 days")
    monkeypatch.undo()
    again = Retention(spark, moved.live_path, moved.archive_path, "at")
    seen = parts(again)
    assert seen == (before if step in ("_copy", "_note") else days(44))
    for _ in range(2):
        again.run("a", "2024-03-15", "30 days")
        assert parts(again) == days(44)
    assert sorted(r.id for r in spark.read.parquet(again.live_path).collect()) == days(44)[0]
    assert files.children(spark, f"{again.archive_path}/staged") == []


def test_runs_add_up_and_rows_that_come_late_wait_for_the_next(spark, moved):
    moved.run("a", "2024-02-10")
    assert parts(moved) == days(10)
    late = spark.createDataFrame([(200,)], "id long").withColumn("at", F.lit("2024-01-03").cast("timestamp"))
    tables.write_by_month(late, "at", moved.live_path, "append")
    live, old = parts(moved)
    assert 200 in live and 200 not in old
    moved.run("b", "2024-03-15")
    live, old = parts(moved)
    assert (live, old) == (days(44)[0], sorted([*days(44)[1], 200]))
    moved.run("c", "2034-03-15")
    live, old = parts(moved)
    assert live == [7] and len(old) == 90


def test_nothing_old(moved):
    moved.run("a", "2023-01-01")
    assert parts(moved) == (list(range(90)), [])
