import pytest
from pyspark.sql import functions as F

from tallymark.operators import agreement


def table(spark, n, parts=3):
    key = F.col("id")
    columns = [key.alias("k"), (key % 7).alias("v"), F.when(key % 5 != 0, F.concat(F.lit("t"), key)).alias("t"), (key / 3).alias("x")]
    return spark.range(0, n, numPartitions=parts).select(*columns)


def differing(first, second, **options):
    return sorted(map(str, agreement.differences(first, second, **options).collect()))


@pytest.mark.parametrize("key", [None, ["k"]])
@pytest.mark.parametrize(("rows_to_join", "branches"), [(1_000_000, 4096), (0, 2), (30, 5)])
def test_planted_differences(spark, key, rows_to_join, branches):
    first = table(spark, 400)
    second = first.filter("k NOT IN (3, 77)").withColumn("v", F.when(F.col("k") == 250, 99).otherwise(F.col("v")))
    # One row twice, one new row, nulls where there were values.
    second = second.unionByName(first.filter("k = 10")).unionByName(table(spark, 401).filter("k = 400"))
    second = second.withColumn("t", F.when(F.col("k") != 123, F.col("t"))).repartition(5, "v")
    want = sorted(
        map(str, first.exceptAll(second).withColumn("side", F.lit("first")).collect() + second.exceptAll(first).withColumn("side", F.lit("second")).collect())
    )
    assert len(want) == 8
    assert differing(first, second, key=key, rows_to_join=rows_to_join, branches=branches) == want


def test_equal_tables_end_after_one_aggregate_each(spark, monkeypatch):
    calls = []
    plain = agreement.fingerprints
    monkeypatch.setattr(agreement, "fingerprints", lambda *a: calls.append(a) or plain(*a))
    first = table(spark, 500)
    assert agreement.agree(first, first.orderBy(F.col("x").desc()).select("x", "t", "v", "k"), ["k"])
    assert len(calls) == 2


def test_only_ranges_that_differ_are_read_further(spark):
    first = table(spark, 3000)
    second = first.withColumn("v", F.when(F.col("k") == 1500, 99).otherwise(F.col("v")))
    leaf = [agreement.fingerprints(t, ["k"], 0, None, 64) for t in (first, second)]
    assert leaf[0].exceptAll(leaf[1]).count() == 1
    within = leaf[0].exceptAll(leaf[1]).select("_path")
    below = agreement.fingerprints(first, ["k"], 1, within, 64)
    assert below.agg(F.sum("rows")).first()[0] < 3000 / 20


def test_order_and_parts_do_not_matter_but_numbers_do(spark):
    first = table(spark, 50)
    assert agreement.agree(first, first.repartition(9))
    assert not agreement.agree(first, first.unionByName(first))
    assert not agreement.agree(first.filter("k < 1"), first.filter("k < 0"))
    assert agreement.agree(first.filter("k < 0"), first.filter("k > 100"))


def test_differences_in_every_leaf_are_not_narrowed_again(spark, monkeypatch):
    calls = []
    plain = agreement.fingerprints
    monkeypatch.setattr(agreement, "fingerprints", lambda *a: calls.append(a) or plain(*a))
    first = table(spark, 300)
    second = first.withColumn("v", F.col("v") + 1)
    found = agreement.differences(first, second, ["k"], rows_to_join=0, branches=8)
    # Two levels of each table, not four, and what is left to compare does not work the tables out again.
    assert len(calls) == 4
    assert "Range" not in found._jdf.queryExecution().toString()
    assert {r["side"]: r["count"] for r in found.groupBy("side").count().collect()} == {"first": 300, "second": 300}
