"""What is kept up by changes equals what is computed from all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import lags, lineage
from tallymark.operators.summaries import Summary


def rows_of(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def test_rounds_of_changes_give_the_full_summary(spark):
    rng = random.Random(1)
    every = [(n, rng.choice(["a", "b", None, "c"]), rng.choice([1, None]), rng.choice([-3, 0, 2, 5, 5, None])) for n in range(60)]
    table = spark.createDataFrame(every, "id long, k string, j int, x long").cache()
    kept = Summary(["k", "j"], {"total": "x"}, {"most": "x", "last": "id"}, rows="n")
    plain = Summary(["k"], {"total": "id"})
    there = set(range(0, 60, 3))
    among = lambda ids: table.filter(F.col("id").isin([-1, *ids]))
    stored, few = kept.full(among(there)), plain.full(among(there))
    for _ in range(4):
        new = set(rng.sample(sorted(set(range(60)) - there), 10))
        old = set(rng.sample(sorted(there), 8))
        there = (there | new) - old
        stored = kept.changed(stored, among(new), among(old), among(there))
        few = plain.changed(few, among(new), among(old), among(there))
        full = kept.full(among(there))
        # A sum of nulls alone is 0 once it was changed.
        assert rows_of(stored.fillna(0, ["total"])) == rows_of(full.fillna(0, ["total"]))
        assert rows_of(few) == rows_of(plain.full(among(there)))
    assert kept.changed(stored, among([]), among(there), among([])).count() == 0
    assert rows_of(kept.changed(stored, among([]), among([]), among(there))) == rows_of(stored)


def test_groups_are_read_again_only_when_their_maximum_goes(spark, monkeypatch):
    table = spark.createDataFrame([(n, "k", n) for n in range(10)], "id long, k string, x long")
    kept = Summary(["k"], {}, {"most": "x"})
    calls = []
    plain = Summary._reread
    monkeypatch.setattr(Summary, "_reread", lambda self, *a: calls.append(1) or plain(self, *a))
    stored = kept.full(table)
    assert kept.changed(stored, table.limit(0), table.filter("id = 3"), table.filter("id <> 3")).first()["most"] == 9 and not calls
    assert kept.changed(stored, table.limit(0), table.filter("id = 9"), table.filter("id <> 9")).first()["most"] == 8 and len(calls) == 1


def test_slots_bound_the_error_and_keep_the_order(spark):
    values = [*range(1000), 1023, 1024, 1025, 10**6, 10**9 + 7, 2**40, 2**62]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", lags.slot_of(F.col("v")).alias("s"))
    got = df.withColumn("end", lags.slot_end(F.col("s"))).orderBy("v").collect()
    assert [r.s for r in got] == sorted(r.s for r in got)
    assert all(r.v <= r.end <= r.v + r.v // 128 for r in got)
    assert len({r.s for r in got[:256]}) == 256


def test_quantiles_of_merged_counters(spark):
    rng = random.Random(6)
    lag = [int(rng.expovariate(1 / 90_000)) for _ in range(3000)]
    base = 1_704_067_200_000
    events = spark.createDataFrame([(base + 3_600_000 * (i % 3), x, i % 2) for i, x in enumerate(lag)], "r long, lag long, p int")
    events = events.select(F.timestamp_millis("r").alias("received"), F.timestamp_millis(F.col("r") - F.col("lag")).alias("event_time"), "p")
    parts = [lags.lag_counters(events.filter(F.col("p") == p).sample(1.0), F.col("received"), F.col("p")) for p in (0, 1)]
    both = parts[0].unionByName(parts[1])
    for share in (0.5, 0.99, 1.0):
        for keys, group in (([], lambda i: 0), (["partition"], lambda i: i % 2)):
            groups = {}
            for i, x in enumerate(lag):
                groups.setdefault(group(i), []).append(x)
            got = lags.lag_quantile(both, share, keys).collect()
            assert len(got) == len(groups)
            for r in got:
                listed = sorted(groups[r.partition if keys else 0])
                exact = listed[-(-len(listed) * round(share * 100) // 100) - 1]
                assert r.events == len(listed) and exact <= r.lag_ms <= exact + exact // 128
    early = spark.sql("SELECT timestamp'2024-01-01' AS received, timestamp'2024-01-02' AS event_time, 1 AS p")
    assert lags.lag_quantile(lags.lag_counters(early, F.col("received"), F.col("p")), 0.99).first()["lag_ms"] == 0


@pytest.mark.parametrize("batches", [1, 4])
def test_chains_extended_by_new_invoices(spark, batches):
    rng = random.Random(batches)
    links = [(n, rng.choice([None, *range(max(0, n - 6), n)]) if n else None) for n in range(80)] + [(80, 999), (81, 80)]
    table = spark.createDataFrame(links, "invoice_id long, reference_invoice_id long")
    size = -(-len(links) // batches)
    stored = spark.createDataFrame([], "invoice_id long, root_invoice_id long, depth long")
    for b in range(batches):
        new = table.filter((F.col("invoice_id") >= b * size) & (F.col("invoice_id") < (b + 1) * size))
        stored = _kept(spark, stored.unionByName(lineage.extend_chains(stored, new)))
    assert rows_of(stored) == rows_of(lineage.correction_chains(table))


def _kept(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("front", [1, 3, 1000])
def test_corrections_of_any_invoice(spark, front, monkeypatch):
    monkeypatch.setattr(lineage, "FRONT", front)
    links = [(1, None), (2, 1), (3, 1), (4, 2), (5, 4), (6, None), (7, 8), (8, 9), (9, 7), (10, 9)]
    table = spark.createDataFrame(links, "invoice_id long, reference_invoice_id long")
    depths = lambda n: {r.invoice_id: r.depth for r in lineage.corrections_of(table, n).collect()}
    assert depths(1) == {1: 0, 2: 1, 3: 1, 4: 2, 5: 3} and depths(4) == {4: 0, 5: 1} and depths(6) == {6: 0} and depths(77) == {}
    assert depths(7) == {7: 0, 9: 1, 8: 2, 10: 2}
