import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import topk


def brute(rows, k):
    ints = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            floors = [int(np.floor(256 * np.float32(x).astype(np.float64))) for x in v]
            if sum(x * x for x in floors) < 2**62:
                ints[n] = (i, floors)
    out = []
    for n, (i, q) in ints.items():
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, (j, v) in ints.items() if m != n and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("block", "bins"), [(7, 4), (4096, 2048)])
def test_against_brute_force_with_ties_and_unusable_rows(spark, block, bins):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(220)]
    rows += [(300 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]  # one vector many times
    rows += [(50, [0.1, None, 0.2, 0.3]), (None, [1.0] * 4), (400, None), (450, []), (500, [float("nan")] * 4), (550, [float("inf")] * 4), (600, [1.0, 2.0])]
    rows += [(50, [0.1, 0.2, 0.3, 0.4]), (50, [0.1, 0.2, 0.3, 0.4]), (100, rows[100][1]), (650, [1.0, 2.0]), (7, [3e30] * 4)]  # repeated ids and rows, too long
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, id int")
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    got = topk.top_k(vectors, vectors.filter(F.col("id") % 50 == 0), 5, block, 3, bins)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    assert topk.top_k(vectors, vectors, 5).count() == 0
