import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import negatives


def brute(rows, k, m, low, high):
    usable = []
    for n, (i, label, v) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ints = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            if sum(x * x for x in ints) < 2**62:
                usable.append((n, i, label, ints))
    out = []
    for n, i, label, q in usable:
        if i % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j, o, lab) for o, j, lab, v in usable if o != n and len(v) == len(q))
        for score, j, _, _ in [s for s in scored if s[3] == label][:k]:
            near = [s for s in scored if s[3] != label and low * -score <= 100 * -s[0] <= high * -score]
            out += [(i, j, r + 1, x[1], -score, -x[0]) for r, x in enumerate(near[:m])]
    return sorted(out)


def corpus(dim, spread, n=260):
    rng = np.random.default_rng(dim)
    middles = rng.normal(size=(4, dim))
    rows = [(i, int(i % 4), [float(x) for x in np.round(middles[rng.integers(4)] + spread * rng.normal(size=dim), 2)]) for i in range(n)]
    rows += [(300 + i, int(i % 2), [1.0] * dim) for i in range(30)]  # one vector many times, ties
    rows += [(10, 0, rows[10][2]), (20, 1, [0.5] * dim), (20, 1, [0.5] * dim)]  # repeated ids
    rows += [(30, 1, [0.0] * dim), (40, 7, [-x for x in rows[3][2]]), (50, 8, rows[5][2])]
    rows += [(None, 1, [1.0] * dim), (60, None, [1.0] * dim), (70, 1, None), (80, 1, []), (90, 1, [None, *[1.0] * (dim - 1)])]
    rows += [(100, 1, [float("nan")] * dim), (110, 1, [float("-inf")] * dim), (120, 1, [1e30] * dim), (130, 2, [2.0, 1.0]), (131, 2, [1.0, 2.0]), (140, 3, [2.0, 1.5])]
    return rows + [(150, 1, [3000000.0] * dim), (151, 1, [3000000.0] * dim), (152, 2, [2900000.0] * dim)]


@pytest.mark.parametrize(("dim", "spread", "block", "held"), [(3, 1.0, 2048, 1 << 17), (16, 0.3, 13, 6), (19, 0.1, 40, 9)])
def test_against_brute_force(spark, dim, spread, block, held):
    rows = corpus(dim, spread)
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, label int, embedding array<float>, row int").repartition(3)
    vectors = negatives.integer_rows(df, "vec_id", F.col("label"), "embedding")
    got = negatives.mine(vectors, F.col("id") % 10 == 0, 3, 4, 80, 100, block, 5, held)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 4, 80, 100)


def test_bounds_hold_the_products_and_narrow():
    rng = np.random.default_rng(2)
    for dim in (1, 3, 5, 17, 64):
        a, b = (negatives.Summary(rng.integers(-500, 500, size=(30, dim)).astype(np.int32)) for _ in range(2))
        every, reach = np.arange(30), np.inf
        exact = a.products(b, every, every)
        for level in range(len(a.levels)):
            lower, upper = a.bounds(b, level, every, every)
            assert (lower <= exact).all() and (exact <= upper).all()
            assert (upper - lower).mean() <= reach
            reach = (upper - lower).mean()
    assert len(a.levels) == 3


def test_products_are_exact_where_floats_are_not():
    big = 2**29 + 1
    a = negatives.Summary(np.array([[big, big, 3]], dtype=np.int32))
    assert a.products(a, np.arange(1), np.arange(1))[0, 0] == 2 * big * big + 9


def test_pruning_leaves_few_pairs_of_clustered_vectors():
    rng = np.random.default_rng(4)
    middles = rng.integers(-100, 100, size=(8, 64))
    matrix = (middles[np.arange(400) % 8] + rng.integers(-3, 4, size=(400, 64))).astype(np.int32)
    a, b = negatives.Summary(matrix[:1]), negatives.Summary(matrix)
    exact = a.products(b, np.arange(1), np.arange(400))[0]
    least = np.array([np.sort(exact)[-20]])
    _, left = negatives.survivors(a, b, np.arange(1), np.arange(400), least, None)
    assert set(np.flatnonzero(exact >= least[0])) <= set(left) and len(left) < 200


def test_grid_holds_its_bounds():
    for candidates, anchors, cores in ((0, 0, 4), (500, 5, 8), (10**8, 10**6, 2000), (10**10, 10**8, 4000)):
        grid = negatives._grid(candidates, anchors, cores, 1 << 17)
        assert grid.rows * grid.columns >= 2 * cores
        assert anchors / grid.columns <= (1 << 16) + 1
        assert candidates * anchors / (grid.rows * grid.columns) <= negatives.PAIRS_A_TASK


def test_no_vectors_and_no_anchors(spark):
    for data in ([], [(1, 1, [1.0]), (2, 2, [1.0])], [(10, 1, [1.0])], [(10, 1, [1.0]), (11, 1, [1.0])]):
        df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
        vectors = negatives.integer_rows(df, "vec_id", F.col("label"), "embedding")
        assert negatives.mine(vectors, F.col("id") % 10 == 0).collect() == []
