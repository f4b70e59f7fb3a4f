import random
from math import comb

import pytest

from tallymark.llm import similarity
from tallymark.llm.components import components


def shingle_set(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    group, links = list(range(n)), [0] * n

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(n):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                group[top(a)] = top(b)
    first = {}
    for i, (doc, _) in enumerate(rows):
        key = (doc is None, doc)
        first[top(i)] = min(first.get(top(i), key), key)
    return [(doc, first[top(i)][1], links[i]) for i, (doc, _) in enumerate(rows)]


def corpus():
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    rows = []
    for size in (1, 1, 3, 12, 40):
        base = words(120)
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                own[rng.randrange(120)] = f"x{rng.randrange(99)}"
            rows.append(" ".join(own))
    rows += ["", None, " \n ", "", "one two", "one  two", "one two three", "a b c d e", "a b c d e f", "same " * 400, "same " * 500, " ".join(words(4000))]
    return [*enumerate(rows), (3, rows[3]), (3, rows[3]), (None, rows[5]), (None, "only without id here now")]


def rows_of(df):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in df.collect())


@pytest.mark.parametrize("block", [similarity.BLOCK_CLASSES, 7])
def test_against_brute_force(docs_of, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK_CLASSES", block)
    rows = corpus()
    assert rows_of(similarity.classes_of(docs_of(rows))) == sorted((str(a), str(b), n) for a, b, n in brute(rows))


def test_one_of_each_class_stays(docs_of):
    rows = corpus()
    docs = docs_of(rows)
    out = similarity.keep_one(docs)
    assert out.columns == docs.columns
    classes = brute(rows)
    want = [i for i, (doc, first, n) in enumerate(classes) if n == 0]
    want += list({first: i for i, (doc, first, n) in enumerate(classes) if n and doc == first}.values())
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(rows[i][0]) for i in want)


def test_no_documents(docs_of):
    assert similarity.classes_of(docs_of([])).count() == 0 and similarity.keep_one(docs_of([])).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    for n, m in similarity.needed(0.8, 1e-6):
        # One agreement fewer leaves the posterior below the tolerance.
        below = sum(comb(n + 1, j) * 0.8**j * 0.2 ** (n + 1 - j) for j in range(m))
        assert below < 1e-6 and m < 0.8 * n


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 40), (40, 35), (50, 50)] + [(100, 200 + i) for i in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 35: 30, 40: 30, 100: 100, **{200 + i: 100 for i in range(50)}}
