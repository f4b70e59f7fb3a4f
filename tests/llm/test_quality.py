import random
import re

import numpy as np
import pytest

from tallymark.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " \n\t ", "one", "a b c d", "a a a a", "x y z x y z", "é🙂 ## é🙂 ##\né🙂 ## é🙂 ##\n\n  \n  \nlast", "same line\nsame line\nsame line\r\n", "a b a\x1fb",
    "word " * 40_000, "z" * 100_000, " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i}" for i in range(50)),
]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 1000 else set(range(len(words)))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def corpus(n, seed):
    """Ordinary texts and three kinds of junk, with labels."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice(["th", "er", "in", "on", "ea"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(60, 200))]
        kind = i % 12
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        elif kind == 1:
            words = [w + rng.choice(["$$$", "###"]) for w in words]
        elif kind == 2:
            words = [x for w in words for x in (w, "|")]
        out.append((i, " ".join(words).capitalize(), int(kind > 2)))
    return out


def test_counts_against_plain_rules(spark, docs_of):
    docs = docs_of([*enumerate(TEXTS), (3, TEXTS[3])])
    rows = quality.statistics(docs, quality.Judge(None, 1.0)).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        want = plain(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, TEXTS[r.doc_id]
        assert r.kept == (not r.base_failed)


@pytest.fixture(scope="module")
def fitted(spark):
    train = corpus(600, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in train], "doc_id long, text string")
    labels = [(i, q, 0) for i, _, q in train] + [(None, 1, 0), (5, None, 0), (99_999, 0, 0), (train[3][0], 0, 0)]
    return quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents(fitted):
    held_out = corpus(600, 2)
    counts, shares = zip(*[quality.text_statistics(t.encode()) for _, t, _ in held_out], strict=True)
    kept, _ = fitted.kept(np.array(counts), np.array(shares))
    good = np.array([q for *_, q in held_out], dtype=bool)
    assert (kept & ~good).sum() <= 0.05 * (~good).sum()
    assert (~kept & good).sum() <= 0.01 * good.sum()


def test_stage_keeps_rows_whole(fitted, docs_of):
    docs = docs_of([(i, t) for i, t, _ in corpus(60, 3)] + [(1000, None), (1001, ""), (5, corpus(60, 3)[5][1])])
    out = quality.keep_good(docs, fitted)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted([5, *(i for i, _, q in corpus(60, 3) if q)])


def test_without_labels_or_documents(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judge = quality.fit(docs_of([(1, " ".join(f"w{i}" for i in range(60)))]), none)
    assert judge.forest is None
    empty = docs_of([])
    assert quality.statistics(empty, quality.fit(empty, none)).count() == 0
    assert quality.keep_good(empty, judge).count() == 0


def test_scores_are_path_lengths():
    rows = np.random.default_rng(0).normal(size=(500, 2))
    forest = quality.Forest.grow(rows)
    score = forest.score(np.array([[0.0, 0.0], [8.0, 8.0]]))
    assert 0 < score[0] < score[1] < 1


def _odd(kind, text, rng):
    words = text.split()
    if kind == "lines":
        return "\n".join([text] + [" ".join(words[:3])] * max(8, len(words) // 15))
    if kind == "repeats":
        k = len(words) // 5
        return " ".join(words[:-k] + words[:k])
    if kind == "long words":
        return " ".join("".join(words[i : i + 3]) for i in range(0, len(words) - 2, 3))
    add = {"symbols": "#", "marks": "!"}.get(kind)
    return " ".join(w.upper() if add is None and rng.random() < 0.2 else w + (add or "") * (rng.random() < 0.2) for w in words)


def test_odd_statistics_that_no_label_shows(fitted):
    rng = random.Random(5)
    good = [t for _, t, q in corpus(600, 4) if q and len(t.split()) > 160]
    for kind in ("lines", "repeats", "long words", "symbols", "marks", "capitals"):
        counts, shares = (np.array(x) for x in zip(*[quality.text_statistics(_odd(kind, t, rng).encode()) for t in good], strict=True))
        fine = ~quality.base_failed(counts)
        kept, _ = fitted.kept(counts, shares)
        assert fine.sum() >= 20 and kept[fine].mean() <= 0.2, (kind, fine.sum(), kept[fine].mean())
