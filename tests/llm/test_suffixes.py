import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tallymark.llm import suffixes


def brute(texts, length):
    windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcé ") for _ in range(rng.choice([5, 20, 50, 90]))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(passages) for _ in range(rng.choice([0, 1, 3, 8]))) + "".join(rng.choice("xyz") for _ in range(rng.choice([0, 3, 30])))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "a" * 900), (63, "ab" * 200), (63, "ab" * 200), (64, rows[9][1]), (65, "q" * 39), (66, "the one and only " * 300)]
    return rows


@pytest.mark.parametrize("wide", [suffixes.WIDE, 1])
def test_against_brute_force(docs_of, wide):
    rows = corpus(3)
    got = suffixes.report(docs_of(rows), length=40, wide=wide).collect()
    want = brute([(t or "").encode() for _, t in rows], 40)
    assert sorted(map(tuple, got)) == sorted((i, *w) for (i, _), w in zip(rows, want, strict=True))


def test_matching_statistics_against_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        length, letters = rng.choice([4, 8, 20]), rng.choice([b"ab", b"abcdefgh"])
        passages = [bytes(rng.choice(letters) for _ in range(rng.choice([3, 10, 30]))) for _ in range(4)]
        segments = [b"".join(rng.choice(passages) for _ in range(rng.choice([0, 1, 4]))) + bytes(rng.choice(letters) for _ in range(5)) for _ in range(4)]
        windows = Counter(s[i : i + length] for s in segments for i in range(len(s) - length + 1))
        want, at = [], 0
        for s in segments:
            want += [at + i for i in range(len(s) - length + 1) if windows[s[i : i + length]] > 1]
            at += len(s) + 1
        assert suffixes.repeated(b"".join(s + b"\xff" for s in segments), length).tolist() == want


def test_index_stays_small():
    text = np.random.default_rng(0).integers(97, 123, 1 << 18).astype(np.uint8).tobytes()
    text += text[:1000] + b"\xff"
    tracemalloc.start()
    hits = suffixes.repeated(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hits) == 2 * (1000 - suffixes.LENGTH + 1)
    assert peak < 100 * len(text)


def test_every_window_holds_an_anchor():
    text = bytes(random.Random(2).choice(b"abc") for _ in range(3000)) + b"a" * 500
    at, _, _ = suffixes.anchors(text, 40)
    k = suffixes.anchor_length(40)
    assert all(np.any((at >= i) & (at + k <= i + 40)) for i in range(len(text) - 39))


def test_stage_keeps_rows_and_characters(docs_of):
    passage = "".join(random.Random(1).choice("éàü漢 ") for _ in range(60))
    docs = docs_of([(1, "🙂eins" + passage + "é"), (2, "zwei" + passage + "ü🙂"), (3, None), (4, "alone"), (4, "alone")])
    out = suffixes.remove(docs, length=40)
    assert out.columns == docs.columns
    texts = sorted((r.doc_id, r.text) for r in out.collect())
    assert texts == [(1, "🙂einsé"), (2, "zweiü🙂"), (3, None), (4, "alone"), (4, "alone")] or all(len(t or "") < 20 for _, t in texts)
    assert suffixes.remove(docs_of([])).count() == 0 and suffixes.report(docs_of([])).count() == 0
