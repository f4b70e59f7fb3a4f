import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tallymark.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]  # noqa: B905


def buckets(text, n):
    return [zlib.crc32(f.encode()) % n for f in features(text)[1]]


def brute(rows, target, n, percent, least):
    s, t = [0] * n, [0] * n
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for b in buckets(text, n):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + n) / ((a + 1) * (sum(t) + n)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, text in rows:
        found = buckets(text, n)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((-o[3], o[0] is None, o[0] or 0) for o, (_, text) in zip(out, rows, strict=True) if len(features(text)[0]) >= least)
    return out, order[: percent * len(order) // 100]


def corpus():
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "Größe", "x9", "été", "naïve", "日本", "two-part", "it's"] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (None, rows[3][1]), (400, None), (401, ""), (402, " ,;\t\x7f "), (403, "A" * 5000)]
    return rows, [" ".join(rng.choices(words[:12], k=30)) for _ in range(9)]


def test_draw_against_brute_force(spark, docs_of):
    rows, target = corpus()
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.draw(docs_of(rows).repartition(5), bench, buckets=97, carry=["lang", "secret.key"]).collect()
    want, drawn = brute(rows, target, 97, 25, 20)
    plain = lambda r: (r[0] is None, *(x or 0 for x in r))
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=plain) == sorted(want, key=plain)
    ranked = sorted((r.rank, (-r.score, r.doc_id is None, r.doc_id or 0)) for r in got if r["rank"] is not None)
    assert [k for _, k in ranked] == drawn and [n for n, _ in ranked] == list(range(1, len(drawn) + 1))
    assert got[0]["secret.key"] == "k" and set(got[0].asDict()) == {"doc_id", "n_features", "weight", "score", "rank", "lang", "secret.key"}


def test_sample_has_the_columns_of_documents(spark, docs_of):
    rows, target = corpus()
    docs = docs_of(rows)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    kept = resampling.sample(docs, bench, percent=40, buckets=97)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in kept.collect())) == sorted(k[1:] for k in brute(rows, target, 97, 40, 20)[1])


def test_pieces_make_the_same_features():
    text = ("Alpha bEta x  " * 30 + "q" * 70 + " tail é日本 end").encode()
    whole = np.concatenate([c for _, c in resampling.checksums(text, 3)])
    for piece in (1, 2, 7, 50, 10_000):
        parts = list(resampling.checksums(text, 3, piece))
        assert sorted(np.concatenate([c for _, c in parts]).tolist()) == sorted(whole.tolist())
        assert sum(n for n, _ in parts) == len(text.translate(resampling._WORD_BYTES).split())


@pytest.mark.parametrize("parts", [1, 9])
def test_cutoff_is_exact_for_every_rank(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.randrange(4), rng.choice([None, 1, 2, 3, 4, 5]), i) for i in range(60)] + [(9, 9, 100)]
    keys = spark.createDataFrame(rows, "score long, id long, row long").repartition(parts).cache()
    order = sorted((-s, int(i is None), i or 0, r) for s, i, r in rows)
    for rank in (1, 2, 17, 30, 60, 61):
        key = resampling.cutoff(keys, rank)
        assert tuple(key) == order[rank - 1]
        assert keys.filter(resampling._not_behind(key)).count() == rank
    assert resampling.cutoff(keys, 0) is None and resampling.cutoff(keys, 62) is None


def test_one_round_drops_a_quarter_at_least():
    rng = random.Random(1)
    for _ in range(50):
        parts = [sorted(rng.randrange(1000) * 1000 + i for i in range(rng.randrange(1, 90))) for _ in range(rng.randrange(1, 12))]
        medians = [(p[(len(p) - 1) // 2], len(p)) for p in parts]
        pivot, everything = resampling.weighted_median(medians), sorted(sum(parts, []))
        place = everything.index(pivot)
        assert min(place + 1, len(everything) - place) >= len(everything) // 4


def test_no_documents_and_no_target(spark, docs_of):
    rows, _ = corpus()
    none = spark.createDataFrame([], "text string")
    assert resampling.draw(docs_of([]), none).count() == 0
    got = resampling.draw(docs_of(rows), none, buckets=97).collect()
    assert sorted((r.n_features, r.weight, r.score) for r in got) == sorted(w[1:] for w in brute(rows, [], 97, 25, 20)[0])
    with pytest.raises(ValueError, match="score"):
        resampling.draw(docs_of(rows), none, carry=["score"])
