import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallymark.llm import packing, tokens


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_patterns_hold_every_length_once(counts):
    found = packing.patterns(counts, 30)
    held = Counter()
    for lengths, times in found:
        assert sum(lengths) <= 30 and times > 0
        for length in lengths:
            held[length] += times
    assert held == Counter(counts)
    # No two sequences of what is left would fit into one, but for at most one.
    fill = sorted(sum(lengths) for lengths, times in found for _ in range(min(times, 3)))
    assert len(fill) < 2 or fill[0] + fill[1] > 30


def test_exact_complements_leave_no_gap():
    rng = random.Random(1)
    counts = Counter()
    for _ in range(500):
        a, b = sorted(rng.sample(range(1, 2048), 2))
        counts.update([a, b - a, 2048 - b])
    found = packing.patterns(dict(counts))
    assert sum(times for _, times in found) <= 505


def test_places_of_all_pieces(docs_of):
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice(["th", "er", "é", "on"]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(rng.choice([0, 1, 30, 300, 900]))) for i in range(60)] + [(60, None), (61, ""), (62, text(9000)), (5, "twice"), (5, "twice"), (None, "no id")]
    pieces = packing.pieces(docs_of(rows)).collect()
    packed = packing.pack(packing.pieces(docs_of(rows), digest=True)).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in pieces) == sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    library = tokens.load("byte_bpe_50k.json")
    want = sorted((str(i), len(library.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    lengths = Counter()
    for r in packed:
        lengths[str(r.doc_id)] += r.length
    assert lengths == sum((Counter({i: n}) for i, n in want), Counter())
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    total = sum(n for _, n in want)
    assert len(sequences) <= -(-total // packing.CAPACITY) + 1


def test_cuts():
    assert packing.cut(0) == [] and packing.cut(1) == [(0, 1)] and packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 1), (1, 2048)] and packing.cut(4096) == [(0, 2048), (2048, 2048)]
    assert np.sum([n for _, n in packing.cut(10_001)]) == 10_001


def test_no_documents(docs_of):
    assert packing.pack(packing.pieces(docs_of([]), digest=True)).count() == 0


def _four_parts(seed):
    """2000 lengths of 350 to 800 that split into 500 full sequences."""
    rng, counts = random.Random(seed), Counter()
    while sum(counts.values()) < 2000:
        parts = [rng.randint(350, 800) for _ in range(3)]
        if 350 <= 2048 - sum(parts) <= 800:
            counts.update([*parts, 2048 - sum(parts)])
    return counts


def test_gaps_are_filled_by_three_lengths():
    for seed in range(3):
        counts = _four_parts(seed)
        found = packing.patterns(dict(counts))
        held = Counter()
        for lengths, times in found:
            held.update({x: 0 for x in lengths})
            for x in lengths:
                held[x] += times
        assert held == counts and sum(times for _, times in found) <= 518
    assert packing.patterns({512: 9}) == [([512] * 4, 2), ([512], 1)]


def test_encoder_gives_the_ids_of_the_library():
    import random

    from tallymark.llm import tokens

    encoder, library, rng = tokens.Encoder(packing.TOKENIZER, 50), tokens.load(packing.TOKENIZER), random.Random(4)
    signs = "aZé ñ.,'\"1 9\n\t-_ß×÷·ªºµ  \u0301日🙂s t re ve don't I'm ½Ⅷ²x \u2003\u00a0 \x1c\x85"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    texts += ["Grüße, naïve words;and más... (été) x1y2 O'Neill's l'été <|endoftext|> end", "a" * 5000 + "," + "é" * 3000]
    for text in texts:
        assert encoder.encode(text) == tokens.packed(library.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("forget", [False, True])
def test_workers_forget_chunks_between_tasks(spark, docs_of, forget):
    bound = 1234 + forget  # an encoder of its own
    docs = docs_of([(i, f"words number {i} and more") for i in range(40)]).repartition(1)
    got = packing.pieces(docs, chunks=bound, forget=forget).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, packing.pieces(docs).collect()))

    def kept(batches):
        for batch in batches:
            cache = tokens.encoder(packing.TOKENIZER, bound).cache
            yield pa.RecordBatch.from_pydict({"n": [len(cache.new) + len(cache.old)] * batch.num_rows})

    counts = [r.n for _ in range(8) for r in spark.range(0, 16, 1, 16).mapInArrow(kept, "n long").collect()]
    assert (max(counts) == 0) == forget
