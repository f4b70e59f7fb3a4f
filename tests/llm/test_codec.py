import zlib

import numpy as np
import pytest

from tallymark.llm import codec, tokens
from tallymark.session import work_path


def stream(n, vocabulary, seed):
    ids = np.random.default_rng(seed).integers(0, vocabulary, n).astype("<u4")
    ids[n // 2 : n // 2 * 2] = ids[: n // 2]  # a repeat
    ids[: n // 8] = 3  # a run
    return ids


@pytest.mark.parametrize(("n", "vocabulary", "block"), [(0, 49408, 4096), (1, 49408, 4096), (5, 300, 2), (9000, 70000, 4096), (20_000, 49408, 1000), (300, 1, 64)])
def test_round_trip(n, vocabulary, block):
    ids = stream(n, vocabulary, n)
    docs = [(None, b""), (-7, ids[: n // 3].tobytes()), (8, b""), (8, ids[n // 3 :].tobytes())]
    got = list(codec.read_segment(codec.write_segment(docs, vocabulary, block)))
    assert [(doc, x.tobytes()) for doc, x in got] == docs


def test_repeats_are_cheap_and_noise_costs_little_more_than_itself():
    noise = np.random.default_rng(0).integers(0, 49408, 8000).astype("<u4")
    assert len(codec.write_segment([(1, noise.tobytes())], 49408)) < 2.15 * len(noise)
    again = np.tile(noise[:100], 80)
    assert len(codec.write_segment([(1, again.tobytes())], 49408)) < 0.5 * len(again)


def test_damage_is_found():
    data = bytearray(codec.write_segment([(1, stream(9000, 49408, 1).tobytes())], 49408))
    for at in (30, len(data) - 2000):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            list(codec.read_segment(bytes(bad)))
    with pytest.raises(ValueError, match="format"):
        list(codec.read_segment(b"none" + bytes(data[4:])))
    for size in (0, 5, 40, len(data) // 2, len(data) - 1):
        with pytest.raises(ValueError, match="cut off|damaged"):
            list(codec.read_segment(bytes(data[:size])))


def test_files_of_documents(spark, docs_of):
    rows = [(9, "the last"), (2, None), (4, "one two three " * 50), (4, "again"), (3, ""), (7, "é🙂 " * 30), (None, "no id"), (2, "null's twin")]
    path = work_path(spark, "codec-test")
    codec.write(docs_of(rows), path)
    got = codec.read(spark, path).collect()
    library = tokens.load(codec.TOKENIZER)
    # Null first, then by id, then by text, null before all.
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, []
    for doc, text in order:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, codec.END_ID]
        want.append((doc, start, len(ids), np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    digests = {r.start: r.ids_crc32 for r in codec.read(spark, path, digest=True).collect()}
    assert digests == {r[1]: zlib.crc32(r[3]) for r in want}


def test_no_documents(spark, docs_of):
    assert codec.round_trip(docs_of([])).count() == 0
