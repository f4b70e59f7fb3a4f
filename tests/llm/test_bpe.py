import random

import numpy as np
import pytest

from tallymark.llm import bpe, tokens

PARTS = ["a", "th", "in", "the", "er", "é", "ing", "on", "aa", "'s", "1", "23", " ", "  ", "\n", "\x1c", "#$", "<|endoftext|>", "<|start", "İ", "Σ", "ß", "漢字", "\u0301", "🙂", "\x85", "'", "ll", "\t", "\xa0", " the"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.choice([1, 3, 10, 40, 200]))) for _ in range(n)]


def ids(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


def test_transducer_and_decoder_agree_with_the_library():
    name = "word_bpe_49k.json"
    library, own, names = tokens.load(name), bpe.encoder(name), bpe.token_list(name)
    for text in ["", *texts(400, 1)]:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(own.encode(text.encode())) == want, text
        assert ids(tokens.encoder(name).encode(text)) == want, text
        decoder = bpe.TokenDecoder(names)
        assert "".join(decoder.push(want[i : i + 3]) for i in range(0, len(want), 3)) == library.decode(want, skip_special_tokens=False)


def test_byte_level_chunks_agree_with_the_library():
    library, own = tokens.load("byte_bpe_50k.json"), tokens.encoder("byte_bpe_50k.json")
    for text in ["", *texts(400, 2)]:
        assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("word", ["a" * 5000, "ab" * 2500, "aab" * 1500, "ha" * 2000, "".join(random.Random(5).choice("abehinorstuwy") for _ in range(6000))])
def test_long_words_pass_through_a_bounded_window(word):
    merges = bpe.Merges("word_bpe_49k.json")
    transducer, out, most = bpe.Transducer(merges), [], 0
    for i in range(0, len(word), 100):
        out += transducer.push(word[i : i + 100])
        most = max(most, len(transducer.waiting))
    out += transducer.finish()
    assert most <= transducer.window + 100
    assert [merges.ids[t] for t in out] == tokens.load("word_bpe_49k.json").encode(word, add_special_tokens=False).ids


def test_text_decoder_waits_for_whole_characters():
    own = bpe.encoder("word_bpe_49k.json")
    vocabulary = dict(enumerate(bpe.token_list("word_bpe_49k.json")))
    decoder = bpe.TextDecoder(vocabulary)
    pieces = [p for i in ids(own.encode("naïve 漢字🙂 ok".encode())) for p in decoder.push([i])]
    assert ("".join(pieces) + decoder.finish()).split() == ["naïve", "漢字", "🙂", "ok"]


def test_caches_are_bounded():
    cache = tokens.ChunkCache(str.encode, chunks=10)
    assert cache([str(i) for i in range(100)]) == [str(i).encode() for i in range(100)]
    assert len(cache.new) <= 10 and len(cache.old) <= 10
