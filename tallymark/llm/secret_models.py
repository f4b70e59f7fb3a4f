"""The models of the secret scan, counted over all texts.

``secrets.fit`` runs on built-in functions alone and learns ordinary identifiers from a bounded
sample.  Here every different text is counted: its words and numbers as they stand, tokens of the
scored length that several texts hold, and every three words in a row, joined in one of the ways
identifiers are.  Joined words are strings of Arrow columns made and counted inside tasks; only
counts of pairs of characters, four for each pair, and of scores in BINS steps reach the driver.

Texts hold about as many joined words as words, so joined ones have a weight together: that of
JOINED a text.  Equal texts count once, so one secret, however often copied, teaches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import col, slices
from tallymark.llm.secrets import (
    _BASE, _PLAIN, _VALUES, _WORDS, ALPHABET, BASE_KINDS, HIGH, LEAST, LENGTHS, LOW, MOST, NEAR, PATTERNS, RECURRING, Model, _has, _ratios,
)
from tallymark.session import stored

#: Weight of the joined words, as so many of them a text, and at least in all.
JOINED, JOINED_LEAST = 10, 20_000
#: Steps of the scores, from -MOST to MOST, that upper ones are counted in.
BINS = 80_000
#: Kinds of strings that the models are counted from.
TRAINED = ["random", "word", "known", "joined"]
#: Strings that a task counts at once.
STRINGS = 20_000


def _strings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the kind, length) of the strings of a batch, and for each character its pair with the one before."""
    column = pa.array(batch.column("value").cast(pa.large_string()))
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    codes = np.zeros(256, np.int64)
    codes[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, len(ALPHABET) + 1)
    code = codes[data]
    before = np.concatenate([[0], code[:-1]])
    # Strings begin after code 0.
    before[ends[:-1] - ends[0]] = 0
    return np.asarray(batch.column("kind")), np.diff(ends), before * (len(ALPHABET) + 1) + code


def _transitions(strings: DataFrame, make=iter) -> DataFrame:
    """(kind, a, b, n): how often character b follows a in the strings of a kind, by their codes, one row or more for each.

    ``make`` makes batches of strings of those of ``strings``; values are not empty.
    """
    size = len(ALPHABET) + 1

    def count(batches):
        n = np.zeros(len(TRAINED) * size * size, np.int64)
        for batch in slices(make(batches), STRINGS):
            kind, lengths, pairs = _strings(batch)
            n += np.bincount(np.repeat(kind, lengths) * size * size + pairs, minlength=n.size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at // size**2, at // size % size, at % size, n[at])], ["kind", "a", "b", "n"])

    return strings.mapInArrow(count, "kind long, a long, b long, n long")


def _scores(strings: DataFrame, model: Model, make=iter) -> DataFrame:
    """(kind, bin, n): how many strings of a kind score so much, one row or more for each; ``make`` as above."""
    table = np.array(model.ratios)

    def count(batches):
        n = np.zeros(len(TRAINED) * BINS, np.int64)
        for batch in slices(make(batches), STRINGS):
            kind, lengths, pairs = _strings(batch)
            score = np.add.reduceat(table[pairs], np.cumsum(lengths) - lengths) / lengths
            step = np.clip((score + MOST) * (BINS / (2 * MOST)), 0, BINS - 1).astype(np.int64)
            n += np.bincount(kind * BINS + step, minlength=n.size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at // BINS, at % BINS, n[at])], ["kind", "bin", "n"])

    return strings.mapInArrow(count, "kind long, bin long, n long")


def _different(docs: DataFrame, text_col: str) -> DataFrame:
    """Each different text once: its base values (``found``) and, outside of these, its words, tokens, and words for joining."""
    text = col(text_col).cast("string")
    rows = docs.select(text.alias("text")).filter(F.col("text").isNotNull())
    found = []
    for kind in BASE_KINDS:
        values = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(2 if kind == "assign" else 0))
        found.append(F.filter(values, lambda v, least=LENGTHS[kind]: F.length(v) >= least))
    none = F.array().cast("array<string>")
    rows = rows.select(
        F.sha2("text", 256).alias("key"), F.regexp_replace(F.regexp_replace("text", _VALUES, " "), _BASE, " ").alias("plain"),
        F.when(_has(F.col("text"), BASE_KINDS), F.concat(*found)).otherwise(none).alias("found"),
    )
    # The words for joining are of A-Z and a-z alone, so they can be lowered together.
    rows = rows.select(
        "key", "found", F.regexp_extract_all("plain", F.lit(_WORDS), F.lit(0)).alias("words"),
        F.array_distinct(F.regexp_extract_all("plain", F.lit(PATTERNS["random"]), F.lit(0))).alias("tokens"),
        F.lower(F.array_join(F.regexp_extract_all("plain", F.lit(_PLAIN), F.lit(0)), " ")).alias("listed"),
    )
    return rows.dropDuplicates(["key"]).drop("key")


def _listed_as(texts: DataFrame, kind: str, column: str) -> DataFrame:
    return texts.select(_kind(kind), F.explode(column).alias("value"))


def _kind(name: str) -> Column:
    return F.lit(TRAINED.index(name)).cast("long").alias("kind")


def _known(texts: DataFrame) -> DataFrame:
    """(kind, value): tokens of a secret's length that several texts hold."""
    known = texts.select(F.explode("tokens").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return known.filter(F.col("n") >= RECURRING).select(_kind("known"), "value")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, value): all three words in a row of the texts, joined in one of the ways below, by their hash."""
    upper, title = pc.ascii_upper, pc.ascii_capitalize
    ways = [
        lambda a, b, c, n: (a, "_", b, "_", c), lambda a, b, c, n: (upper(a), "_", upper(b), "_", upper(c)),
        lambda a, b, c, n: (a, "_", b, "_", _digits(n % 1000)), lambda a, b, c, n: (upper(a), "_", upper(b), "_", _digits(n % 1000)),
        lambda a, b, c, n: (a, title(b), title(c)), lambda a, b, c, n: (title(a), title(b), title(c)),
        lambda a, b, c, n: (title(a), title(b), _digits(n % 10)), lambda a, b, c, n: (upper(a), title(b), title(c)),
        lambda a, b, c, n: (upper(a), "-v", _digits(n % 10), "-", b, _digits(n % 10)),
        lambda a, b, c, n: (a, "-", b, "-", c), lambda a, b, c, n: ("/", a, "/", b, "/", c), lambda a, b, c, n: (a, "/", b, "/", title(c)),
        lambda a, b, c, n: (a, "/", b, _digits(n % 10), "/", c), lambda a, b, c, n: (a, b, c), lambda a, b, c, n: (a, "=", b, _digits(n % 1000)),
        lambda a, b, c, n: (_digits(n % 80 + 1970), _digits(n // 80 % 12 + 1, 2), _digits(n // 960 % 28 + 1, 2), "_", a, b),
        lambda a, b, c, n: (_digits(n % 80 + 1970), "-", _digits(n // 80 % 12 + 1, 2), "-", _digits(n // 960 % 28 + 1, 2), "T", _digits(n // 26880 % 24, 2)),
        lambda a, b, c, n: (_digits(n % 1000, 3), "-", _digits(n // 1000 % 97, 2), "-", _digits(n // 97000 % 10000, 4), "-", _digits(n % 10)),
    ]
    for batch in slices(batches, 200):
        words = pc.split_pattern(pc.fill_null(batch.column(0).cast(pa.large_string()), ""), " ")
        flat, text = words.flatten(), np.asarray(pc.list_parent_indices(words))
        first = np.flatnonzero(text[:-2] == text[2:])
        hashes = _hashes(flat)
        mixed = hashes[first] * np.uint64(3) + hashes[first + 1] * np.uint64(5) + hashes[first + 2] * np.uint64(7)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        way, number = (mixed >> np.uint64(40)) % np.uint64(len(ways)), ((mixed >> np.uint64(8)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for w, join in enumerate(ways):
            at = first[way == w]
            if len(at):
                parts = join(*(flat.take(pa.array(at + k)) for k in range(3)), number[way == w])
                value = pc.binary_join_element_wise(*(pa.scalar(x, flat.type) if isinstance(x, str) else x for x in [*parts, ""]))
                value = value.filter(pc.greater_equal(pc.binary_length(value), LENGTHS["random"]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), TRAINED.index("joined"))), value.cast(pa.string())], ["kind", "value"])


def _digits(n: np.ndarray, width: int = 0) -> pa.Array:
    return pc.ascii_lpad(pa.array(n).cast(pa.large_string()), width, "0")


def _hashes(words: pa.LargeStringArray) -> np.ndarray:
    """A number for each word, from its letters and their places."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]] if words.buffers()[2] else np.zeros(0, np.uint8)
    starts = ends - ends[0]
    place = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
    factors = np.cumprod(np.full(12, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * factors[place], dtype=np.uint64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Both models from labelled strings, and the limit between their scores; all texts are counted."""
    texts = stored(_different(docs, text_col), "secret-texts")
    random, words = _listed_as(texts, "random", "found"), _listed_as(texts, "word", "words")
    # Tokens of many texts are grouped once for both passes.
    known, listed = stored(_known(texts), "secret-known"), texts.select("listed")
    single = random.unionByName(words).unionByName(known)
    counted = _summed(_transitions(single).unionByName(_transitions(listed, _joined)))
    joined = TRAINED.index("joined")
    # Each string has one transition from code 0.
    strings = sum(r.n for r in counted if r.kind == joined and r.a == 0)
    weight = min(1.0, max(JOINED_LEAST, JOINED * texts.count()) / max(1, strings))
    model = Model(_ratios([{"kind": "word" if r.kind else "random", "a": r.a, "b": r.b, "n": r.n * weight if r.kind == joined else r.n} for r in counted]))
    mixed = random.filter(F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]"))
    low = mixed.agg(F.percentile_approx(model.score(F.col("value")), LOW, 10000)).first()[0]
    scores = _summed(_scores(known, model).unionByName(_scores(listed, model, _joined)))
    scores = sorted((r.bin, r.n * weight if r.kind == joined else r.n) for r in scores)
    if scores:
        ends = np.cumsum([n for _, n in scores])
        high = scores[int(np.searchsorted(ends, (1 - HIGH) * ends[-1]))][0] * (2 * MOST / BINS) - MOST
        model.limit = max(LEAST, high if low is None else high + NEAR * (low - high))
    return model


def _summed(counts: DataFrame) -> list:
    return counts.groupBy(*[c for c in counts.columns if c != "n"]).agg(F.sum("n").alias("n")).collect()
