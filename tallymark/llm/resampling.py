"""Target-distribution importance resampling with an exact, distributed cutoff.

Features are hashed runs of words.  Counts of all documents and of the target texts, two
arrays of fixed length, give one gain per bucket; a document's weight is the floored mean
gain of its features, read from the array with one lookup per feature.  A random number
that depends on seed and id alone (a Gumbel variable) is added, so that the highest scores
are a weighted draw without replacement.

The last key drawn is found by weighted median of medians: each partition names the median
of its remaining keys and their number, the median of these weighted by the numbers is the
pivot, and one count splits the remaining keys.  At least a quarter of them goes in every
round, one job each, until the pivot is the cutoff itself.  Only then the winners are
sorted, by ranges.  The driver sees one row per partition and round.

Keys are unique: score, then id, then the number of the row.  Defined cases: null and empty
texts have no features and weight 0.  Null ids count as the empty id in the random number
and come last among equal scores.  Rows with the same id are drawn one by one; which of
those with equal scores come first is arbitrary, but only one order is used throughout.
Long texts are read in pieces of PIECE bytes, a run of words may span pieces.  An empty
target gives every bucket its add-one share; of an empty table nothing is drawn.  Carried
columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallymark.llm.common import col, doc_bytes, slices
from tallymark.operators.scans import numbered
from tallymark.session import work_path

BUCKETS = 10_000
#: Bytes of a text that are cut into words at a time; a longer word makes a longer piece.
PIECE = 1 << 20
#: Documents handled at a time.
DOCS = 500

# Letters and digits, all other ASCII to blanks, A-Z to a-z; the bytes of other characters belong to words.
_WORD_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _and_blank(crcs: list[int]) -> list[int]:
    """The checksums of the same bytes with a blank behind them."""
    state = np.array(crcs, dtype=np.uint32) ^ np.uint32(0xFFFFFFFF)
    return (_CRC[(state ^ 0x20) & 0xFF] ^ (state >> np.uint32(8)) ^ np.uint32(0xFFFFFFFF)).tolist()


def _word_lists(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, a piece at a time; pieces end where a word does."""
    start = 0
    while start < len(text):
        part = text[start : start + piece].translate(_WORD_BYTES)
        start += len(part)
        while start < len(text) and part[-1:] != b" ":
            more = text[start : start + piece].translate(_WORD_BYTES)
            cut = more.find(b" ")
            more = more if cut < 0 else more[: cut + 1]
            part += more
            start += len(more)
        yield part.split()


def checksums(text: bytes, longest: int = 2, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """(words, CRC-32 of every run of 1 to ``longest`` words) for each piece of a text."""
    # Of the runs of every length, the one that ended the piece before.
    last: list[int | None] = [None] * longest
    for words in _word_lists(text, piece):
        if not words:
            continue
        ends, levels, ended = list(map(crc32, words)), [], []
        for length in range(longest):
            if length:
                # A run of one more word goes on from the run that ends one word before.
                before = ends[:-1] if last[length - 1] is None else [last[length - 1], *ends[:-1]]
                ends = list(map(crc32, words[len(words) - len(before) :], _and_blank(before)))
            levels += ends
            ended.append(ends[-1] if ends else None)
        last = ended
        yield len(words), np.array(levels, dtype=np.uint32)


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = 2, buckets: int = BUCKETS) -> np.ndarray:
    """How often the features of each bucket occur in all texts; an array of ``buckets`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices([batch], DOCS):
                for text in doc_bytes(part, "t"):
                    for _, crcs in checksums(text, longest):
                        total += np.bincount(crcs % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    counted = texts.select(col(text_col).cast("string").alias("t")).mapInArrow(run, "bucket int, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target share to source share per bucket, one added to every count."""
    n = len(source)
    source_all, target_all = float(int(source.sum()) + n), float(int(target.sum()) + n)
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * source_all / ((s + 1) * target_all))) for s, t in pairs], dtype=np.int64)


class Key(NamedTuple):
    """Place of a row in the draw; smaller keys are drawn first."""

    minus_score: int
    no_id: int
    id: int
    row: int


def scored(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), longest: int = 2, seed: int = 7
) -> DataFrame:
    """(id, row, n_words, n_features, weight, score, c0, c1, ...) of every row, written once; c0, c1, ... are carried columns."""
    spark, buckets = docs.sparkSession, len(gain)
    given = [F.col(f"c{i}") for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], DOCS):
                rows = []
                for text in doc_bytes(part, "t"):
                    words = features = total = 0
                    for n, crcs in checksums(text, longest):
                        words, features = words + n, features + len(crcs)
                        total += int(gain[crcs % buckets].sum())
                    rows.append((words, features, total // features if features else 0))
                place = part.schema.get_field_index("t")
                columns = [c for i, c in enumerate(part.columns) if i != place]
                found = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                names = [n for n in part.schema.names if n != "t"]
                yield pa.RecordBatch.from_arrays([*columns, *found], names=[*names, "n_words", "n_features", "weight"])

    rows = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("t"), *[col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    counts = [StructField(n, LongType()) for n in ("n_words", "n_features", "weight")]
    out = rows.mapInArrow(run, StructType([*rows.drop("t").schema.fields, *counts]))
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(drawn, 256), 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform))).cast("long")
    path = work_path(spark, "scored")
    out.withColumn("score", score).select("id", "row", "n_words", "n_features", "weight", "score", *given).write.parquet(path)
    return spark.read.parquet(path)


_REPORT = "side int, n long, minus_score long, no_id int, id long, row long"


def _medians(keys: DataFrame, above: Key | None, below: Key | None, pivot: Key | None) -> list:
    """Per partition and side of the pivot (0 before it, 1 behind it): number and median of the keys between the bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [[c.to_numpy() for c in b.columns] for b in batches]
        if not read:
            return
        parts = [np.concatenate(c) for c in zip(*read, strict=True)]

        def before(key: Key) -> np.ndarray:
            less, equal = np.zeros(len(parts[0]), dtype=bool), np.ones(len(parts[0]), dtype=bool)
            for values, bound in zip(parts, key, strict=True):
                less |= equal & (values < bound)
                equal &= values == bound
            return less

        def upto(key: Key) -> np.ndarray:
            return before(key._replace(row=key.row + 1))

        held = np.ones(len(parts[0]), dtype=bool)
        if above is not None:
            held &= ~upto(above)
        if below is not None:
            held &= before(below)
        sides = [held] if pivot is None else [held & before(pivot), held & ~upto(pivot)]
        out = []
        for side, chosen in enumerate(sides):
            index = np.flatnonzero(chosen)
            if len(index):
                order = np.lexsort([p[index] for p in reversed(parts)])
                middle = index[order[(len(index) - 1) // 2]]
                out.append((side, len(index), *(int(p[middle]) for p in parts)))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        names = ["side", "n", "minus_score", "no_id", "id", "row"]
        for row in out:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    wanted = keys
    # The scan skips what lies outside the bounds.
    if above is not None:
        wanted = wanted.filter(F.col("score") <= -above.minus_score)
    if below is not None:
        wanted = wanted.filter(F.col("score") >= -below.minus_score)
    order = [(-F.col("score")).alias("minus_score"), F.col("id").isNull().cast("int").alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), F.col("row")]
    return wanted.select(*order).mapInArrow(run, _REPORT).collect()


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The first key, in order, up to which the weights reach half of their sum."""
    half, seen = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        seen += n
        if 2 * seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, rank: int) -> Key | None:
    """The key with ``rank`` (from 1) among all rows (score, id, row); None where there are fewer rows."""
    if rank < 1:
        return None
    above = below = pivot = None
    reports = _medians(keys, above, below, pivot)
    if sum(r.n for r in reports) < rank:
        return None
    side = 0
    while True:
        pivot = weighted_median([(Key(r.minus_score, r.no_id, r.id, r.row), r.n) for r in reports if r.side == side])
        reports = _medians(keys, above, below, pivot)
        first = sum(r.n for r in reports if r.side == 0)
        if rank == first + 1:
            return pivot
        if rank <= first:
            side, below = 0, pivot
        else:
            side, above, rank = 1, pivot, rank - first - 1


def _not_behind(key: Key) -> Column:
    """Whether a row's key is this one or comes before it."""
    same = F.col("score") == -key.minus_score
    in_row = (F.col("id").isNull() if key.no_id else F.col("id") == key.id) & (F.col("row") <= key.row)
    by_id = F.lit(False) if key.no_id else F.col("id") < key.id
    # A null id comes after all others.
    by_id = F.col("id").isNotNull() if key.no_id else by_id
    return F.coalesce((F.col("score") > -key.minus_score) | (same & (by_id | in_row)), F.lit(False))


def draw(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = 25,
    min_words: int = 20,
    carry: Sequence[str] = (),
    longest: int = 2,
    buckets: int = BUCKETS,
    seed: int = 7,
) -> DataFrame:
    """All rows with n_features, weight, score and their rank in the draw; null rank: not drawn.

    Of the rows with at least ``min_words`` words, ``percent`` of a hundred are drawn, rounded
    down.  Returns the id (under its name), n_features, weight, score, rank and the carried
    columns, which must not have those names.
    """
    clashes = {id_col.lower(), "n_features", "weight", "score", "rank"} & {c.lower() for c in carry}
    if clashes:
        raise ValueError(f"carried columns clash with those of the result: {sorted(clashes)}")
    out, last = _drawn(docs, target, id_col, text_col, target_col, percent, min_words, carry, longest, buckets, seed)
    taken = F.lit(False) if last is None else (F.col("n_words") >= min_words) & _not_behind(last)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    winners = numbered(out.filter(taken), "rank", order)
    rest = out.filter(~taken).withColumn("rank", F.lit(None).cast("long"))
    rows = winners.unionByName(rest)
    return rows.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])


def sample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 25,
           min_words: int = 20, longest: int = 2, buckets: int = BUCKETS, seed: int = 7) -> DataFrame:
    """The rows that are drawn, with the columns of ``docs``."""
    out, last = _drawn(docs, target, id_col, text_col, target_col, percent, min_words, docs.columns, longest, buckets, seed)
    taken = F.lit(False) if last is None else (F.col("n_words") >= min_words) & _not_behind(last)
    return out.filter(taken).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _drawn(docs, target, id_col, text_col, target_col, percent, min_words, carry, longest, buckets, seed) -> tuple[DataFrame, Key | None]:
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets))
    out = scored(docs, gain, id_col, text_col, carry, longest, seed)
    eligible = out.filter(F.col("n_words") >= min_words)
    return out, cutoff(eligible, percent * eligible.count() // 100)
