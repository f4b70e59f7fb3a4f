"""Quality rules: rule statistics of whole texts, judged by fixed rules and an isolation forest.

Random splits isolate unusual rows early, so a short mean path over the trees marks a
document whose statistics are unlike the others'.  Trees grow from a bounded sample of
rows labelled good (``TRAIN_ROWS``, the smallest hashes of their ids), so that junk of one
kind, however frequent, is never ordinary.  Cuts reach beyond the rows of a node by a
margin for each statistic (``MARGINS``), so that what ordinary rows all share, such as no
symbols at all, tells others apart too.  The score above which a document is rejected is
calibrated on all labelled rows.

Defined cases: a null or blank text has no words and fails the base rule.  Labels that
are null or name no document are ignored; contradicting labels of one id count as good.
Without labels of both kinds the forest rejects nothing.  Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded_sample, col, doc_bytes, plain_names, slices, values

#: Labelled rows the trees may grow from, trees, and rows per tree.
TRAIN_ROWS, TREES, SAMPLE = 8192, 100, 1024
#: Share of the good labelled rows that calibration may give up, and score bins.
GIVE_UP, SCORE_BINS = 0.002, 2000

# Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"

_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_FOLLOWING = bytes(range(0x80, 0xC0))  # all but the first byte of a character
_NOT_IN_WORDS = _SPACE + _FOLLOWING
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"!?"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics the forest looks at, and how far cuts go beyond the values of a node's rows.
MARGINS = {"symbol_share": 0.03, "upper_share": 0.05, "mark_share": 0.03, "dup_line_share": 0.1, "repeat_word_share": 0.1, "word_length": 2.0, "log_words": 1.0}
FEATURES = list(MARGINS)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * len(index) + ids[1:]
    _, pair = np.unique(pair, return_inverse=True)
    _, which, n = np.unique(pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    again = n[which] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= again
    return int(covered.sum())


def text_statistics(text: bytes) -> tuple[list[int], list[float]]:
    """Rule statistics of a UTF-8 text: the counts, and what the forest looks at."""
    words = text.split()
    word_chars = len(text.translate(None, _NOT_IN_WORDS))
    symbols, upper, marks = (len(text) - len(text.translate(None, kind)) for kind in (SYMBOLS, _UPPER, _MARKS))
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    dup_lines, repeat_words, n_words = len(lines) - len(set(lines)), _repeat_words(words), max(1, len(words))
    shares = [n / max(1, word_chars) for n in (symbols, upper, marks)]
    shares += [dup_lines / max(1, len(lines)), repeat_words / n_words, word_chars / n_words, math.log(n_words)]
    return [len(words), word_chars, symbols, dup_lines, repeat_words], shares


def _statistics_of(batch: pa.RecordBatch, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    found = [text_statistics(t) for t in doc_bytes(batch, text_col)]
    counts = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, len(COUNTS))
    return counts, np.array([f[1] for f in found], dtype=np.float64).reshape(-1, len(FEATURES))


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def _usual_path(n):
    """Mean path length in a random tree over n rows."""
    n = np.asarray(n, dtype=np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays (tree, node): split feature (-1 at a leaf), threshold, left child, path length at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    length: np.ndarray
    usual: float

    @staticmethod
    def grow(rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7, margins=0.0) -> Forest:
        """Trees over samples of the rows; a node that only the margin of a cut reaches is an empty leaf."""
        rng = np.random.default_rng(seed)
        size = min(sample, len(rows))
        # Cuts in the margins part no rows, so there are more of them on the way to a single row.
        depth = max(1, int(np.ceil(np.log2(max(2, size))))) * (2 if np.any(margins) else 1)
        grown = []
        for _ in range(trees):
            nodes: list[list] = [[-1, 0.0, 0, 0.0]]
            todo = [(0, rows[rng.choice(len(rows), size, replace=False)], 0)]
            while todo:
                at, here, level = todo.pop()
                low, high = (here.min(axis=0) - margins, here.max(axis=0) + margins) if len(here) else (0.0, 0.0)
                open_ = np.flatnonzero(high > low)
                if level >= depth or len(here) < 2 or not len(open_):
                    nodes[at] = [-1, 0.0, 0, level + float(_usual_path(len(here)))]
                    continue
                f = int(rng.choice(open_))
                cut = float(rng.uniform(low[f], high[f]))
                nodes[at] = [f, cut, len(nodes), 0.0]
                nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
                below = here[:, f] <= cut
                todo += [(len(nodes) - 2, here[below], level + 1), (len(nodes) - 1, here[~below], level + 1)]
            grown.append(nodes)
        most = max(map(len, grown))
        table = np.zeros((trees, most, 4))
        table[:, :, 0] = -1
        for t, nodes in enumerate(grown):
            table[t, : len(nodes)] = nodes
        return Forest(table[:, :, 0].astype(np.int32), table[:, :, 1], table[:, :, 2].astype(np.int32), table[:, :, 3], max(float(_usual_path(size)), 1.0))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, larger for rows that random splits isolate sooner."""
        total = np.zeros(len(rows))
        at_row = np.arange(len(rows))
        for feature, threshold, left, length in zip(self.feature, self.threshold, self.left, self.length, strict=True):
            node = np.zeros(len(rows), dtype=np.int32)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = rows[at_row, np.maximum(f, 0)] > threshold[node]
                node = np.where(inner, left[node] + right, node)
            total += length[node]
        return np.exp2(-total / len(self.feature) / self.usual)


@dataclass
class Judge:
    """A grown forest and the score above which documents go; without labels there is none."""

    forest: Forest | None
    limit: float

    def kept(self, counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = np.zeros(len(counts)) if self.forest is None or not len(counts) else self.forest.score(shares)
        return ~base_failed(counts) & (score <= self.limit), score


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Judge:
    """Grow the forest on a bounded sample of labelled rows, calibrate it on all of them."""

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            counts, found = _statistics_of(batch, text_col)
            fine = ~base_failed(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values(batch, id_col), pa.int64()), pa.array(found.tolist(), pa.list_(pa.float64())), pa.array(fine)], names=["id", "shares", "fine"]
            )

    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg((F.max("quality") > 0).alias("good"))
    )
    rows = docs.select(col(id_col).cast("long").alias(id_col), col(text_col)).mapInArrow(shares, "id long, shares array<double>, fine boolean")
    # Documents the base rules reject are decided already.
    rows = rows.filter("fine").join(marked, "id").select("id", "shares", "good").persist()
    try:
        if rows.select("good").distinct().count() < 2:
            return Judge(None, 1.0)
        sample = bounded_sample(rows.filter("good"), F.col("id"), train_rows).select("shares").collect()
        forest = Forest.grow(np.array([r["shares"] for r in sample]), margins=np.array(list(MARGINS.values())))

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = np.minimum(forest.score(np.array(values(batch, "shares")).reshape(-1, len(FEATURES))) * SCORE_BINS, SCORE_BINS - 1)
                yield pa.RecordBatch.from_arrays([pa.array(bins.astype(np.int32)), batch.column(batch.schema.get_field_index("good"))], names=["bin", "good"])

        found = rows.mapInArrow(scored, "bin int, good boolean").groupBy("bin", "good").count().collect()
    finally:
        rows.unpersist()
    counts = np.zeros((2, SCORE_BINS + 1), dtype=np.int64)
    for r in found:
        counts[int(r["good"]), r["bin"]] += r["count"]
    # Of the limits that lose few good rows the lowest, a quarter of the way up to the next score: labelled junk
    # shows some ways to be odd, so its scores are no reason to let through what is odd by less.
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    lowest = int(np.flatnonzero(above[1] <= GIVE_UP * above[1, 0])[0])
    next_up = np.flatnonzero(counts.sum(axis=0)[lowest:])
    return Judge(forest, (lowest + (int(next_up[0]) if len(next_up) else 0) / 4) / SCORE_BINS)


def statistics(docs: DataFrame, judge: Judge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the five counts, base_failed, kept, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            counts, shares = _statistics_of(batch, text_col)
            kept, score = judge.kept(counts, shares)
            arrays = [pa.array(values(batch, id_col), pa.int64()), *(pa.array(c) for c in counts.T), pa.array(base_failed(counts)), pa.array(kept), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    ddl = "doc_id long, " + "".join(f"{c} long, " for c in COUNTS) + "base_failed boolean, kept boolean, score double"
    return docs.select(col(id_col).cast("long").alias(id_col), col(text_col)).mapInArrow(run, ddl)


def keep_good(docs: DataFrame, judge: Judge, text_col: str = "text") -> DataFrame:
    """The rows that pass, with all their columns."""
    plain, name = plain_names(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            yield batch.filter(pa.array(judge.kept(*_statistics_of(batch, name[text_col]))[0]))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
