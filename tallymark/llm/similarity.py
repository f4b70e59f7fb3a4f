"""N-gram Jaccard join with Bayesian candidate pruning.

A document is the set of its five-word shingles (64-bit hashes of words between white
space).  Documents with equal sets are one class and are compared once.  Classes that
share a band of their MinHash signature meet in a cluster, and the pairs of a cluster are
compared a few MinHash values at a time: a pair is dropped as soon as the posterior
probability that its similarity reaches the threshold, given the values that agreed so
far and a uniform prior, is below ``TOLERANCE``.  What is left is decided by the sets.

A cluster too large for one task is cut into blocks, and each pair of blocks is a task of
its own.  Tasks report the links of each class and a local root, never the pairs.

A pair at the threshold shares no band with probability (1 - 0.8**4)**20 = 3e-5, less
above it.

Defined cases: texts of fewer than five words are one shingle of all their words; a text
without words (or null) has an empty set, links to nothing and is a class of its own.
Repeated rows are copies.  The class id is the smallest doc_id of the class; null ids
come after all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import BROADCAST_BYTES, col, doc_bytes, free_name, slices, values
from tallymark.llm.components import components
from tallymark.session import materialise

WORDS, THRESHOLD = 5, 0.8
BANDS, BAND_ROWS, STEP = 20, 4, 16
HASHES = BANDS * BAND_ROWS
TOLERANCE = 1e-6
#: Classes and shingles of a block; a task holds two blocks.
BLOCK_CLASSES, BLOCK_SHINGLES = 4096, 1 << 20

_RNG = np.random.default_rng(80)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_C = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    listed = text.split()
    if not listed:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), dtype=np.uint64, count=len(listed))
    size = min(words, len(h))
    out = h[: len(h) - size + 1].copy()
    for i in range(1, size):
        out = out * _C + h[i : len(h) - size + 1 + i]
    out ^= out >> np.uint64(29)
    return np.unique(out * _C)


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), 4096):
        np.minimum(least, (found[start : start + 4096, None] * _A + _B).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def needed(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, agreeing values from which a pair stays) after each step."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        # With a uniform prior the posterior is Beta(m + 1, n - m + 1).
        for m in range(n + 1):
            reaches = sum(comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
            if reaches >= tolerance:
                out.append((n, m))
                break
    return out


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, high, low, n, signature): the set of every row, by its 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            rows = []
            for text in doc_bytes(batch, "text"):
                found = shingles(text)
                if not len(found):
                    rows.append((None, None, 0, None))
                    continue
                high, low = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype=np.int64).tolist()
                rows.append((high, low, len(found), signature(found).tobytes()))
            own = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays([*kept, *own], names=["doc_id", "text_key", "high", "low", "n", "signature"])

    return _keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_key long, high long, low long, n long, signature binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = col(text_col).cast("string")
    return docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _bands(classes: DataFrame) -> DataFrame:
    """(band, class): a hash of each band with its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            signatures = np.array([np.frombuffer(s, dtype=np.uint32) for s in values(batch, "signature")], dtype=np.uint64).reshape(-1, BANDS, BAND_ROWS)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), signatures.shape[:2]).copy()
            for i in range(BAND_ROWS):
                key = (key ^ signatures[:, :, i]) * _C
                key ^= key >> np.uint64(31)
            ids = np.repeat(np.array(values(batch, "class"), dtype=np.int64), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(ids)], names=["band", "class"])

    return classes.select("class", "signature").mapInArrow(run, "band long, class long")


def _clusters(classes: DataFrame) -> DataFrame:
    """(class, cluster, blocks) of the classes that share a band with another."""
    shared = _bands(classes).groupBy("band").agg(F.min("class").alias("root"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    edges = _bands(classes).join(shared.select("band", "root"), "band").filter(F.col("class") != F.col("root"))
    found = materialise(components(edges.select(F.col("class").alias("a"), F.col("root").alias("b"))))
    found = found.select(F.col("node").alias("class"), F.col("root").alias("cluster"))
    sizes = found.join(classes.select("class", "n"), "class").groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    return found.join(sizes, "cluster")


def _links(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(class, root, links) from the tasks (cluster, i, j): links of each class to others, and a class it hangs together with."""
    steps = needed(threshold, tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, current = [], None
        for batch in batches:
            for row in zip(*(values(batch, c) for c in ("cluster", "i", "j", "block", "class", "copies", "signature", "found")), strict=True):
                if row[:3] != current and waiting:
                    yield _compare(waiting, current[1] != current[2], steps, threshold)
                    waiting = []
                current = row[:3]
                waiting.append(row[3:])
        if waiting:
            yield _compare(waiting, current[1] != current[2], steps, threshold)

    dealt = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "block", "class")
    return dealt.mapInArrow(run, "class long, root long, links long")


def _compare(rows: list[tuple], two_blocks: bool, steps: list[tuple[int, int]], threshold: float) -> pa.RecordBatch:
    """Links among the classes of one block, or between two blocks."""
    block, ids, copies = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(3))
    signatures = np.array([np.frombuffer(r[3], dtype=np.uint32) for r in rows])
    sets = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
    sizes = np.array(list(map(len, sets)))
    _, numbered = np.unique(np.concatenate(sets), return_inverse=True)
    numbered = np.split(numbered, np.cumsum(sizes)[:-1])
    marked = np.zeros(1 + max(int(x.max()) for x in numbered), dtype=bool)
    second = int(np.searchsorted(block, block[-1])) if two_blocks else 0

    links = np.zeros(len(rows), dtype=np.int64)
    root = np.arange(len(rows))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(second if two_blocks else len(rows)):
        alive = np.arange(second if two_blocks else a + 1, len(rows))
        agree = np.zeros(len(alive), dtype=np.int64)
        done = 0
        for n, enough in steps:
            agree += (signatures[alive, done:n] == signatures[a, done:n]).sum(axis=1)
            stay = agree >= enough
            alive, agree, done = alive[stay], agree[stay], n
            if not len(alive):
                break
        if not len(alive):
            continue
        marked[numbered[a]] = True
        ends = np.cumsum(sizes[alive])
        common = np.add.reduceat(marked[np.concatenate([numbered[b] for b in alive])].astype(np.int64), np.append(0, ends[:-1]))
        marked[numbered[a]] = False
        alive = alive[common >= threshold * (sizes[a] + sizes[alive] - common) - 1e-9]
        links[a] += copies[alive].sum()
        links[alive] += copies[a]
        for b in alive.tolist():
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    linked = np.flatnonzero(links)
    roots = np.array([ids[top(int(x))] for x in linked], dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(roots), pa.array(links[linked])], names=["class", "root", "links"])


def _same_text(left: DataFrame, right: DataFrame, key_names: tuple[str, str], how: str) -> DataFrame:
    """Join on (doc_id, text_key), where a null id equals a null id; ``right`` is broadcast only if its measured size allows it."""
    small = right.count() * 64 <= BROADCAST_BYTES
    side = right.withColumnsRenamed({"doc_id": key_names[0], "text_key": key_names[1]})
    on = F.col("doc_id").eqNullSafe(F.col(key_names[0])) & (F.col("text_key") == F.col(key_names[1]))
    return left.join(F.broadcast(side) if small else side, on, how)


def classes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, text_key, class_id, n_links, first) of every row; ``first`` is the (doc_id, text_key) that stands for the class."""
    rows = materialise(features(docs, id_col, text_col))
    # Null ids order last, so that they stand for a class only where no other does.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = rows.filter(F.col("high").isNotNull()).groupBy("high", "low").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("signature").alias("signature")
    )
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()))
    clusters = materialise(_clusters(classes))

    # The sets of the classes in clusters, from one text of each.
    members = classes.join(clusters, "class").select("class", "cluster", "blocks", "copies", "signature", "first.doc_id", "first.text_key")
    texts = _same_text(_keyed(docs, id_col, text_col), members.select("doc_id", "text_key", "class"), ("first_id", "first_key"), "inner").select("class", "text").dropDuplicates(["class"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            found = [shingles(t).tobytes() for t in doc_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("class")), pa.array(found, pa.binary())], names=["class", "found"])

    found = texts.mapInArrow(sets, "class long, found binary")
    placed = members.join(found, "class").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    tasks = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    linked = materialise(_links(tasks.select("cluster", "i", "j", "block", "class", "copies", "signature", "found"), threshold, tolerance))

    groups = components(linked.select(F.col("class").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("class").agg(F.sum("links").alias("links"))
    with_links = classes.select("high", "low", "class", "first", "copies").join(links, "class", "left").join(groups.withColumnRenamed("node", "class"), "class", "left")
    with_links = materialise(with_links.withColumn("root", F.coalesce("root", "class")))
    heads = with_links.groupBy("root").agg(F.min("first").alias("head"))
    known = with_links.join(heads, "root").select(
        "high", "low", "head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    some = rows.filter(F.col("high").isNotNull()).join(known, ["high", "low"]).select("doc_id", "text_key", "head", "n_links")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    none = rows.filter(F.col("high").isNull()).select("doc_id", "text_key", own.alias("head"), F.lit(0).cast("long").alias("n_links"))
    out = some.unionByName(none.select(*some.columns))
    return out.select("doc_id", "text_key", F.col("head.doc_id").alias("class_id"), "n_links", F.struct("head.doc_id", "head.text_key").alias("first"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, the one with the smallest id, with all its columns; texts without words all stay."""
    found = classes_of(docs, id_col, text_col, threshold).filter(F.col("n_links") > 0)
    stands = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    # Rows to go, and rows that stand for their class more than once.
    marks = found.groupBy("doc_id", "text_key", stands.alias("stands")).agg(F.count(F.lit(1)).alias("n"))
    marks = materialise(marks.filter(~F.col("stands") | (F.col("n") > 1)).select("doc_id", "text_key", "stands"))
    names = docs.columns
    key, mark, other_id, other_key = (free_name(names, n) for n in ("near_key", "near_stands", "near_id", "near_other"))
    small = marks.count() * 64 <= BROADCAST_BYTES
    side = marks.withColumnsRenamed({"doc_id": other_id, "text_key": other_key, "stands": mark})
    rows = docs.withColumn(key, F.xxhash64(col(text_col).cast("string")))
    on = col(id_col).cast("long").eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key))
    joined = rows.join(F.broadcast(side) if small else side, on, "left")
    single = joined.filter(F.col(mark).isNull())
    several = joined.filter(F.col(mark)).dropDuplicates([id_col, key])
    return single.unionByName(several).select([col(c) for c in names])
