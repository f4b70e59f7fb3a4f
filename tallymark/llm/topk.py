"""Exact top-k search by distributed histogram selection.

Every pass scores all (query, vector) pairs block by block.  The first passes only
count scores: each query has a score range, split into equal bins, and every block
reports its counts from the top bin down until it has seen k vectors (the k-th best
of all is at least as good as the k-th best of a block, so lower bins cannot hold
it).  The summed histogram shows which bin holds the k-th value, and that bin is the
next pass's range, until it is one score wide.  The last pass keeps scores above the
k-th value, and of those equal to it the k smallest ids of a block; ties are broken
by id at the end.  Nothing a block reports grows with the number of vectors.

Candidates are packed into blocks and dealt to a fixed number of places, some for every
core; queries are sent once to each place, not to each block.

Defined cases: vectors that are null, empty, hold null or non-finite components, or
have a null id, take no part as query or candidate; nor do those of a length of 2**31 or
more, whose scores need not fit a long.  A query is compared with vectors of its own length
only, and with every row but its own.  Rows with the same id count as separate queries and
candidates; each such query has its own ranks.  Fewer than k candidates: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import col
from tallymark.session import materialise, work_path

#: Vectors in a block; a task holds one block of each side and their scores.
BLOCK = 4096
QUERY_BLOCK = 512
#: Bins of a score range.
BINS = 2048

_BLOCKS = "part long, dim int, n int, rows binary, ids binary, matrix binary"
_PLACES_A_CORE = 4


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(row, id, v): floor(scale * x) of every component, written once; unusable rows left out."""
    x = col(vector_col)
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) != float("inf")))
    usable = x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False))
    # A when() keeps the functions away from arrays that hold nulls or infinities.
    square = F.when(usable, F.aggregate(scaled, F.lit(0.0), lambda a, e: a + e * e))
    ints = F.when(square < float(2**62), F.transform(scaled, lambda e: e.cast("long")))
    rows = df.select(col(id_col).cast("long").alias("id"), ints.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    path = work_path(df.sparkSession, "vectors")
    rows.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "v").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _blocks(df: DataFrame, size: int) -> DataFrame:
    """Vectors packed into matrices of at most ``size`` rows, one length each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        made = 0
        part = TaskContext.get().partitionId()

        def block(dim, rows):
            data = {"part": [(part << 32) + made], "dim": [dim], "n": [len(rows)]}
            data |= {n: [np.array(c, dtype=np.int64).tobytes()] for n, c in zip(("rows", "ids", "matrix"), zip(*rows, strict=True), strict=True)}
            kinds = [("part", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("rows", pa.binary()), ("ids", pa.binary()), ("matrix", pa.binary())]
            return pa.RecordBatch.from_pydict(data, schema=pa.schema(kinds))

        for batch in batches:
            for row, i, v in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
                rows = waiting.setdefault(len(v), [])
                rows.append((row, i, v))
                if len(rows) == size:
                    yield block(len(v), waiting.pop(len(v)))
                    made += 1
        for dim, rows in waiting.items():
            yield block(dim, rows)
            made += 1

    return df.select("row", "id", "v").mapInArrow(pack, _BLOCKS)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point only where it holds them exactly."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def top_k(vectors: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK, bins: int = BINS) -> DataFrame:
    """The k best of ``vectors`` for each of ``queries``, both (row, id, v array<long>); ``row`` tells rows apart.

    Returns query_id long, rank int, vec_id long, score long.
    """
    if k < 1:
        raise ValueError("k must be positive")
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    candidates = materialise(_blocks(vectors.repartition(tasks), block))
    asked = materialise(_blocks(queries.repartition(tasks), query_block)).select(
        F.col("part").alias("q_part"), "dim", F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix")
    )
    square = F.aggregate(F.col("v"), F.lit(0).cast("double"), lambda a, e: a + e.cast("double") * e.cast("double"))
    longest, asking = (df.agg(F.max(square)).first()[0] or 0.0 for df in (vectors, queries))
    # |q . c| <= |q| |c|: the first range of every query.
    bound = int(min((longest * asking) ** 0.5 + 1, 2**62 - 1))

    # Some blocks of candidates share a place; queries go to all places.
    places = max(1, min(candidates.count(), _PLACES_A_CORE * tasks))
    placed = candidates.withColumn("place", F.pmod(F.xxhash64("part"), F.lit(places)).cast("int")).drop("n")

    def pairs(bounds: DataFrame) -> DataFrame:
        sent = asked.join(bounds.drop("width"), "q_part")
        sent = sent.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(places - 1))))
        return placed.join(sent, ["dim", "place"])

    bounds = _first_ranges(asked.select("q_part", "q_ids"), -bound, bound)
    while (bounds.agg(F.max("width")).first()[0] or 1) > 1:
        bounds = materialise(_narrow(_count(pairs(bounds), k, bins), bounds, k, bins))
    best = Window.partitionBy("q_part", "row").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = _keep(pairs(bounds), k).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _first_ranges(ranges: DataFrame, low: int, high: int) -> DataFrame:
    """One row per block of queries: aligned arrays of ids, lower bounds, and how many better ones are known."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ids in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                n = len(ids) // 8
                yield pa.RecordBatch.from_pydict(
                    {"q_part": [part], "low": [np.full(n, low).tobytes()], "high": [np.full(n, high + 1).tobytes()], "above": [np.zeros(n, np.int64).tobytes()], "width": [high + 1 - low]},
                    schema=_RANGE,
                )

    return ranges.mapInArrow(start, "q_part long, low binary, high binary, above binary, width long")


_RANGE = pa.schema([("q_part", pa.int64()), ("low", pa.binary()), ("high", pa.binary()), ("above", pa.binary()), ("width", pa.int64())])


def _count(pairs: DataFrame, k: int, bins: int) -> DataFrame:
    """(q_part, row, bin, n): scores per bin, from the top down, summed over blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                rows, ids, q_rows, q_ids, q, c, low, high, _ = _read(batch, at, i)
                scores = _scores(q, c)
                width = -(-(high - low) // bins)
                shut = (q_rows[:, None] == rows[None, :]) | (scores < low[:, None])
                # Scores above the range were counted by an earlier pass.
                shut |= scores >= high[:, None]
                bin_of = np.where(shut, -1, (scores - low[:, None]) // width[:, None])
                best = np.partition(bin_of, max(0, bin_of.shape[1] - k), axis=1)[:, -k:] if bin_of.shape[1] > k else bin_of
                # All of a block's scores in bins at or above its k-th best bin.
                floor = np.maximum(best.min(axis=1), 0)
                row, at_col = np.nonzero(bin_of >= floor[:, None])
                key, n = np.unique(row.astype(np.int64) * bins + bin_of[row, at_col], return_counts=True)
                part = batch.column(at["q_part"])[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), part)), pa.array((key // bins).astype(np.int32)), pa.array((key % bins).astype(np.int32)), pa.array(n.astype(np.int64))],
                    names=["q_part", "row", "bin", "n"],
                )

    out = pairs.mapInArrow(run, "q_part long, row int, bin int, n long")
    return out.groupBy("q_part", "row", "bin").agg(F.sum("n").alias("n"))


def _read(batch: pa.RecordBatch, at: dict, i: int):
    get = lambda n: batch.column(at[n])[i].as_py()
    dim = get("dim")
    longs = lambda n: np.frombuffer(get(n), dtype=np.int64)
    return longs("rows"), longs("ids"), longs("q_rows"), longs("q_ids"), longs("q_matrix").reshape(-1, dim), longs("matrix").reshape(-1, dim), longs("low"), longs("high"), longs("above")


def _narrow(counts: DataFrame, bounds: DataFrame, k: int, bins: int) -> DataFrame:
    """The bin with the k-th value becomes the range; a query with fewer than k scores left keeps all."""
    listed = counts.groupBy("q_part").agg(F.collect_list(F.struct("row", "bin", "n")).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                low, high, above = (np.frombuffer(r[n], dtype=np.int64).copy() for n in ("low", "high", "above"))
                width = -(-(high - low) // bins)
                rows: dict[int, list] = {}
                for c in r["counts"] or []:
                    rows.setdefault(c["row"], []).append((c["bin"], c["n"]))
                for row in range(len(low)):
                    seen, found = above[row], None
                    for at, n in sorted(rows.get(row, []), reverse=True):
                        if seen + n >= k:
                            found = at
                            break
                        seen += n
                    if found is None:
                        # All scores are kept: a range that is one wide, below every score.
                        high[row] = low[row] + 1
                    else:
                        low[row], above[row] = low[row] + found * width[row], seen
                        high[row] = min(high[row], low[row] + width[row])
                yield pa.RecordBatch.from_pydict(
                    {"q_part": [r["q_part"]], "low": [low.tobytes()], "high": [high.tobytes()], "above": [above.tobytes()], "width": [int((high - low).max(initial=1))]},
                    schema=_RANGE,
                )

    joined = bounds.drop("width").join(listed, "q_part", "left")
    return joined.mapInArrow(run, "q_part long, low binary, high binary, above binary, width long")


def _keep(pairs: DataFrame, k: int) -> DataFrame:
    """Scores above the k-th value, and per block the k smallest ids of those equal to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                rows, ids, q_rows, q_ids, q, c, low, _, _ = _read(batch, at, i)
                order = np.argsort(ids, kind="stable")
                rows, ids, scores = rows[order], ids[order], _scores(q, c[order])
                scores_ok = q_rows[:, None] != rows[None, :]
                over = scores_ok & (scores > low[:, None])
                tied = scores_ok & (scores == low[:, None])
                take = over | (tied & (np.cumsum(tied, axis=1) <= k))
                row, at_col = np.nonzero(take)
                part = np.full(len(row), batch.column(at["q_part"])[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(row.astype(np.int32)), pa.array(q_ids[row]), pa.array(ids[at_col]), pa.array(scores[row, at_col])],
                    names=["q_part", "row", "query_id", "vec_id", "score"],
                )

    return pairs.mapInArrow(run, "q_part long, row int, query_id long, vec_id long, score long")
