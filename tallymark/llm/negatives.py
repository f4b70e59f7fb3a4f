"""Hard negatives by exact inner products, filtered with summaries of vector segments.

Vectors are cut into segments at several levels (1, 4, 16, ... segments).  Of a segment its
mean and its deviation (the length of what is left without the mean) are kept.  For two
vectors, the sum over segments of length * mean * mean, plus or minus the sum of deviation *
deviation, holds their inner product.  Pairs whose bounds leave the wanted range are dropped
level by level, finer segments are asked only for anchors and candidates that are left, and
what is left at the end is scored exactly.

Work is a grid: candidates are dealt to its rows and sent once per column, anchors to its
columns and sent once per row, about the same amount of both.  A task holds the anchors of
its cell, at most ANCHORS_HELD, and streams the candidates past them in blocks.  Two passes:
the best of the same label, then for every one of them the best of other labels in a range
of scores around it.  A task reports at most a fixed number of candidates per anchor.

Defined cases: rows with a null id, label or vector, an empty vector or a null or non-finite
component take no part; nor do vectors whose integer length is 2**31 or more, since their
scores need not fit a long.  Vectors of different lengths are not compared.  Rows with the
same id are separate anchors and candidates; only the anchor's own row is left out.  Equal
scores go by id, then arbitrarily but in one order.  Anchors without positives, and positives
without negatives, give no rows.  No rows, no anchors: an empty result.  A label may hold any
share of the rows: cells are cut by row, not by label.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import col
from tallymark.session import materialise, work_path

#: Vectors in a block of candidates, and anchors scored with it at a time.
BLOCK, ANCHOR_BLOCK = 2048, 512
#: Anchors a task may hold, and pairs of vectors it may be given.
ANCHORS_HELD, PAIRS_A_TASK = 1 << 17, 20_000_000_000
#: Segments grow fourfold from level to level, down to this many components.
SEGMENT = 4
_NONE = np.iinfo(np.int64).min

_BLOCKS = "part int, dim int, n int, rows binary, ids binary, labels binary, matrix binary"
_FOUND = "anchor long, anchor_id long, window int, positive_id long, positive_score long, row long, id long, score long"
_KEYS = ("rows", "ids", "labels")


def integer_rows(df: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = 256) -> DataFrame:
    """(row, id, label, v): usable rows with floor(scale * x) of every component, written once."""
    x = col(vector_col)
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) != float("inf")))
    usable = x.isNotNull() & (F.size(x) > 0) & F.coalesce(finite, F.lit(False))
    # The square is summed as a double; a when() keeps it away from unusable arrays.
    square = F.when(usable, F.aggregate(scaled, F.lit(0.0), lambda a, e: a + e * e))
    ints = F.when(square < float(2**62), F.transform(scaled, lambda e: e.cast("long")))
    rows = df.select(col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), ints.alias("v"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    path = work_path(df.sparkSession, "vectors")
    rows.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "label", "v").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    block: int = BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
    anchors_held: int = ANCHORS_HELD,
) -> DataFrame:
    """Negatives of every anchor and positive, for rows (row, id, label, v) of which some are anchors.

    A negative has another label, and its score lies from ``low`` to ``high`` hundredths of the
    positive's.  Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    if min(positives, negatives, block, anchor_block, anchors_held) < 1:
        raise ValueError("numbers must be positive")
    anchors = vectors.filter(is_anchor)
    grid = _grid(vectors.count(), anchors.count(), vectors.sparkSession.sparkContext.defaultParallelism, anchors_held)
    blocks = _written(_blocks(vectors.repartition(grid.rows), block), "candidates")

    def scan(held: DataFrame, run: _Scan) -> DataFrame:
        packed = _blocks(held.repartition(grid.columns, "row"), anchor_block)
        best = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id", "row")
        found = _placed(blocks, packed, grid).mapInArrow(run, _FOUND)
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= run.k)

    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>").alias("windows")
    same = scan(anchors.select("row", "id", "label", "v", none), _Scan(positives))
    listed = same.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("w"))
    windows = materialise(listed.select(F.col("anchor").alias("row"), F.transform("w", lambda w: F.struct(w["id"], w["score"])).alias("windows")))
    ranked = scan(anchors.join(windows, "row").select("row", "id", "label", "v", "windows"), _Scan(negatives, low, high))
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


@dataclass(frozen=True)
class _Grid:
    rows: int
    columns: int


def _grid(candidates: int, anchors: int, cores: int, held: int) -> _Grid:
    """Cells enough for the cores and the work, cut so that both sides are sent about equally."""
    cells = max(2 * cores, -(-candidates * anchors // PAIRS_A_TASK))
    columns = max(1, round((cells * anchors / max(1, candidates)) ** 0.5), -(-2 * anchors // held))
    return _Grid(max(1, -(-cells // columns)), columns)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _blocks(df: DataFrame, size: int) -> DataFrame:
    """Rows packed into matrices of at most ``size`` vectors of one length; windows, if any, as binary beside them."""
    extra = "windows" in df.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        part = TaskContext.get().partitionId()

        def block(dim: int, rows: list) -> pa.RecordBatch:
            row, ids, labels, vectors, *windows = zip(*rows, strict=True)
            matrix = np.array(vectors, dtype=np.int32)
            data = {"part": [part], "dim": [dim], "n": [len(rows)]}
            data |= {n: [np.array(x, dtype=np.int64).tobytes()] for n, x in zip(_KEYS, (row, ids, labels), strict=True)} | {"matrix": [matrix.tobytes()]}
            if extra:
                data["windows"] = [[w or [] for w in windows[0]]]
            return pa.RecordBatch.from_pydict(data, schema=_schema(extra))

        names = ["row", "id", "label", "v"] + ["windows"] * extra
        for batch in batches:
            for row in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True):
                rows = waiting.setdefault(len(row[3]), [])
                rows.append(row)
                if len(rows) == size:
                    yield block(len(row[3]), waiting.pop(len(row[3])))
        for dim, rows in waiting.items():
            yield block(dim, rows)

    return df.mapInArrow(pack, _BLOCKS + ", windows array<array<struct<id: bigint, score: bigint>>>" * extra)


def _schema(extra: bool) -> pa.Schema:
    fields = [("part", pa.int32()), ("dim", pa.int32()), ("n", pa.int32())] + [(n, pa.binary()) for n in (*_KEYS, "matrix")]
    if extra:
        fields.append(("windows", pa.list_(pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))))
    return pa.schema(fields)


def _placed(candidates: DataFrame, anchors: DataFrame, grid: _Grid) -> DataFrame:
    """Both sides at the cells of the grid; in a cell the anchors come first."""
    row, column = F.pmod(F.col("part"), F.lit(grid.rows)), F.pmod(F.col("part"), F.lit(grid.columns))
    across = F.explode(F.sequence(F.lit(0), F.lit(grid.columns - 1)))
    down = F.explode(F.sequence(F.lit(0), F.lit(grid.rows - 1)))
    left = candidates.withColumn("_c", across).withColumn("cell", row * grid.columns + F.col("_c")).drop("_c")
    right = anchors.withColumn("_r", down).withColumn("cell", F.col("_r") * grid.columns + column).drop("_r")
    both = right.unionByName(left, allowMissingColumns=True).withColumn("side", F.when(F.col("windows").isNull(), 1).otherwise(0))
    return both.repartition(grid.rows * grid.columns, "cell").sortWithinPartitions("cell", "side")


class Summary:
    """Vectors with their segment means and deviations at every level."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        floats = matrix.astype(np.float64)
        self.length = np.sqrt((floats * floats).sum(axis=1))
        self.levels = []
        dim, count = matrix.shape[1], 1
        while count == 1 or dim // count >= SEGMENT:
            starts = (np.arange(count) * dim) // count
            size = np.diff([*starts, dim])
            mean = np.add.reduceat(floats, starts, axis=1) / size
            rest = floats - np.repeat(mean, size, axis=1)
            deviation = np.sqrt(np.add.reduceat(rest * rest, starts, axis=1))
            # Means times the root of the length, so that their products are weighted by it.
            self.levels.append((mean * np.sqrt(size), deviation))
            count *= 4

    def bounds(self, other: Summary, level: int, mine: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible products of chosen rows of both."""
        (a, d), (b, e) = self.levels[level], other.levels[level]
        middle, reach = a[mine] @ b[theirs].T, d[mine] @ e[theirs].T
        # Scores are whole numbers; rounding errors are far below the room that is given.
        reach += 0.5 + 1e-9 * self.length[mine].max() * other.length[theirs].max()
        return middle - reach, middle + reach

    def products(self, other: Summary, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Exact products; in floating point only where it holds them exactly."""
        a, b = self.matrix[mine], other.matrix[theirs]
        if self.length[mine].max(initial=0) * other.length[theirs].max(initial=0) < 2**52:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return a.astype(np.int64) @ b.astype(np.int64).T


def survivors(a: Summary, b: Summary, mine: np.ndarray, theirs: np.ndarray, least: np.ndarray, most: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The rows of both sides that may still have a product from ``least`` to ``most`` (per row of ``mine``)."""
    for level in range(len(a.levels)):
        if not len(mine) or not len(theirs):
            break
        lower, upper = a.bounds(b, level, mine, theirs)
        alive = upper >= least[mine][:, None]
        if most is not None:
            alive &= lower <= most[mine][:, None]
        mine, theirs = mine[alive.any(axis=1)], theirs[alive.any(axis=0)]
    return mine, theirs


def firsts(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k greatest numbers of every row, earlier columns first among equals; _NONE is left out."""
    if scores.shape[1] > k:
        bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        bound = np.full(len(scores), _NONE + 1)
    bound = np.maximum(bound, _NONE + 1)[:, None]
    equal = scores == bound
    return np.nonzero((scores > bound) | (equal & (np.cumsum(equal, axis=1) <= k)))


@dataclass
class _Held:
    """Anchors of one length and the best candidates so far, per window."""

    summary: Summary
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    positive_id: np.ndarray
    positive_score: np.ndarray
    least: np.ndarray
    most: np.ndarray
    best: np.ndarray = field(init=False)  # (anchor, window, score, id, row), sorted, k per anchor and window
    bar: np.ndarray = field(init=False)  # the k-th best score of each anchor and window, once there are k

    def __post_init__(self):
        self.best = np.empty((0, 5), dtype=np.int64)
        self.bar = self.least.copy()

    def add(self, found: np.ndarray, k: int) -> None:
        both = np.concatenate([self.best, found])
        both = both[np.lexsort((both[:, 4], both[:, 3], -both[:, 2], both[:, 1], both[:, 0]))]
        windows = self.least.shape[1]
        key = both[:, 0] * windows + both[:, 1]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(both)), 0))
        place = np.arange(len(both)) - start
        self.best = both[place < k]
        last = both[place == k - 1]
        self.bar[last[:, 0], last[:, 1]] = np.maximum(self.bar[last[:, 0], last[:, 1]], last[:, 2])

    def report(self) -> Iterator[pa.RecordBatch]:
        if not len(self.best):
            return
        anchor, window, score, ids, row = self.best.T
        columns = [self.rows[anchor], self.ids[anchor], window.astype(np.int32), self.positive_id[anchor, window], self.positive_score[anchor, window], row, ids, score]
        names = ["anchor", "anchor_id", "window", "positive_id", "positive_score", "row", "id", "score"]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)


class _Scan:
    """One task's pass: anchors of a cell are held, candidates stream past them.

    Without ``low`` and ``high`` the best of the same label are found, else for each window
    (a positive's score) the best of other labels between its hundredths.
    """

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                get = lambda n: batch.column(at[n])[i].as_py()  # noqa: B023, E731
                if get("cell") != cell:
                    yield from self._reports(held)
                    cell, held = get("cell"), {}
                rows, ids, labels = (np.frombuffer(get(n), dtype=np.int64) for n in _KEYS)
                matrix = np.frombuffer(get("matrix"), dtype=np.int32).reshape(len(rows), -1)
                if get("side") == 0:
                    held.setdefault(get("dim"), []).append(self._hold(rows, ids, labels, matrix, get("windows")))
                elif get("dim") in held:
                    order = np.lexsort((rows, ids))
                    block = (rows[order], ids[order], labels[order], Summary(matrix[order]))
                    for anchors in held[get("dim")]:
                        (self._same if self.low is None else self._other)(anchors, *block)
        yield from self._reports(held)

    def _reports(self, held: dict) -> Iterator[pa.RecordBatch]:
        for group in held.values():
            for anchors in group:
                yield from anchors.report()

    def _hold(self, rows, ids, labels, matrix, windows) -> _Held:
        width = 1 if self.low is None else max(1, *(len(w) for w in windows))
        shape = (len(rows), width)
        positive_id, positive_score = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        # A window that is not there asks for more than any score.
        least = np.full(shape, _NONE + 1 if self.low is None else np.iinfo(np.int64).max)
        most = np.full(shape, np.iinfo(np.int64).max if self.low is None else _NONE + 1)
        for i, listed in enumerate(windows if self.low is not None else []):
            for j, w in enumerate(listed):
                positive_id[i, j], positive_score[i, j] = w["id"], w["score"]
                # Hundredths of a score can leave the range of a long; no score lies beyond 2**62.
                least[i, j] = min(max(-(-self.low * w["score"] // 100), -(2**62) - 1), 2**62 + 1)
                most[i, j] = min(max(self.high * w["score"] // 100, -(2**62) - 1), 2**62 + 1)
        return _Held(Summary(matrix), rows, ids, labels, positive_id, positive_score, least, most)

    def _same(self, anchors: _Held, rows, ids, labels, block: Summary) -> None:
        for label in np.intersect1d(anchors.labels, labels):
            mine, theirs = np.flatnonzero(anchors.labels == label), np.flatnonzero(labels == label)
            mine, theirs = survivors(anchors.summary, block, mine, theirs, anchors.bar[:, 0], None)
            if len(mine) and len(theirs):
                scores = anchors.summary.products(block, mine, theirs)
                scores[(anchors.rows[mine][:, None] == rows[theirs][None, :]) | (scores < anchors.bar[mine])] = _NONE
                self._keep(anchors, 0, scores, mine, theirs, rows, ids)

    def _other(self, anchors: _Held, rows, ids, labels, block: Summary) -> None:
        mine, theirs = np.arange(len(anchors.rows)), np.arange(len(rows))
        mine, theirs = survivors(anchors.summary, block, mine, theirs, anchors.bar.min(axis=1), anchors.most.max(axis=1))
        if not len(mine) or not len(theirs):
            return
        scores = anchors.summary.products(block, mine, theirs)
        scores[anchors.labels[mine][:, None] == labels[theirs][None, :]] = _NONE
        for window in range(anchors.least.shape[1]):
            low, high = anchors.bar[mine, window][:, None], anchors.most[mine, window][:, None]
            inside = (scores >= low) & (scores <= high)
            if inside.any():
                self._keep(anchors, window, np.where(inside, scores, _NONE), mine, theirs, rows, ids)

    def _keep(self, anchors: _Held, window: int, scores, mine, theirs, rows, ids) -> None:
        a, c = firsts(scores, self.k)
        if len(a):
            place = theirs[c]
            anchors.add(np.stack([mine[a], np.full(len(a), window), scores[a, c], ids[place], rows[place]], axis=1), self.k)
