"""Best-fit packing of documents into sequences by exact-complement hashing.

Only lengths matter for what goes together, so the packing is found on the histogram of
lengths: at most ``capacity`` counters, whatever the number of documents.  From the
longest length down, an index of the lengths left is asked for what fills the gap exactly:
nothing, one length, or a pair, each taken as often as the counts allow.  Then gaps are
filled by three lengths, one of them together with a pair from an index of the sums of the
pairs left.  What remains is packed best fit, the longest length that fits into the gap first.  Every step uses up at
least one length, which bounds the number of patterns.

Documents are dealt to patterns by their rank among those of equal length, which each
partition counts for itself; one row per (partition, length) carries the ranks on.

Defined cases: a null text is empty and is one piece, the end id.  Longer documents are
cut into pieces of ``capacity``, the first of which may be shorter.  Repeated rows are
packed each for itself.  No documents: no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm import tokens
from tallymark.llm.common import col, doc_bytes, free_name, slices, values
from tallymark.session import materialise

CAPACITY = 2048
TOKENIZER, END_ID = "byte_bpe_50k.json", 0

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    first = n % capacity if n > capacity else n
    starts = ([(0, first)] if first else []) + [(at, capacity) for at in range(first, n, capacity)]
    return starts


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY, digest: bool = False, chunks: int = tokens.CACHED_CHUNKS, forget: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every document; with ``digest`` the ids' crc32 in place of the ids.

    ``chunks`` bounds what a worker keeps of encoded chunks; with ``forget`` it keeps none from one task to the next.
    """
    schema = pa.schema([*list(_PIECES)[:4], ("ids_crc32", pa.int64())]) if digest else _PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokens.encoder(tokenizer, chunks), tokens.packed([end_id])
        encode = encoder.encode
        for batch in slices(batches, 500):
            rows = []
            for doc, text in zip(values(batch, id_col), doc_bytes(batch, text_col), strict=True):
                ids = encode(text.decode()) + end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, number, start, length, zlib.crc32(own) if digest else own))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        if forget:
            encoder.cache.clear()

    ddl = "doc_id long, piece int, start long, length long, " + ("ids_crc32 long" if digest else "ids binary")
    return docs.select(col(id_col).cast("long").alias(id_col), col(text_col)).mapInArrow(run, ddl)


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths, how often) of sequences that together hold every counted length."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        left[length] = n
    out: list[tuple[list[int], int]] = []

    def take(lengths: list[int]) -> int:
        used = np.bincount(lengths, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        if times:
            left[:] -= used * times
            out.append((lengths, times))
        return times

    for longest in range(capacity, 0, -1):
        gap = capacity - longest
        if left[longest] and not gap:
            take([longest])
        if left[longest] and gap:
            take([longest, gap])
        # Pairs (a, gap - a): both lengths must be left.
        a = np.arange((gap + 1) // 2, gap)
        while left[longest] and len(a):
            some = a[(left[a] > 0) & (left[gap - a] > 0)]
            a = some[1:]
            if len(some):
                take([longest, int(some[0]), int(gap - some[0])])
    _take_triples(left, capacity, take)
    for longest in range(capacity, 0, -1):
        while left[longest]:
            lengths, gap = [longest], capacity - longest
            spare = left.copy()
            spare[longest] -= 1
            while gap:
                fitting = np.flatnonzero(spare[1 : gap + 1])
                if not len(fitting):
                    break
                best = int(fitting[-1]) + 1
                # As many of the best fit as the gap and the counts allow.
                times = min(gap // best, int(spare[best]))
                lengths += [best] * times
                spare[best] -= times
                gap -= best * times
            take(lengths)
    return out


def _take_triples(left: np.ndarray, capacity: int, take) -> None:
    """Fill gaps exactly by a pair and one more length, until no four lengths left make a full sequence."""
    there = left > 0
    # By sum: how many ordered pairs of lengths that are left make it.
    pairs = np.rint(np.convolve(there.astype(float), there.astype(float)))[: capacity + 1].astype(np.int64)

    def taken(lengths: list[int]) -> bool:
        if not take(lengths):
            return False
        for x in {x for x in lengths if there[x] and not left[x]}:
            partners = np.flatnonzero(there[: capacity + 1 - x])
            np.subtract.at(pairs, partners + x, np.where(partners == x, 1, 2))
            there[x] = False
        return True

    for longest in range(capacity, 0, -1):
        gap = capacity - longest
        # The shortest of the three is at most a third of the gap.
        third = np.arange(1, gap // 3 + 1)
        while there[longest] and len(third):
            some = third[there[third] & (pairs[gap - third] > 0)]
            if not len(some):
                break
            c = int(some[-1])
            third = some[:-1]
            a = np.arange((gap - c + 1) // 2, gap - c)
            for x in a[there[a] & there[gap - c - a]].tolist():
                # A length may be wanted more often than it is left.
                while there[longest] and there[c] and there[x] and there[gap - c - x] and taken([longest, x, gap - c - x, c]):
                    pass


def places(found: list[tuple[list[int], int]], capacity: int = CAPACITY) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first ranks of its runs, the sequence a run begins with, and the offset there."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    ranks = np.zeros(capacity + 1, dtype=np.int64)
    sequence = 0
    for lengths, times in found:
        offset = 0
        for length in lengths:
            runs.setdefault(length, []).append((int(ranks[length]), sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    return {length: tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) for length, rows in runs.items()}


def pack(items: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """All rows and columns of ``items``, with sequence_id and offset."""
    part, rank, before = (free_name([*items.columns, "sequence_id", "offset"], n) for n in ("pack_part", "pack_rank", "pack_before"))
    # Written once: ranks are given by partition, which a second reading might fill otherwise.
    items = materialise(items.withColumn(part, F.spark_partition_id()))
    counts = items.groupBy(part, length_col).agg(F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(length_col).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    histogram = {r[0]: r[1] for r in items.groupBy(length_col).count().collect()}
    table = places(patterns(histogram, capacity), capacity)

    own = Window.partitionBy(part, length_col).orderBy(*[F.col(c) for c in items.columns if c not in (part, length_col)])
    ranked = items.withColumn(rank, F.row_number().over(own) - 1).join(ranks, [part, length_col])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(before)).select(*[c for c in items.columns if c != part], rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, number = (np.array(values(batch, c), dtype=np.int64) for c in (length_col, rank))
            sequence, offset = np.zeros_like(number), np.zeros_like(number)
            for length in np.unique(lengths):
                rows = lengths == length
                firsts, starts, offsets = table[int(length)]
                at = np.searchsorted(firsts, number[rows], side="right") - 1
                sequence[rows] = starts[at] + number[rows] - firsts[at]
                offset[rows] = offsets[at]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    kept = ranked.drop(rank).schema
    return ranked.mapInArrow(run, kept.add("sequence_id", "long").add("offset", "long"))
