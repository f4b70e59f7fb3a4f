"""Removal of long repeated passages with run-length suffix indexes.

A byte goes if it lies in a string of ``length`` bytes that also starts elsewhere in the
corpus.  The corpus is cut by content so that both places of a repeat meet in one task:

1. Anchors.  Every window of ``length`` bytes holds an anchor, a k-byte string whose hash
   is the smallest in the window, so equal windows hold equal anchors at equal offsets.
   An anchor is sent with a hash of its context, all bytes that a window through it can
   reach.  Copies of a context within a batch are sent once.
2. Where a context occurs twice, all windows in it repeat.  A context that occurs once
   needs a look only if its anchor has other contexts; those texts alone are fetched.
3. Index.  The fetched texts of a group of anchors are joined (overlapping ones of a
   document become one segment), their suffixes are sorted, and the Burrows-Wheeler
   transform is run-length compressed.  Matches with the suffixes
   next in order are measured only at run ends; between these a match grows by one byte
   per step to the left, so streaming from run end to run end gives the matching
   statistics of every position, and those of ``length`` bytes are marked.

Anchors with more than ``WIDE`` contexts would make too large an index.  Their windows are
compared one by one through hashes instead, spread over all tasks; the result is the same.

Hashes have 64 bits and are compared together with the anchor's: what differs in bytes
differs in both but for a chance of 2**-64 per pair with the same anchor.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; repeated
rows are copies of each other, so both lose all that is long enough.  Bytes are judged on
the texts as given.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import BROADCAST_BYTES, col, doc_bytes, free_name, plain_names, slices, values
from tallymark.session import materialise

LENGTH = 200
#: Contexts of an anchor that one index may hold, and bytes of an index.
WIDE, INDEX_BYTES = 4000, 1 << 18
#: Groups of anchors per partition of the input; a group is handled at once.
GROUPS_PER_PARTITION = 64
#: Parts of a group whose texts are indexed together, packed rows unpacked and run ends measured at a time.
PARTS_PER_GROUP, PACKS, PIECE = 64, 256, 1 << 16

_ENTRY = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("at", "<u4"), ("many", "u1")])
_WINDOW = np.dtype([("hash", "<u8"), ("anchor", "<u8"), ("doc", "<i8"), ("at", "<u4")])
COVERED, CHECK, WIDE_CHECK = 0, 1, 2

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            up, down = (np.full(size, v, dtype=np.uint64) for v in (_BASE, pow(_BASE, -1, 1 << 64)))
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


class Hashes:
    """Hashes of any stretch of a text."""

    def __init__(self, text: bytes):
        n = len(text)
        up, self.down = _POWERS.to(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[np.frombuffer(text, dtype=np.uint8)] * up[:n], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Of every stretch of this length."""
        starts = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:starts]) * self.down[:starts])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def _sliding(best, x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    return best(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def anchor_length(length: int) -> int:
    return max(1, length // 4)


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, anchor hash, context hash) of the smallest k-byte strings of all windows."""
    n, k = len(text), anchor_length(length)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    hashes = Hashes(text)
    h, width = hashes.all(k), length - k + 1
    least = _sliding(np.minimum, h, width)
    # A place is chosen if some window around it has its hash as the least.
    pad = np.zeros(width - 1, dtype=np.uint64)
    at = np.flatnonzero(_sliding(np.maximum, np.concatenate([pad, least, pad]), width) == h)
    start, end = context(at, n, length)
    # Contexts cut short by the text's ends differ from whole ones.
    cut = (at - start).astype(np.uint64) * np.uint64(_BASE)
    return at, h[at], _mix(hashes.of(start, end) + cut)


def context(at, n, length: int = LENGTH):
    """The bytes that windows of ``length`` through an anchor can reach."""
    return np.maximum(at - (length - anchor_length(length)), 0), np.minimum(at + length, n)


def repeated(text: bytes, length: int = LENGTH) -> np.ndarray:
    """Starts of the strings of ``length`` bytes that occur twice or more in a text of segments, each ended by 0xFF."""
    n = len(text)
    if n <= length:
        return np.empty(0, np.int64)
    raw = np.frombuffer(text, dtype=np.uint8)
    # Segment ends differ from each other, so that no match crosses one.
    stops = np.flatnonzero(raw == 0xFF)
    symbols = raw.astype(np.int32)
    symbols[stops] = 256 + np.arange(len(stops), dtype=np.int32)
    # Order of the first 1, 2, 4, ... bytes, until all suffixes differ.
    width, levels = 1, []
    rank, found = _ranks(symbols)
    while True:
        if width <= length:
            levels.append((width, rank))
        keys = rank.astype(np.int64)
        keys *= n + 1
        keys[: n - width] += rank[width:]
        keys[: n - width] += 1
        rank, found = _ranks(keys)
        width *= 2
        if found == n:
            break
    del keys
    order = np.empty(n, dtype=np.int32)
    order[rank] = np.arange(n, dtype=np.int32)
    transform = symbols[order - 1]
    new_run = np.ones(n, dtype=bool)
    new_run[1:] = transform[1:] != transform[:-1]
    del symbols, transform

    repeats = np.zeros(n, dtype=bool)
    for side in (-1, 1):
        # Run heads look at the suffix before, run tails at the one after.
        sampled = np.zeros(n, dtype=bool)
        sampled[(order[new_run if side < 0 else np.roll(new_run, -1)] - 1) % n] = True
        # The first sampled suffix at or after each place.
        following = np.cumsum(sampled, dtype=np.int32) - sampled
        sampled = np.flatnonzero(sampled).astype(np.int32)
        measured = np.empty(len(sampled), dtype=np.int32)
        for i in range(0, len(sampled), PIECE):
            some = sampled[i : i + PIECE]
            other = rank[some] + side
            inside = (other >= 0) & (other < n)
            shared = np.zeros(len(some), dtype=np.int32)
            shared[inside] = _common(levels, some[inside], order[other[inside]], length)
            # Where the match ends, if it may be as long as wished for.
            measured[i : i + PIECE] = shared + some
        # From a run end the match grows by one byte per step to the left.
        last = int(sampled[-1]) + 1
        repeats[:last] |= measured[following[:last]] - np.arange(last, dtype=np.int32) >= length
    return np.flatnonzero(repeats)


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each key among the different ones, and the number of these."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.zeros(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    del ordered
    rank = np.empty(len(keys), dtype=np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    return rank, int(rank[order[-1]]) + 1


def _common(levels, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Bytes that two suffixes share, up to ``length``."""
    n = len(levels[0][1])
    shared = np.zeros(len(a), dtype=np.int32)
    for width, ranks in reversed(levels):
        i, j = a + shared, b + shared
        fits = (i < n) & (j < n)
        same = fits.copy()
        same[fits] = ranks[i[fits]] == ranks[j[fits]]
        shared[same] += width
    return np.minimum(shared, length)


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, end) rows; touching ones are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.append(True, spans[1:, 0] > reach[:-1])
    last = np.append(first[1:], True)
    return np.stack([spans[first, 0], reach[last]], axis=1)


_ROWS = pa.schema([("group", pa.int64()), ("packed", pa.binary())])
_FOUND = pa.schema([("kind", pa.int8()), ("doc", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("anchor", pa.int64())])
_FOUND_DDL = "kind byte, doc long, start long, end long, anchor long"


def _deal(entries: np.ndarray, key: str, groups: int) -> Iterator[pa.RecordBatch]:
    """Entries packed into one row per group."""
    group = (entries[key] >> np.uint64(20)) % np.uint64(groups)
    order = np.argsort(group, kind="stable")
    group, entries = group[order], entries[order]
    bounds = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.empty(0, np.int64)
    packs = [p.tobytes() for p in np.split(entries, bounds[1:])] if len(group) else []
    yield pa.RecordBatch.from_arrays([pa.array(group[bounds].astype(np.int64)), pa.array(packs, pa.binary())], schema=_ROWS)


def _by_group(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """The entries of each group, from rows sorted by group."""
    current, packs = None, []
    for batch in slices(batches, PACKS):
        for group, packed in zip(values(batch, "group"), values(batch, "packed"), strict=True):
            if group != current and packs:
                yield np.frombuffer(b"".join(packs), dtype=kind)
                packs = []
            current = group
            packs.append(packed)
    if packs:
        yield np.frombuffer(b"".join(packs), dtype=kind)


def _found(kind: int, doc, start, end, anchor=None) -> pa.RecordBatch:
    n = len(doc)
    anchor = np.zeros(n, dtype=np.int64) if anchor is None else anchor.view(np.int64)
    columns = [np.full(n, kind, dtype=np.int8), doc, start, end, anchor]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Number of the run of equal rows, for each row of sorted columns."""
    new = np.zeros(len(columns[0]), dtype=bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _settle(entries: np.ndarray, length: int, wide: int) -> Iterator[pa.RecordBatch]:
    """What the anchors of a group show without their texts, and which texts to look at."""
    entries = entries[np.lexsort((entries["context"], entries["anchor"]))]
    context_run, anchor_run = _runs(entries["anchor"], entries["context"]), _runs(entries["anchor"])
    twice = np.bincount(context_run, weights=1 + entries["many"])[context_run] > 1
    first = np.append(True, context_run[1:] != context_run[:-1])
    contexts = np.bincount(anchor_run, weights=first)[anchor_run]
    at = entries["at"].astype(np.int64)
    start, end = context(at, np.iinfo(np.int64).max, length)
    yield _found(COVERED, entries["doc"][twice], start[twice], end[twice])
    # One of each context, where an anchor has several and one of them occurs once.
    alone = np.bincount(anchor_run, weights=~twice)[anchor_run] > 0
    look = first & (contexts > 1) & alone
    for kind, some in ((CHECK, look & (contexts <= wide)), (WIDE_CHECK, look & (contexts > wide))):
        yield _found(kind, entries["doc"][some], at[some], at[some], entries["anchor"][some])


def spans(docs: DataFrame, key: str, text: str, length: int = LENGTH, wide: int = WIDE) -> DataFrame:
    """(doc, spans): for the keys of ``docs`` that lose bytes, (start, end) pairs to be removed.

    Ends may lie beyond a text's end, and pairs may overlap.
    """
    # Physical planning only; nothing is read for this.
    groups = GROUPS_PER_PARTITION * max(1, docs.rdd.getNumPartitions())

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1500):
            parts = []
            for doc, body in zip(values(batch, key), doc_bytes(batch, text), strict=True):
                at, anchor, around = anchors(body, length)
                part = np.zeros(len(at), dtype=_ENTRY)
                part["anchor"], part["context"], part["doc"], part["at"] = anchor, around, doc, at
                parts.append(part)
            entries = np.concatenate(parts) if parts else np.zeros(0, dtype=_ENTRY)
            entries = entries[np.lexsort((entries["context"], entries["anchor"]))]
            run = _runs(entries["anchor"], entries["context"]) if len(entries) else np.empty(0, np.int64)
            many = np.bincount(run)[run] > 1 if len(run) else np.empty(0, bool)
            first = np.append(True, run[1:] != run[:-1]) if len(run) else np.empty(0, bool)
            # Further copies are settled here; they travel with the group of their document.
            entries["many"] = many
            yield from _deal(entries[first], "anchor", groups)
            copies = entries[many & ~first]
            copies["context"], copies["many"] = 0, 2
            yield from _deal(copies, "anchor", groups)

    sent = docs.mapInArrow(choose, "group long, packed binary")
    gathered = sent.repartition("group").sortWithinPartitions("group")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for entries in _by_group(batches, _ENTRY):
            known = entries["many"] == 2
            start, end = context(entries["at"][known].astype(np.int64), np.iinfo(np.int64).max, length)
            yield _found(COVERED, entries["doc"][known], start, end)
            yield from _settle(entries[~known], length, wide)

    found = materialise(gathered.mapInArrow(settle, _FOUND_DDL))
    checked = _checked(docs, key, text, found, length, groups)
    pairs = found.filter(F.col("kind") == COVERED).select("doc", "start", "end").unionByName(checked)
    return pairs.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _checked(docs: DataFrame, key: str, text: str, found: DataFrame, length: int, groups: int) -> DataFrame:
    """(doc, start, end) of the repeats that take a look at the texts."""
    wanted = found.filter(F.col("kind") != COVERED).groupBy("doc").agg(F.collect_list(F.struct("kind", "start", "anchor")).alias("wanted"))
    size = found.filter(F.col("kind") != COVERED).count() * 24
    side = docs.select(col(key).alias("doc"), col(text).alias("text"))
    looked = side.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, "doc").dropDuplicates(["doc"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            rows = []
            for doc, body, wants in zip(values(batch, "doc"), doc_bytes(batch, "text"), values(batch, "wanted"), strict=True):
                for w in wants:
                    if w["kind"] == CHECK:
                        start, end = (int(x) for x in context(w["start"], len(body), length))
                        group = ((w["anchor"] % (1 << 64)) >> 20) % (groups * PARTS_PER_GROUP)
                        rows.append((group, doc, start, body[start:end]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["group", "doc", "start", "text"]
            )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, current = [], 0, None
        for batch in slices(batches, 1000):
            for row in zip(*(values(batch, c) for c in ("group", "doc", "start", "text")), strict=True):
                # The texts of an anchor are kept together.
                if size > INDEX_BYTES and row[0] != current:
                    yield _search(waiting, length)
                    waiting, size = [], 0
                current = row[0]
                waiting.append(row[1:])
                size += len(row[3])
        if waiting:
            yield _search(waiting, length)

    fetched = looked.mapInArrow(fetch, "group long, doc long, start long, text binary")
    narrow = fetched.repartition("group").sortWithinPartitions("group", "doc", "start").mapInArrow(index, _FOUND_DDL)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = anchor_length(length)
        for batch in slices(batches, 100):
            parts = [np.zeros(0, dtype=_WINDOW)]
            for doc, body, wants in zip(values(batch, "doc"), doc_bytes(batch, "text"), values(batch, "wanted"), strict=True):
                wide = [(w["start"], w["anchor"]) for w in wants if w["kind"] == WIDE_CHECK]
                if wide:
                    h = Hashes(body).all(length)
                    for at, anchor in wide:
                        starts = np.arange(max(0, at + k - length), min(at, len(body) - length) + 1)
                        part = np.zeros(len(starts), dtype=_WINDOW)
                        part["hash"], part["anchor"], part["doc"], part["at"] = h[starts], np.int64(anchor).view(np.uint64), doc, starts
                        parts.append(part)
            yield from _deal(np.concatenate(parts), "hash", groups)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for entries in _by_group(batches, _WINDOW):
            entries = entries[np.lexsort((entries["at"], entries["doc"], entries["anchor"], entries["hash"]))]
            # A window may hold its anchor twice; it is one window all the same.
            entries = entries[np.append(True, entries[1:] != entries[:-1])]
            run = _runs(entries["hash"], entries["anchor"])
            twice = entries[np.bincount(run)[run] > 1]
            yield _found(COVERED, twice["doc"], twice["at"].astype(np.int64), twice["at"].astype(np.int64) + length)

    dealt = looked.filter(F.exists("wanted", lambda w: w["kind"] == WIDE_CHECK)).mapInArrow(windows, "group long, packed binary")
    wide = dealt.repartition("group").sortWithinPartitions("group").mapInArrow(compare, _FOUND_DDL)
    return narrow.unionByName(wide).select("doc", "start", "end")


def _search(rows: list[tuple[int, int, bytes]], length: int) -> pa.RecordBatch:
    """Repeats within texts (doc, start, bytes) sorted by place; overlapping ones of a document become one segment."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    segments: list[list] = []
    for doc, start, text in rows:
        if segments and segments[-1][0] == doc and start <= segments[-1][1] + len(segments[-1][2]):
            have = segments[-1][1] + len(segments[-1][2])
            segments[-1][2] += text[max(0, have - start) :]
        else:
            segments.append([doc, start, bytearray(text)])
    text = b"".join(bytes(s[2]) + b"\xff" for s in segments)
    begins = np.cumsum([0] + [len(s[2]) + 1 for s in segments])[:-1]
    hits = repeated(text, length)
    of = np.searchsorted(begins, hits, side="right") - 1
    docs, starts = (np.array([s[i] for s in segments], dtype=np.int64) for i in (0, 1))
    start = starts[of] + hits - begins[of]
    # Neighbouring windows of a segment become one span.
    new = np.append(True, (np.diff(hits) > 1) | (np.diff(of) > 0)) if len(hits) else np.empty(0, bool)
    last = np.append(new[1:], True) if len(hits) else new
    return _found(COVERED, docs[of[new]], start[new], start[last] + length)


def attach_spans(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, wide: int = WIDE) -> tuple[DataFrame, str]:
    """All rows and columns with their spans in one more column, whose name is returned."""
    key, at = (free_name(docs.columns, n) for n in ("suffix_key", "suffix_spans"))
    keyed = docs.withColumn(key, F.xxhash64(col(id_col), col(text_col)))
    found = materialise(spans(keyed.select(key, col(text_col)), key, text_col, length, wide)).withColumnsRenamed({"doc": key, "spans": at})
    size = found.agg(F.sum(F.size(at) * 16 + 32)).first()[0] or 0
    return keyed.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, key, "left").drop(key), at


def clean_spans(found, n: int) -> np.ndarray:
    """Maximal runs within a text of n bytes."""
    pairs = np.array([(s["start"], s["end"]) for s in found or []], dtype=np.int64).reshape(-1, 2)
    pairs = np.minimum(pairs, n)
    return merged(pairs[pairs[:, 1] > pairs[:, 0]])


def without(text: bytes, runs: np.ndarray) -> bytes:
    edges = [0, *runs.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, wide: int = WIDE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    rows, at = attach_spans(docs.select(col(id_col).cast("long").alias(id_col), col(text_col)), id_col, text_col, length, wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            out = []
            for doc, text, found in zip(values(batch, id_col), doc_bytes(batch, text_col), values(batch, at), strict=True):
                runs = clean_spans(found, len(text))
                kept = without(text, runs)
                out.append((doc, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(),) * 4 + (pa.string(),))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def character_runs(text: bytes, runs: np.ndarray) -> np.ndarray:
    """The runs without the characters that they cut through."""
    raw = np.frombuffer(text, dtype=np.uint8)
    whole = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(text))
    start = whole[np.searchsorted(whole, runs[:, 0])]
    end = whole[np.searchsorted(whole, runs[:, 1], side="right") - 1]
    return np.stack([start, end], axis=1)[end > start]


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """All rows and columns, the texts without their repeated passages; characters stay whole, null stays null."""
    rows, at = attach_spans(docs, id_col, text_col, length)
    rows, name = plain_names(rows.select(*[col(c) for c in docs.columns], at))
    kept = list(name.values())[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            place = batch.schema.names.index(name[text_col])
            nulls = batch.column(place).is_null().to_pylist()
            texts = []
            for text, found, null in zip(doc_bytes(batch, name[text_col]), values(batch, name[at]), nulls, strict=True):
                runs = clean_spans(found, len(text))
                texts.append(None if null else (without(text, character_runs(text, runs)) if len(runs) else text).decode())
            columns = [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(columns, names=kept)

    return rows.mapInArrow(run, rows.select(*kept).schema).toDF(*docs.columns)
