"""Token ids in compressed files: an adaptive context-mixing range coder.

Ids are cut into blocks, and each block is coded for itself with a fresh model, so a
damaged block harms no other and any block can be read alone.  For every id the last two
and the last one point to the id that followed them before; one of the two is put
forward, and a mixer weighs what order 2, order 1 and order 0 say about it into the
probability of a hit.  An id that is not the one put forward is coded by the adaptive
order-0 counts.  All arithmetic is on integers, so any machine decodes the same.

The blocks of a segment are coded side by side, one array element per block, because
coding is sequential within a block only.

A segment is: ``TMIX``, version; numbers of documents, ids, blocks, vocabulary size and
ids per block; the documents' ids and lengths; each block's length in ids, crc32 of its ids and length
in bytes; a crc32 of all that; the blocks' bytes.  Reading checks both checksums.

Defined cases: a document without ids has length 0 and keeps its place; no documents make
a segment without blocks.  Null document ids are stored with a flag.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm import tokens
from tallymark.llm.common import col, doc_bytes, values
from tallymark.session import work_path

TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: Ids of a block, of a segment, and blocks coded side by side.
BLOCK_IDS, SEGMENT_IDS, LANES = 4096, 4 << 20, 1024

_MAGIC, _VERSION = b"TMIX", 1
_HEAD = struct.Struct("<4sBIQIII")
_SLOTS = 1 << 12
_GAIN = 15  # what an id adds to its order-0 count; BLOCK_IDS times this fits 16 bits
_RATE, _LEARN = 4, 6
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
_U = np.uint64


@lru_cache(maxsize=1)
def _curves() -> tuple[np.ndarray, np.ndarray]:
    """Integer tables of the logistic function (of -2047 to 2047, in 1/256) and its inverse, in 1/4096."""
    # exp(-k/256) as integers in 1/2**40, by repeated multiplication: the same on any machine.
    one = 1 << 40
    step = 1095220892253  # round(2**40 * exp(-1/256))
    powers, p = [], one
    for _ in range(2048):
        powers.append(p)
        p = p * step >> 40
    squash = [one * 4096 // (one + powers[k]) for k in range(2048)]
    full = [4096 - squash[-k] for k in range(-2047, 0)] + squash
    full = np.clip(np.array(full, dtype=np.int64), 1, 4095)
    stretch = np.searchsorted(full, np.arange(4096)).clip(0, len(full) - 1) - 2047
    return full, stretch.astype(np.int64)


class _Model:
    """What is known about the next id, for blocks side by side.

    Tables are flat, with an offset per block.  A cell of a pointer table holds an id and,
    in its last three bits, how often it was right of late.
    """

    def __init__(self, lanes: int, vocabulary: int):
        self.depth = 1
        while 16**self.depth < vocabulary:
            self.depth += 1
        self.none = 16**self.depth
        row = np.arange(lanes)
        # Counts of ids, and sums over 16, 256, ... neighbours.
        self.sizes = [16 ** (d + 1) for d in range(self.depth)]
        self.counts = [np.full(lanes * n, self.none // n, dtype=np.uint16 if n == self.none else np.int32) for n in self.sizes]
        self.offsets = [row * n for n in self.sizes]
        self.total = np.full(lanes, self.none, dtype=np.int64)
        self.cells = [np.full(lanes * _SLOTS, self.none << 3, dtype=np.int32) for _ in range(2)]
        self.slots = row * _SLOTS
        self.hit = [np.full(lanes * 16, 1 << 15, dtype=np.int32) for _ in range(3)]
        self.contexts = row * 16
        self.weight = np.full((3, lanes), 22000, dtype=np.int64)
        self.last = np.zeros((2, lanes), dtype=np.int64)
        self.squash, self.stretch = _curves()

    def guess(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The id put forward, and the probability of a hit in 1/4096, for the first n blocks."""
        one, two = self.last[:, :n]
        mixed = one * 2654435761
        at = [(mixed >> 7) & (_SLOTS - 1), ((two * 40503 + mixed) >> 9) & (_SLOTS - 1)]
        self.at = [a + self.slots[:n] for a in at]
        now = [table[a] for table, a in zip(self.cells, self.at, strict=True)]
        self.ids, self.sure = [c >> 3 for c in now], [c & 7 for c in now]
        put = np.where(self.sure[1] > 0, self.ids[1], self.ids[0])
        leaf = self.counts[-1][self.offsets[-1][:n] + np.minimum(put, self.none - 1)]
        context = [self.sure[1], self.sure[0] * 2 + (self.ids[0] == put), _CLASS[leaf]]
        self.context = [c + self.contexts[:n] for c in context]
        self.p = [p[c] for p, c in zip(self.hit, self.context, strict=True)]
        self.odds = [self.stretch[p >> 4] for p in self.p]
        dot = (self.weight[0, :n] * self.odds[0] + self.weight[1, :n] * self.odds[1] + self.weight[2, :n] * self.odds[2]) >> 16
        self.chance = self.squash[np.clip(dot, -2047, 2047) + 2047]
        return put, self.chance

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        n = len(ids)
        error = ((hit << 12) - self.chance) * _LEARN
        goal = ((hit << 16) - hit).astype(np.int32)
        for k in range(3):
            self.weight[k, :n] += (self.odds[k] * error + (1 << 9)) >> 10
            self.hit[k][self.context[k]] = self.p[k] + ((goal - self.p[k]) >> _RATE)
        for k in range(2):
            same, sure = self.ids[k] == ids, self.sure[k]
            # A wrong pointer first loses trust, then its place.
            kept = np.where(same, np.minimum(sure + 1, 7), sure - 1) + (self.ids[k] << 3)
            self.cells[k][self.at[k]] = np.where(~same & (sure <= 1), (ids << 3) + 1, kept)
        at = ids
        for counts, offset in zip(reversed(self.counts), reversed(self.offsets), strict=True):
            counts[offset[:n] + at] += _GAIN
            at = at >> 4
        self.total[:n] += _GAIN
        self.last[1, :n] = self.last[0, :n]
        self.last[0, :n] = ids

    def _rows(self, level: int, lanes: np.ndarray, parent: np.ndarray) -> np.ndarray:
        return self.counts[level].reshape(-1, 16).take(lanes * (self.sizes[level] // 16) + parent, axis=0)

    def below(self, lanes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all smaller ids, and of the ids."""
        smaller = np.zeros(len(lanes), dtype=np.int64)
        for level in range(self.depth):
            here = ids >> 4 * (self.depth - 1 - level)
            smaller += np.einsum("ij,ij->i", self._rows(level, lanes, here >> 4), _SMALLER[here & 15], dtype=np.int64, casting="safe")
        return smaller, self.counts[-1][self.offsets[-1][lanes] + ids].astype(np.int64)

    def find(self, lanes: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id whose count a target below the total falls into, with ``below`` of it."""
        at, smaller = np.zeros(len(lanes), dtype=np.int64), np.zeros(len(lanes), dtype=np.int64)
        each = np.arange(len(lanes))
        for level in range(self.depth):
            rows = self._rows(level, lanes, at)
            sums = np.cumsum(rows, axis=1, dtype=np.int32)
            child = (sums <= (target - smaller).astype(np.int32)[:, None]).sum(axis=1)
            smaller += sums[each, child] - rows[each, child]
            at = at * 16 + child
        return at, smaller, self.counts[-1][self.offsets[-1][lanes] + at].astype(np.int64)


#: Row i marks the children before child i.
_SMALLER = np.tri(16, k=-1, dtype=np.int32)
#: A rough logarithm of an order-0 count.
_CLASS = np.minimum(np.searchsorted([2, 17, 32, 62, 122, 242, 482], np.arange(1 << 16), side="right"), 7)


def _narrow(low, span, lanes, below, count, total):
    part = span[lanes] // total.astype(np.uint64)
    low[lanes] += part * below.astype(np.uint64)
    span[lanes] = part * count.astype(np.uint64)


def _settled(low, span):
    """Elements whose first 16 bits are final, or whose span is too small; these are cut to what is."""
    with np.errstate(over="ignore"):
        same = (low ^ (low + span)) < _TOP
        short = ~same & (span < _BOTTOM)
    if short.any():
        span[short] = (~low[short] + _U(1)) & (_BOTTOM - _U(1))
    return np.flatnonzero(same | short)


def encode_blocks(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """Each block of ids for itself; longest blocks first."""
    lengths = np.array([len(b) for b in blocks])
    longest = int(lengths.max(initial=0))
    ids = np.zeros((longest, len(blocks)), dtype=np.int64)
    for i, b in enumerate(blocks):
        ids[: len(b), i] = b
    model = _Model(len(blocks), vocabulary)
    low, span = np.zeros(len(blocks), dtype=np.uint64), np.full(len(blocks), np.iinfo(np.uint64).max, dtype=np.uint64)
    out, at = np.zeros((len(blocks), 3 * longest + 8), dtype=">u2"), np.zeros(len(blocks), dtype=np.int64)
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
    for i in range(longest):
        n = int(alive[i])
        here = ids[i, :n]
        put, chance = model.guess(n)
        hit = put == here
        cut = (span[:n] >> _U(12)) * chance.astype(np.uint64)
        low[:n] += np.where(hit, _U(0), cut)
        span[:n] = np.where(hit, cut, span[:n] - cut)
        miss = np.flatnonzero(~hit)
        if len(miss):
            _narrow(low, span, miss, *model.below(miss, here[miss]), model.total[miss])
        model.learn(here, hit.astype(np.int64))
        while len(ready := _settled(low[:n], span[:n])):
            out[ready, at[ready]] = (low[ready] >> _U(48)).astype(np.uint16)
            at[ready] += 1
            low[ready] <<= _U(16)
            span[ready] <<= _U(16)
    for _ in range(4):
        out[np.arange(len(blocks)), at] = (low >> _U(48)).astype(np.uint16)
        at += 1
        low <<= _U(16)
    return [out[i, : at[i]].tobytes() for i in range(len(blocks))]


def decode_blocks(payloads: list[bytes], lengths: np.ndarray, vocabulary: int) -> list[np.ndarray]:
    """The ids of each block; longest blocks first."""
    longest, lanes = int(lengths.max(initial=0)), len(payloads)
    widest = max(map(len, payloads), default=0) // 2 + longest + 8
    data = np.zeros((lanes, widest), dtype=np.uint16)
    for i, p in enumerate(payloads):
        data[i, : len(p) // 2] = np.frombuffer(p, dtype=">u2")
    model = _Model(lanes, vocabulary)
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, np.iinfo(np.uint64).max, dtype=np.uint64)
    code, at = np.zeros(lanes, dtype=np.uint64), np.full(lanes, 4)
    for i in range(4):
        code = (code << _U(16)) | data[:, i].astype(np.uint64)
    ids = np.zeros((longest, lanes), dtype=np.int64)
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
    for i in range(longest):
        n = int(alive[i])
        put, chance = model.guess(n)
        cut = (span[:n] >> _U(12)) * chance.astype(np.uint64)
        hit = (code[:n] - low[:n]) < cut
        low[:n] += np.where(hit, _U(0), cut)
        span[:n] = np.where(hit, cut, span[:n] - cut)
        here = np.minimum(put, model.none - 1).astype(np.int64)  # damaged bytes may hit an empty cell
        miss = np.flatnonzero(~hit)
        if len(miss):
            total = model.total[miss]
            target = np.minimum((code[miss] - low[miss]) // (span[miss] // total.astype(np.uint64)), (total - 1).astype(np.uint64))
            here[miss], below, count = model.find(miss, target.astype(np.int64))
            _narrow(low, span, miss, below, count, total)
        ids[i, :n] = here
        model.learn(here, hit.astype(np.int64))
        while len(ready := _settled(low[:n], span[:n])):
            code[ready] = (code[ready] << _U(16)) | data[ready, at[ready]].astype(np.uint64)
            at[ready] += 1
            low[ready] <<= _U(16)
            span[ready] <<= _U(16)
    return [ids[: lengths[i], i].astype("<u4") for i in range(lanes)]


def write_segment(docs: list[tuple[int | None, bytes]], vocabulary: int, block_ids: int = BLOCK_IDS) -> bytes:
    """(document id, packed ids) in order, as one segment."""
    stream = np.frombuffer(b"".join(ids for _, ids in docs), dtype="<u4")
    blocks = [stream[i : i + block_ids] for i in range(0, len(stream), block_ids)]
    payloads: list[bytes] = []
    for i in range(0, len(blocks), LANES):
        payloads += encode_blocks(blocks[i : i + LANES], vocabulary)
    index = b"".join(struct.pack("<III", len(b), zlib.crc32(b.tobytes()), len(p)) for b, p in zip(blocks, payloads, strict=True))
    table = b"".join(struct.pack("<BqQ", doc is None, doc or 0, len(ids) // 4) for doc, ids in docs)
    head = _HEAD.pack(_MAGIC, _VERSION, len(docs), len(stream), len(blocks), vocabulary, block_ids) + table + index
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(payloads)


def read_segment(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) in order; raises ValueError where a checksum fails or the segment is cut off."""
    if len(data) < _HEAD.size:
        raise ValueError("the segment is cut off")
    magic, version, n_docs, n_ids, n_blocks, vocabulary, _ = _HEAD.unpack_from(data)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a segment of this format")
    entry, block = struct.Struct("<BqQ"), struct.Struct("<III")
    end = _HEAD.size + n_docs * entry.size + n_blocks * block.size
    if len(data) < end + 4:
        raise ValueError("the segment is cut off")
    if struct.unpack_from("<I", data, end)[0] != zlib.crc32(data[:end]):
        raise ValueError("the head of the segment is damaged")
    docs = [entry.unpack_from(data, _HEAD.size + i * entry.size) for i in range(n_docs)]
    first = _HEAD.size + n_docs * entry.size
    index = [block.unpack_from(data, first + i * block.size) for i in range(n_blocks)]
    at, payloads = end + 4, []
    if len(data) < at + sum(size for _, _, size in index):
        raise ValueError("the segment is cut off")
    for _, _, size in index:
        payloads.append(data[at : at + size])
        at += size
    found: list[np.ndarray] = []
    for i in range(0, n_blocks, LANES):
        lengths = np.array([x[0] for x in index[i : i + LANES]])
        found += decode_blocks(payloads[i : i + LANES], lengths, vocabulary)
    for number, (ids, (_, crc, _)) in enumerate(zip(found, index, strict=True)):
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {number} is damaged")
    stream = np.concatenate(found) if found else np.empty(0, dtype="<u4")
    start = 0
    for missing, doc, length in docs:
        yield None if missing else doc, stream[start : start + length]
        start += length


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Segments of all documents' ids in ascending order of document id, one row each."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    vocabulary = len(tokens.load(tokenizer).get_vocab(with_added_tokens=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.encoder(tokenizer).encode, tokens.packed([end_id])
        part, made, waiting, size = TaskContext.get().partitionId(), 0, [], 0

        def segment() -> pa.RecordBatch:
            row = {"part": [part], "segment": [made], "n_ids": [size], "data": [write_segment(waiting, vocabulary)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())]))

        for batch in batches:
            for doc, text in zip(values(batch, "doc_id"), doc_bytes(batch, "text"), strict=True):
                ids = encode(text.decode()) + end
                waiting.append((doc, ids))
                size += len(ids) // 4
                if size >= SEGMENT_IDS:
                    yield segment()
                    made, waiting, size = made + 1, [], 0
        if waiting:
            yield segment()

    ordered.mapInArrow(run, "part int, segment int, n_ids long, data binary").write.parquet(path)


def read(spark, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; with ``digest`` the ids' crc32 in place of the ids."""
    segments = spark.read.parquet(path)
    before = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    # One row of two numbers per segment of millions of ids.
    offsets = segments.select("part", "segment", "n_ids").withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).drop("n_ids")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, firsts = (batch.column(batch.schema.get_field_index(n)) for n in ("data", "first"))
            for i in range(batch.num_rows):
                start, rows = firsts[i].as_py(), []
                for doc, ids in read_segment(data[i].as_py()):
                    body = ids.tobytes()
                    rows.append((doc, start, len(ids), zlib.crc32(body) if digest else body))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    ddl = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")
    return segments.join(F.broadcast(offsets), ["part", "segment"]).select("data", "first").mapInArrow(run, ddl)


def round_trip(docs: DataFrame, digest: bool = True) -> DataFrame:
    """Write all documents to a fresh folder below the shared one and read them back."""
    path = work_path(docs.sparkSession, "segments")
    write(docs, path)
    return read(docs.sparkSession, path, digest)
