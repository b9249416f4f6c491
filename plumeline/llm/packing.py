"""Packing along a space-filling curve: neighbouring documents share training sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumeline.llm.common import by_steps, give_back, run_sums, written
from plumeline.llm.tokens import BYTE_BPE, coder

#: Dimensions of the projected document vectors, and bits of each on the curve.
DIMS, BITS = 3, 16
#: Text encoded at a time, in bytes: beside it stand its words, ids, and a vector for each id.
STEP = 4_000_000
#: Buckets that token ids are hashed to before the projection.
BUCKETS = 2048


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of integer points (one row each, 0 <= x < 2**bits).

    Walks from the highest bit down: each level's orthant is undone by a reflection or an exchange
    of axes, then the axes are Gray-decoded and their bits interleaved.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def projection(seed: int = 7) -> np.ndarray:
    """Token id -> DIMS numbers: a hashed one-hot vector of BUCKETS times a fixed Gaussian matrix."""
    bucket = (np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(53)).astype(np.int64)
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMS)).astype(np.float32)[bucket % BUCKETS]


def curve_places(ids: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert key of each document from its ids' projected mean direction."""
    vectors = run_sums(table[ids], starts)
    norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    unit = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
    return hilbert_key(np.minimum(((unit + 1) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def binary_runs(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """ids[starts[i]:starts[i + 1]] as bytes, without a copy per row."""
    offsets = (starts * ids.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])


def tokenized(docs: DataFrame, tokenizer: str = BYTE_BPE, end: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, curve, ids as little-endian unsigned 16-bit integers) of every row."""
    table = projection()

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts, _ = coder(tokenizer).encode(batch.column(1), end)
        places = curve_places(ids, starts, table)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(places), binary_runs(ids, starts)], ["key", "curve", "ids"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = T.StructType([source.schema["key"], T.StructField("curve", T.LongType()), T.StructField("ids", T.BinaryType())])
    return source.mapInArrow(by_steps(encode, STEP), schema)


class Cutter:
    """Cuts a stream of documents into sequences; holds back what doesn't fill one yet."""

    def __init__(self, length: int, first: int):
        self.length, self.next = length, first
        self.ids = np.zeros(0, np.uint16)
        self.rows: list[pa.Array] = []  # keys and curve places of the open part's documents
        self.start = self.size = self.total = np.zeros(0, np.int64)

    def add(self, key: pa.Array, curve: pa.Array, ids: np.ndarray, size: np.ndarray) -> pa.RecordBatch | None:
        if self.rows:
            key, curve = pa.concat_arrays([self.rows[0], key]), pa.concat_arrays([self.rows[1], curve])
        self.rows = [key, curve]
        self.ids = np.concatenate([self.ids, ids])
        self.start = np.concatenate([self.start, np.zeros(len(size), np.int64)])
        self.size, self.total = np.concatenate([self.size, size]), np.concatenate([self.total, size])
        return self._cut(np.arange(0, len(self.ids) + 1, self.length))

    def rest(self) -> pa.RecordBatch | None:
        """The last part as sequences whose lengths are powers of two: none of them needs padding."""
        left, cuts = len(self.ids), [0]
        for k in range(left.bit_length() - 1, -1, -1):
            if left >> k & 1:
                cuts.append(cuts[-1] + (1 << k))
        return self._cut(np.array(cuts))

    def _cut(self, cuts: np.ndarray) -> pa.RecordBatch | None:
        """Pieces up to the last cut; documents past it stay."""
        if len(cuts) < 2:
            return None
        b = np.cumsum(self.size)
        a = b - self.size
        edge = int(cuts[-1])
        done = np.flatnonzero(a < edge)
        first, last = np.searchsorted(cuts, a[done], "right") - 1, np.searchsorted(cuts, np.minimum(b[done], edge), "left") - 1
        count = last - first + 1
        doc = np.repeat(done, count)
        seq = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        lo, hi = np.maximum(a[doc], cuts[seq]), np.minimum(b[doc], cuts[seq + 1])
        whole = np.concatenate([lo, [edge]])
        key, curve = (r.take(pa.array(doc)) for r in self.rows)
        out = pa.RecordBatch.from_arrays(
            [key, pa.array(self.start[doc] + lo - a[doc]), pa.array(hi - lo), pa.array(self.total[doc]), pa.array(self.next + seq), pa.array(lo - cuts[seq]), binary_runs(self.ids[:edge].astype("<u4"), whole), curve],
            ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "curve"],
        )
        keep = np.flatnonzero(b > edge)
        used = np.maximum(edge - a[keep], 0)
        self.rows = [r.take(pa.array(keep)) for r in self.rows]
        self.start, self.size, self.total = self.start[keep] + used, self.size[keep] - used, self.total[keep]
        self.ids, self.next = self.ids[edge:], self.next + len(cuts) - 1
        return out


def pack_along_curve(docs: DataFrame, length: int = 2048, tokenizer: str = BYTE_BPE, end: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents, packed into sequences of ``length`` tokens along a Hilbert curve.

    Each document is encoded once, with ``end`` after it; its hashed token vector, projected to a few
    dimensions, gives its place on the curve. Rows are range-sorted by that place, and each range is
    cut every ``length`` tokens, so that only neighbours share a sequence and nothing is padded. A
    range's last part becomes sequences whose lengths are powers of two, at most 11 of them.

    Returns (key, start, length, doc_tokens, sequence_id, offset, ids, curve): ``ids`` are the piece's
    ids as little-endian unsigned 32-bit integers. A null or empty text is the end id alone. A null
    key is kept as null. Repeated rows are packed as often as they come. Other columns are ignored.
    An empty table gives no rows.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(length, TaskContext.get().partitionId() << 36)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column = batch.column(2)
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            ids = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint16)
            if (out := cutter.add(batch.column(0), batch.column(1), ids, np.diff(offsets) // 2)) is not None:
                yield out
            give_back()
        if (out := cutter.rest()) is not None:
            yield out

    encoded = written(tokenized(docs, tokenizer, end, key, text), "pack")
    ordered = encoded.repartitionByRange("curve", "key").sortWithinPartitions("curve", "key", "ids")
    longs = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([encoded.schema["key"], *(T.StructField(c, T.LongType()) for c in longs), T.StructField("ids", T.BinaryType()), T.StructField("curve", T.LongType())])
    return ordered.mapInArrow(pack, schema).withColumnRenamed("key", key)
