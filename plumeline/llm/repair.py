"""Token ids as files compressed by a Re-Pair grammar per shard, readable from any place."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.common import steps
from plumeline.llm.packing import binary_runs
from plumeline.llm.tokens import WORD_BPE, coder

MAGIC = b"RPG1"
HEADER = "<4sIIII"
#: Ids of a shard at which it is closed; a longer document is a shard of its own.
SHARD_IDS = 1 << 20
#: Rounds of replacement, new rules per round at most, and the fewest places a rule must have.
ROUNDS, ROUND_RULES, LEAST = 5, 3000, 8
#: Passes that settle overlapping places within a round; what is left waits for the next round.
CHAIN = 4


def compress(ids: np.ndarray, terminals: int, rounds: int = ROUNDS, round_rules: int = ROUND_RULES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Codes and rules (pairs of codes) of one shard; rule k is the code ``terminals + k``.

    A round counts all neighbouring pairs, makes a rule of each of the most frequent, and replaces
    their places; where two overlap, the more frequent pair's place stays, then the one on the left.
    """
    codes, rules = ids.astype(np.uint16), [np.zeros((0, 2), np.uint16)]
    made = 0
    for _ in range(rounds):
        n, room = len(codes) - 1, min(round_rules, 65536 - terminals - made)
        if n < least or room <= 0:
            break
        pair = (codes[:-1].astype(np.uint64) << np.uint64(16)) | codes[1:]
        ordered = np.sort((pair << np.uint64(32)) | np.arange(n, dtype=np.uint64))
        place, pair = (ordered & np.uint64(0xFFFFFFFF)).astype(np.int64), ordered >> np.uint64(32)
        first = np.concatenate([[0], np.flatnonzero(pair[1:] != pair[:-1]) + 1])
        count = np.diff(first, append=n)
        best = np.lexsort((pair[first], -count))[:room]
        best = best[count[best] >= least]
        if not len(best):
            break
        where = place[np.repeat(first[best] - np.cumsum(count[best]) + count[best], count[best]) + np.arange(count[best].sum())]
        free = 2 * len(best)
        rank = np.full(n + 2, free, np.int32)  # of the rule that starts at place - 1
        rank[where + 1] = np.repeat(2 * np.arange(len(best), dtype=np.int32), count[best])
        own = rank[1:-1]
        # a run of one id is one rule at every place: every second place comes first
        breaks = np.concatenate([[True], own[1:] != own[:-1]])
        own += ((np.arange(n) - np.maximum.accumulate(np.where(breaks, np.arange(n), 0))) & 1).astype(np.int32) * (own < free)
        chosen = np.zeros(n, bool)
        for _ in range(CHAIN):
            pick = (own < rank[:-2]) & (own <= rank[2:]) & (own < free)
            if not pick.any():
                break
            chosen |= pick
            taken = pick.copy()
            taken[1:] |= pick[:-1]
            taken[:-1] |= pick[1:]
            own[taken] = free
        spots = np.flatnonzero(chosen)
        mark = np.full(n, -1, np.int32)
        mark[where] = np.repeat(np.arange(len(best), dtype=np.int32), count[best])
        used, again = np.unique(mark[spots], return_inverse=True)
        rules.append(np.stack([pair[first[best[used]]] >> np.uint64(16), pair[first[best[used]]] & np.uint64(0xFFFF)], axis=1).astype(np.uint16))
        codes = codes.copy()
        codes[spots] = (terminals + made + again).astype(np.uint16)
        codes = np.delete(codes, spots + 1)
        made += len(used)
    return codes, np.concatenate(rules)


def expand(codes: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids of a run of codes: every rule opens into its pair until none is left."""
    while len(at := np.flatnonzero(codes >= terminals)):
        size = np.ones(len(codes), np.int64)
        size[at] = 2
        end = np.cumsum(size)
        out = np.empty(int(end[-1]), np.uint16)
        out[end - size] = codes
        pairs = rules[codes[at].astype(np.int64) - terminals]
        out[end[at] - 2], out[end[at] - 1] = pairs[:, 0], pairs[:, 1]
        codes = out
    return codes


def lengths_of(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each rule expands to; a rule only names rules before it."""
    size = np.ones(terminals + len(rules), np.int64)
    pairs = rules.astype(np.int64)
    while True:
        new = size[pairs].sum(axis=1)
        if (new == size[terminals:]).all():
            return new
        size[terminals:] = new


class Shard:
    """One shard's bytes: header, rules, expansion lengths, ids per document, codes."""

    def __init__(self, data: bytes):
        magic, self.terminals, n_rules, n_docs, n_codes = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        at = struct.calcsize(HEADER)

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.rules = read("<u2", 2 * n_rules).reshape(-1, 2)
        self.sizes = read("<u4", n_rules)
        self.documents = read("<u4", n_docs).astype(np.int64)
        self.codes = read("<u2", n_codes)

    @staticmethod
    def pack(ids: np.ndarray, documents: np.ndarray, terminals: int) -> bytes:
        codes, rules = compress(ids, terminals)
        sizes = lengths_of(rules, terminals).astype("<u4")
        head = struct.pack(HEADER, MAGIC, terminals, len(rules), len(documents), len(codes))
        return b"".join([head, rules.astype("<u2").tobytes(), sizes.tobytes(), documents.astype("<u4").tobytes(), codes.astype("<u2").tobytes()])

    def ids(self, start: int = 0, length: int | None = None) -> np.ndarray:
        """Ids from any place of the shard: only the codes that cover it are expanded."""
        if length is None and start == 0:
            return expand(self.codes, self.rules, self.terminals)
        size = np.concatenate([np.ones(self.terminals, np.int64), self.sizes])[self.codes]
        end = np.cumsum(size)
        stop = int(end[-1]) if length is None else start + length
        a, b = np.searchsorted(end, start, "right"), np.searchsorted(end, stop, "left")
        skip = start - int(end[a] - size[a]) if a < len(end) else 0
        return expand(self.codes[a : b + 1], self.rules, self.terminals)[skip : skip + stop - start]


def write_shards(docs: DataFrame, path: str, tokenizer: str = WORD_BPE, terminals: int = 49408, end: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode all documents in ascending order of their key and write compressed shards to ``path``.

    Rows are range-partitioned by the key; a partition's documents are cut into shards of about
    SHARD_IDS ids, each with its own grammar. A row of the table is one shard: (part, seq, n_ids,
    keys, shard bytes). Null texts are empty, null keys come first, rows with equal keys keep the
    order of their texts, other columns are ignored, and an empty table writes no shard.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        open_ids, open_keys, open_sizes, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal open_ids, open_keys, open_sizes, held, seq
            keys, sizes = pa.concat_arrays(open_keys), np.concatenate(open_sizes)
            ids = np.concatenate(open_ids)
            lists = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), lists, pa.array([Shard.pack(ids, sizes, terminals)], pa.binary())]
            open_ids, open_keys, open_sizes, held = [], [], [], 0
            seq += 1
            return pa.RecordBatch.from_arrays(row, ["part", "seq", "n_ids", "keys", "shard"])

        for batch in batches:
            for step in steps(batch):
                ids, starts, _ = coder(tokenizer).encode(step.column(1), end)
                a = 0
                while a < step.num_rows:
                    b = int(np.searchsorted(starts, starts[a] + SHARD_IDS - held, "right")) - 1
                    b = min(max(b, a + 1), step.num_rows)
                    open_ids.append(ids[starts[a] : starts[b]])
                    open_keys.append(step.column(0).slice(a, b - a))
                    open_sizes.append(np.diff(starts[a : b + 1]))
                    held += int(starts[b] - starts[a])
                    if b < step.num_rows or held >= SHARD_IDS:
                        yield close()
                    a = b
        if open_keys:
            yield close()

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("keys", T.ArrayType(source.schema["key"].dataType)),
        T.StructField("shard", T.BinaryType()),
    ])
    source.repartitionByRange("key").sortWithinPartitions("key", "text").mapInArrow(encode, schema).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, key, place, n_tokens, ids) of every document, from the files.

    ``place`` is where the document starts in its shard; ``ids`` are little-endian unsigned 32-bit
    integers. ``shard_starts`` has where each shard starts among all ids.
    """
    shards = spark.read.parquet(path).select("part", "seq", "keys", "shard")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(3)[i].as_py())
                starts = np.concatenate([[0], np.cumsum(shard.documents)])
                n = len(shard.documents)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(c)[i].as_py(), np.int32)) for c in (0, 1)]
                    + [batch.column(2)[i].values, pa.array(starts[:-1]), pa.array(shard.documents), binary_runs(shard.ids().astype("<u4"), starts)],
                    ["part", "seq", "key", "place", "n_tokens", "ids"],
                )

    schema = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("key", shards.schema["keys"].dataType.elementType),
        T.StructField("place", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])
    return shards.mapInArrow(decode, schema)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, shard_start): ids before each shard. Parts are summed first, so that the only
    window without a key has one row per part."""
    shards = spark.read.parquet(path).select("part", "seq", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("part_start"))
    inside = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))
    return shards.select("part", "seq", inside.alias("inside")).join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("inside")).alias("shard_start"))
