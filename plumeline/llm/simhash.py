"""SimHash near-duplicates through a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.common import by_steps, written
from plumeline.operators.select import connected_components

#: Words of a shingle, seed of its hash, and differing bits that still link.
SHINGLE, SEED, RADIUS = 3, 42, 3
#: Bits of the blocks a fingerprint is cut into. RADIUS differing bits leave two of five blocks alike.
BLOCKS = (13, 13, 13, 13, 12)
#: Children of a node of the index; groups up to FLAT rows are compared without one.
FAN, FLAT = 16, 64
#: Pairs of nodes that are opened at once; rows of a chunk that meets others of its group.
OPENED, CHUNK = 1 << 16, 4096

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> bytes:
    """SimHash of word shingles, eight bytes, highest bit first; repeats count.

    A-Z are lower-cased and words are split at ASCII white space. Fewer words than a shingle are one
    shingle; none give zero.
    """
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()
    if not words:
        return bytes(8)
    whole = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_digest(whole, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    hashes = [xxh64_digest(whole[a:b], SEED) for a, b in zip((ends - size)[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())]
    bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).tobytes()


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each word in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i], in place; a label is the smallest row of its class."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (nxt := label[label] != label).any():
            label[nxt] = label[label[nxt]]


class Level:
    """Nodes of one level: the bits that all fingerprints below share, and one label if they have one."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high
        self.fixed = ~(low ^ high)

    @staticmethod
    def above(low: np.ndarray, high: np.ndarray) -> Level:
        cuts = np.arange(0, len(low), FAN)
        return Level(np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts))


def link_group(prints: np.ndarray, label: np.ndarray, rows: np.ndarray, radius: int) -> None:
    """Join all fingerprints of a group (rows in Gray order) that differ in at most ``radius`` bits.

    Upper nodes hold the masked pattern their fingerprints share. A pair of nodes is dropped as soon
    as the shared patterns alone differ in more bits, or when both sides are one class already;
    otherwise its children meet. Neighbours in Gray order are joined first, so that dense groups are
    one class before their nodes are opened.
    """
    own = prints[rows]
    for step in (1, 2, 3):
        near = np.flatnonzero(np.bitwise_count(own[step:] ^ own[:-step]) <= radius)
        settle(label, rows[near], rows[near + step])
    levels = [Level(own, own)]
    while len(levels[-1].low) > 1:
        levels.append(Level.above(levels[-1].low, levels[-1].high))
    work = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        depth, a, b = work.pop()
        if len(a) > OPENED:
            work.append((depth, a[OPENED:], b[OPENED:]))
            a, b = a[:OPENED], b[:OPENED]
        level = levels[depth]
        keep = np.bitwise_count((level.low[a] ^ level.low[b]) & level.fixed[a] & level.fixed[b]) <= radius
        a, b = a[keep], b[keep]
        if depth == 0:
            settle(label, rows[a], rows[b])
            continue
        width = FAN**depth
        cuts = np.arange(0, len(rows), width)
        mine = label[rows]
        least, most = np.minimum.reduceat(mine, cuts), np.maximum.reduceat(mine, cuts)
        one = (least[a] == most[a]) & (least[b] == most[b]) & (least[a] == least[b])
        a, b = a[~one], b[~one]
        if not len(a):
            continue
        below = len(levels[depth - 1].low)
        kids = np.arange(FAN)
        x = np.repeat(a * FAN, FAN * FAN) + np.tile(np.repeat(kids, FAN), len(a))
        y = np.repeat(b * FAN, FAN * FAN) + np.tile(kids, FAN * len(a))
        good = (x < below) & (y < below) & ((x < y) if depth == 1 else (x <= y))
        work.append((depth - 1, x[good], y[good]))


def link_sorted(prints: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """Labels (smallest row of a class) of fingerprints sorted by group and Gray rank."""
    n = len(prints)
    label = np.arange(n)
    starts = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1]) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(starts, n))
    flat = np.repeat(size <= FLAT, size)
    for step in range(1, FLAT):
        rows = np.flatnonzero((group[step:] == group[:-step]) & flat[step:])
        if not len(rows):
            break
        near = rows[np.bitwise_count(prints[rows + step] ^ prints[rows]) <= radius]
        settle(label, near, near + step)
    for a, k in zip(starts[size > FLAT].tolist(), size[size > FLAT].tolist()):
        link_group(prints, label, np.arange(a, a + k), radius)
    return label


def links_of(prints: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """One link (src, dst) per fingerprint that isn't its class's first."""
    rows = np.flatnonzero(label != np.arange(len(label)))
    src, dst = prints[rows].view(np.int64), prints[label[rows]].view(np.int64)
    both = np.unique(np.stack([src[src != dst], dst[src != dst]], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["src", "dst"])


LINKS = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (src, dst) whose classes are those of all pairs within ``radius`` bits.

    ``prints`` has each fingerprint once (fp long). Any two within the radius agree on two of the five
    blocks, so each fingerprint goes to ten groups by the bits it has there. Rows are range-sorted by
    group and Gray rank: a large group lies over many partitions, which link their own rows. What a
    partition has of its first and last group also goes to the other partitions' shares of the same
    groups, in chunks; pairs of chunks whose shared bits differ too much never meet.
    """
    at, edges = [], 64
    for width in BLOCKS:
        edges -= width
        at.append(((1 << width) - 1) << edges)
    masks = [a | b for a, b in combinations(at, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("g"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    gray = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        gray = gray.bitwiseXOR(F.shiftrightunsigned(gray, s))
    keyed = prints.select("fp", gray.alias("gray"), F.explode(keys).alias("k")).select(F.col("k.g").alias("g"), F.col("k.key").alias("key"), "gray", "fp")
    # The range sort runs its input twice (once for the cuts), which is cheap here.
    ordered = keyed.repartitionByRange("g", "key", "gray").sortWithinPartitions("g", "key", "gray")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        g, key, fp = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in (0, 1, 3))
        prints = fp.view(np.uint64)
        group = np.cumsum(np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])]))
        own = links_of(prints, link_sorted(prints, group, radius))
        n = own.num_rows
        yield pa.RecordBatch.from_arrays([*own.columns, *(pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))], NAMES)
        part = TaskContext.get().partitionId() << 32
        number = 0
        for edge in sorted({int(group[0]), int(group[-1])}):
            a, b = np.searchsorted(group, [edge, edge + 1])
            for c in range(a, b, CHUNK):
                chunk = prints[c : min(c + CHUNK, b)]
                row = [g[c], key[c], np.bitwise_and.reduce(chunk).view(np.int64), np.bitwise_or.reduce(chunk).view(np.int64), chunk.tobytes(), part + number]
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), *(pa.array([v], t) for v, t in zip(row, types))], NAMES)
                number += 1

    NAMES = ["src", "dst", "g", "key", "low", "high", "prints", "chunk"]
    kinds = (T.LongType(), T.LongType(), T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.BinaryType(), T.LongType())
    found = written(ordered.mapInArrow(link, T.StructType([T.StructField(c, t) for c, t in zip(NAMES, kinds)])), "links")
    chunks = found.where("chunk is not null").drop("src", "dst")
    other = chunks.select("g", "key", *[F.col(c).alias(f"o_{c}") for c in ("low", "high", "prints", "chunk")])
    # Only shares of different partitions: a partition has linked its own.
    apart = F.bit_count(F.expr("(low ^ o_low) & ~(low ^ high) & ~(o_low ^ o_high)")) <= radius
    pairs = chunks.join(other, ["g", "key"]).where("shiftright(chunk, 32) < shiftright(o_chunk, 32)").where(apart)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                both = np.concatenate([np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in (0, 1)])
                both = both[np.argsort(gray_rank(both), kind="stable")]
                yield links_of(both, link_sorted(both, np.zeros(len(both), np.int64), radius))

    return found.where("src is not null").select("src", "dst").unionByName(pairs.select("prints", "o_prints").mapInArrow(meet, LINKS))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked, and a component is named by
    the smallest key reachable. Each different fingerprint is looked up once, however many rows have
    it. A null or empty text has fingerprint zero, linked like any other. Rows with a null key have a
    component by their links; it is null if no row in it has a key. Other columns are ignored, and an
    empty table gives no rows.
    """

    def prints(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = b"".join(fingerprint(t, shingle) for t in batch.column(1).to_pylist())
        values = np.frombuffer(found, ">u8").astype(np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["key", "fp"])

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = T.StructType([source.schema["key"], T.StructField("fp", T.LongType())])
    rows = written(source.mapInArrow(by_steps(prints), schema), "prints")
    lows = rows.groupBy("fp").agg(F.min("key").alias("low"))
    classes = connected_components(near_links(lows.select("fp"), radius))
    named = lows.join(classes, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("component", "fp").alias("class"))
    least = named.groupBy("class").agg(F.min("low").alias("component_id"))
    named = named.join(least, "class").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
