"""What the operators share: reading tables, scratch tables, and texts as coded words."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.session import scratch_path

#: Text that one step turns into numpy arrays at a time, in bytes; a longer text is a step of its own.
STEP_BYTES = 12_000_000
#: The same for the classifiers, which hold many numbers for each different word.
SMALL_STEP = 2_000_000
#: The same in the steps of the pipeline's stages, whose rows are wide and whose workers stay from stage to stage.
STAGE_STEP = 1_000_000
#: The same where every document's n-grams are listed, to learn from.
BAG_STEP = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table in the shared scratch folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(key: str, mod: int) -> Column:
    """crc32 of an id's decimal digits, modulo ``mod``; a null id gives null."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(mod))


def labelled_sample(df: DataFrame, label: str, key: str, per_label: int, seed: int = 0) -> DataFrame:
    """About ``per_label`` rows of each label value, drawn by a hash of the key.

    The draw is a filter on a hash, so that no text is shuffled; its expected size is fixed and does
    not grow with the table. Rows without key or label are never drawn. With repeated keys all rows
    of a key are drawn or none.
    """
    known = df.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    counts = known.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return (
        known.join(F.broadcast(counts), F.col(label) == F.col("_label"))
        .where(draw < F.lit(float(per_label)) / F.col("_n"))
        .drop("_label", "_n")
    )


def steps(batch: pa.RecordBatch, text: str = "text", bytes_: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about so many bytes of text, none of them empty."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // bytes_
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def give_back() -> None:
    """Memory that the last step freed goes back to the system: a worker keeps what it once took otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def by_steps(fn: Callable[[pa.RecordBatch], pa.RecordBatch], bytes_: int = STEP_BYTES, text: str = "text"):
    """The function mapInArrow wants, from one that maps a slice of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text, bytes_):
                yield fn(part)
                give_back()

    return run


def text_column(fn: Callable[[pa.Array], pa.Array], kind: str, bytes_: int = STEP_BYTES):
    """An Arrow function of a text column, run in slices: only the texts go to Python, and the rest of
    their rows stays in the executor."""

    @F.arrow_udf(kind)
    def run(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        found = []
        for part in steps(batch, "text", bytes_):
            found.append(fn(part.column(0)))
            give_back()
        return pa.concat_arrays(found) if found else fn(text)

    return run


#: Bits of a Bloom filter, as a power of two; its size does not grow with what it holds.
BLOOM = 26


class Bloom:
    """Which 64-bit hashes may be among some others. Where it holds very many, it says yes to more, never no to one of them.

    Two positions a hash; only the words of the filter, 8 MB at most, come to the driver and go to the tasks.
    """

    def __init__(self, hashes: DataFrame):
        """``hashes`` has one column of longs."""
        spark, (name,) = hashes.sparkSession, hashes.columns
        places = F.explode(F.array(*[F.shiftrightunsigned(name, k * BLOOM).bitwiseAND((1 << BLOOM) - 1) for k in range(2)])).alias("place")
        word, bit = F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
        found = hashes.where(F.col(name).isNotNull()).select(places).select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        words = np.zeros(1 << (BLOOM - 6), np.int64)
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        self.words = spark.sparkContext.broadcast(words)

    def among(self, hashes: np.ndarray) -> np.ndarray:
        words, yes = self.words.value, np.ones(len(hashes), bool)
        for k in range(2):
            place = (hashes.view(np.uint64) >> np.uint64(k * BLOOM)) & np.uint64((1 << BLOOM) - 1)
            yes &= (words.view(np.uint64)[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return yes

    def may(self, hashes: Column) -> Column:
        """The same for a column of longs, without nulls."""

        @F.arrow_udf("boolean")
        def run(column: pa.Array) -> pa.Array:
            return pa.array(self.among(column.to_numpy(zero_copy_only=False)))

        return run(hashes)


class Words:
    """Texts as runs of word numbers: ``codes[starts[i]:starts[i + 1]]`` are the words of text i.

    ``vocabulary`` has each different word of the slice once. Words are what lies between single
    spaces (``spaces=True``: pieces may be empty, or hold other white space), or between runs of
    white space (empty words at the ends of a text are possible). A null text is empty.
    """

    def __init__(self, text: pa.Array, spaces: bool = False):
        text = pc.fill_null(text, "")
        lists = pc.split_pattern(text, " ") if spaces else pc.ascii_split_whitespace(text)
        coded = lists.flatten().dictionary_encode()
        self.vocabulary: pa.StringArray = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = offsets - offsets[0]

    def collapse(self) -> np.ndarray:
        """Keep one of each run of equal words; returns how many words each text lost."""
        same = np.zeros(len(self.codes), bool)
        same[1:] = self.codes[1:] == self.codes[:-1]
        same[self.starts[:-1][np.diff(self.starts) > 0]] = False
        gone = np.concatenate([[0], np.cumsum(same)])[self.starts]
        self.codes, self.starts = self.codes[~same], self.starts - gone
        return np.diff(gone)

    def sums(self, values: np.ndarray, width: int = 8) -> np.ndarray:
        """Per text, the sum over its words of a row per different word; a few columns at a time."""
        blocks = [run_sums(values[:, a : a + width][self.codes], self.starts) for a in range(0, values.shape[1], width)]
        return np.concatenate(blocks, axis=1) if blocks else np.zeros((len(self.starts) - 1, 0))


def run_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values[starts[i]:starts[i + 1]]; an empty run gives zero."""
    n = len(starts) - 1
    out = np.zeros((n, *values.shape[1:]), dtype=np.float64)
    full = np.flatnonzero(np.diff(starts) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, starts[:-1][full], axis=0, dtype=np.float64)
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lengths[i] - 1, for all i in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def grams(words: pa.StringArray, sizes: range, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of ``<word>``: (word number, bucket) for each; buckets is a power of two."""
    framed = pc.binary_join_element_wise(pc.cast("<", words.type), words, pc.cast(">", words.type), "")
    offsets = np.frombuffer(framed.buffers()[1], dtype=np.int32)[framed.offset : framed.offset + len(framed) + 1].astype(np.int64)
    if len(framed) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(framed.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    word = np.repeat(np.arange(len(framed)), np.diff(offsets))
    ids, found = [], []
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    rolling = np.zeros(len(data), np.uint64)
    for n in range(1, sizes.stop):
        if n > len(data):
            break
        rolling = rolling[: len(data) - n + 1] * np.uint64(0x100000001B3) + data[n - 1 :] + np.uint64(n)
        if n in sizes:
            inside = word[: len(rolling)] == word[n - 1 :]
            ids.append(word[: len(rolling)][inside])
            found.append(((rolling[inside] * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64))
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ids), np.concatenate(found)


def crc(ids: np.ndarray) -> int:
    """CRC32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def weighted_bag(doc: np.ndarray, bucket: np.ndarray, weight: np.ndarray, n: int, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse rows (bucket numbers, sums of weights) of n documents."""
    cell, at = np.unique(doc * buckets + bucket, return_inverse=True)
    total = np.bincount(at, weight, len(cell)).astype(np.float32)
    cuts = np.searchsorted(cell, np.arange(n + 1) * buckets)
    return [((cell[a:b] % buckets).astype(np.int32), total[a:b]) for a, b in zip(cuts, cuts[1:])]


def spread_bag(words: Words, word: np.ndarray, bucket: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, weight) from what each different word holds: (word, bucket, weight), sorted by word."""
    order = np.argsort(word, kind="stable")
    word, bucket, weight = word[order], bucket[order], weight[order]
    count = np.bincount(word, minlength=len(words.vocabulary))
    place = np.cumsum(count) - count
    # one row per different word of a document
    doc = np.repeat(np.arange(len(words.starts) - 1), np.diff(words.starts))
    cell, times = np.unique(doc * max(len(count), 1) + words.codes, return_counts=True)
    doc, code = cell // max(len(count), 1), cell % max(len(count), 1)
    at = ragged(place[code], count[code])
    return np.repeat(doc, count[code]), bucket[at], weight[at] * np.repeat(times, count[code])


def sparse_rows(columns: list[pa.Array], names: list[str], rows: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Sparse rows as two binary columns beside others."""
    packed = [pa.array([x.tobytes() for x, _ in rows], pa.binary()), pa.array([v.tobytes() for _, v in rows], pa.binary())]
    return pa.RecordBatch.from_arrays([*columns, *packed], [*names, "buckets", "weights"])


def read_sparse(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Collected sparse rows as (starts, buckets, weights)."""
    found = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["weights"], np.float32)) for r in rows]
    starts = np.concatenate([[0], np.cumsum([len(b) for b, _ in found], dtype=np.int64)]).astype(np.int64)
    empty = [(np.zeros(0, np.int32), np.zeros(0, np.float32))]
    return starts, np.concatenate([b for b, _ in found or empty]), np.concatenate([w for _, w in found or empty])
