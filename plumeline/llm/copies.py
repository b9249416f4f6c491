"""Near copies by the Jaccard similarity of word shingles: candidates from SimHash fingerprints and banded minima, then exact sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.common import STAGE_STEP, Bloom, Words, by_steps, give_back, steps, written
from plumeline.llm.simhash import RADIUS, fingerprint, near_links
from plumeline.operators.select import connected_components

#: Words of a shingle, seed of its hash, and the least similarity that links (4 of 5).
SHINGLE, SEED, LEAST = 5, 42, (4, 5)
#: A pair at similarity s shares none of the bands with chance (1 - s**DEPTH)**BANDS: 2 in 100,000 at 0.8.
BANDS, DEPTH = 28, 5
#: Two bits of each of so many minima are a row's sketch. Of the 256 bits a pair at 0.8 differs in 26 with a
#: deviation of 6; pairs that differ in more than FAR (chance at 0.8: one in a billion) are not looked at.
SKETCHED, FAR = 128, 60
#: Bits of a set's parities: each shingle turns one of them, so two sets differ in as many shingles at least as in bits.
PARITIES = 512
#: Rounds in which a bucket's rows meet one of its rows only, before the pairs that are still apart meet.
ROUNDS = 2
#: Hashes of shingles that meet the multipliers at a time.
BLOCK = 2048

FACTORS = np.random.default_rng(SEED).integers(1, 1 << 63, BANDS * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a word spread over the whole word."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def shingle_sets(text: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The different shingles of each text as sorted hashes.

    A-Z are lower-cased and words are split at ASCII white space. Fewer words than a shingle are one
    shingle; none give an empty set.
    """
    from xxhash import xxh64_intdigest

    words = Words(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(text, ""))))
    names = words.vocabulary.to_pylist()
    hashes = np.fromiter((xxh64_intdigest(w.encode(), SEED) for w in names), np.uint64, len(names))[words.codes]
    empty = np.array([w == "" for w in names], bool)[words.codes] if names else np.zeros(0, bool)

    def fold(columns: list[np.ndarray]) -> np.ndarray:
        total = np.full(len(columns[0]), len(columns), np.uint64)
        for column in columns:
            total = mixed(total + column)
        return total

    long = len(hashes) - shingle + 1
    runs = fold([hashes[k : k + long] for k in range(shingle)]) if long > 0 else np.zeros(0, np.uint64)
    found = []
    for a, b in zip(words.starts.tolist(), words.starts[1:].tolist()):
        if b - a >= shingle:
            found.append(np.unique(runs[a : b - shingle + 1]))
        else:
            own = hashes[a:b][~empty[a:b]]
            found.append(fold([own[k : k + 1] for k in range(len(own))]) if len(own) else np.zeros(0, np.uint64))
    return found


def minima(own: np.ndarray) -> np.ndarray:
    """The least products of the set's hashes with each multiplier."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(own), BLOCK):
        least = np.minimum(least, (own[a : a + BLOCK, None] * FACTORS).min(axis=0))
    return least


def bands_of(own: np.ndarray, least: np.ndarray | None = None) -> np.ndarray:
    """One bucket per band, from the minima of its multipliers; none for an empty set."""
    if not len(own):
        return np.zeros(0, np.int64)
    bucket = np.arange(BANDS, dtype=np.uint64)
    for column in (minima(own) if least is None else least).reshape(BANDS, DEPTH).T:
        bucket = mixed(bucket + column)
    return bucket.view(np.int64)


def sketch_of(least: np.ndarray) -> np.ndarray:
    """256 bits of the minima, as four longs."""
    bits = mixed(least[:SKETCHED])[:, None] >> np.array([40, 50], np.uint64) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel()).view(np.int64)


def parities_of(own: np.ndarray) -> np.ndarray:
    """Whether an odd number of the set's hashes begin with each nine bits, as eight longs."""
    counts = np.bincount((own >> np.uint64(64 - (PARITIES - 1).bit_length())).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of distinct hashes are at the least similarity or above it."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def numbered(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """A set's identity: 126 bits of a digest as a decimal, and 64 other bits as a hash."""
    from xxhash import xxh3_64_intdigest, xxh3_128_digest

    raw = np.frombuffer(b"".join(xxh3_128_digest(s.tobytes()) for s in sets), np.uint64).reshape(-1, 2).copy()
    raw[:, 1] &= np.uint64((1 << 62) - 1)
    ids = pa.Array.from_buffers(pa.decimal128(38, 0), len(sets), [None, pa.py_buffer(raw.tobytes())])
    return ids, pa.array(np.array([xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64))


def print_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of rows (print, id, more) whose fingerprints are near: columns of one end with ``_src``, of the other with ``_dst``.

    Every fingerprint is looked up in the Gray-ordered index, for its least row. A row is paired with the
    least one of its own fingerprint, and least ones with each other as the index links them: the pairs
    hold together what all pairs within ``radius`` bits would.
    """
    heads = prints.join(prints.groupBy("print").agg(F.min("id").alias("id")), ["print", "id"])
    end = lambda df, name: df.select(*[F.col(c).alias(f"{c}_{name}") for c in df.columns])
    alike_ = end(prints, "src").join(end(heads, "dst"), F.col("print_src") == F.col("print_dst")).where("id_src <> id_dst")
    links = near_links(heads.select(F.col("print").alias("fp")), radius)
    near = links.join(end(heads, "src"), F.col("src") == F.col("print_src")).join(end(heads, "dst"), F.col("dst") == F.col("print_dst"))
    return alike_.unionByName(near.drop("src", "dst"))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (src, dst) whose sets are alike."""
    ends = [sets.select(F.col("id").alias(end), F.col("own").alias(f"own_{end}")) for end in ("src", "dst")]
    joined = pairs.join(ends[1], "dst").join(ends[0], "src")
    both = F.size(F.array_intersect("own_src", "own_dst"))
    return joined.where(LEAST[1] * both >= LEAST[0] * (F.size("own_src") + F.size("own_dst") - both)).select("src", "dst")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id) of every row.

    Rows whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are linked, and a
    component is named by the smallest key reachable. Candidates have SimHash fingerprints of the same
    shingles within ``RADIUS`` bits, found in the index of ``simhash``, or share the minima of a band;
    each is held against the exact sets before it links. A bucket's rows first meet one of them, drawn anew in
    each round, so that a large group of copies is one component before pairs are formed; then the rows
    outside a bucket's largest component meet those of its other components, as far as their sizes,
    sketches and parities allow a similarity of 0.8. Equal sets, the empty one included, are one row here. Rows with a null key have a
    component by their links; it is null if no row in it has a key. Rows with equal keys, or equal
    texts, are rows of their own. Other columns are ignored, and an empty table gives no rows. A text is
    turned into its set in one task, whatever its length.
    """
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def marks(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1))
        ids, hashes = numbered(sets)
        least = [minima(s) for s in sets]
        sketches = np.array([sketch_of(x) for x in least]).reshape(-1, 4)
        parities = np.array([parities_of(s) for s in sets]).reshape(-1, PARITIES // 64)
        buckets = pa.array([bands_of(s, x) for s, x in zip(sets, least)], pa.list_(pa.int64()))
        prints = np.frombuffer(b"".join(fingerprint(t, SHINGLE) for t in batch.column(1).to_pylist()), ">u8").astype(np.uint64)
        columns = [batch.column(0), ids, hashes, pa.array(prints.view(np.int64)), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(x.copy(), pa.int64()) for x in (*sketches.T, *parities.T)], buckets]
        return pa.RecordBatch.from_arrays(columns, ["key", "id", *longs, "buckets"])

    sketch, parity = [f"s{i}" for i in range(4)], [f"p{i}" for i in range(PARITIES // 64)]
    whole, longs = T.DecimalType(38, 0), ("hash", "print", "size", *sketch, *parity)
    kinds = [source.schema["key"], T.StructField("id", whole), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("buckets", T.ArrayType(T.LongType()))]
    rows = written(source.mapInArrow(by_steps(marks, STAGE_STEP), T.StructType(kinds)), "marks")
    met = rows.select("id", "hash", "size", *sketch, F.explode("buckets").alias("bucket")).groupBy("bucket", "id").agg(*[F.min(c).alias(c) for c in ("hash", "size", *sketch)])
    shared = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(met.join(shared, "bucket", "left_semi"), "buckets")
    differing = lambda words: " + ".join(f"bit_count({w}_src ^ {w}_dst)" for w in words)
    near = f"least(size_src, size_dst) * {LEAST[1]} >= greatest(size_src, size_dst) * {LEAST[0]} and {differing(sketch)} <= {FAR}"
    # Sets of m and n shingles at the least similarity a/b differ in (b - a) / (b + a) * (m + n) shingles at most.
    within = f"({differing(parity)}) * {sum(LEAST)} <= (size_src + size_dst) * {LEAST[1] - LEAST[0]}"
    prints = rows.where("size > 0").groupBy("print", "id").agg(*[F.min(c).alias(c) for c in ("hash", "size", *sketch)])
    printed = written(print_pairs(written(prints, "prints")).where(near).select("id_src", "id_dst", "hash_src", "hash_dst"), "printed")
    looked = met.select("id", "hash").unionByName(printed.selectExpr("stack(2, id_src, hash_src, id_dst, hash_dst) as (id, hash)"))
    # Texts become sets a second time here, of candidates only: the sets of all rows would take more
    # room than the texts. A task gives each set once.
    among = Bloom(looked.select("hash"))

    def kept(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in steps(batch, bytes_=STAGE_STEP):
                sets = shingle_sets(part.column(0))
                ids, hashes = numbered(sets)
                fresh = []
                for i, (h, yes) in enumerate(zip(hashes.to_pylist(), among.among(hashes.to_numpy()))):
                    if yes and h not in seen:
                        seen.add(h)
                        fresh.append(i)
                for a in range(0, len(fresh), 256):
                    at = fresh[a : a + 256]
                    own = pa.array([sets[i].view(np.int64) for i in at], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), own], ["id", "own"])
                give_back()

    found = source.select("text").mapInArrow(kept, T.StructType([T.StructField("id", whole), T.StructField("own", T.ArrayType(T.LongType()))]))
    needed = written(looked.select("id").distinct(), "needed")
    sets = written(found.join(needed, "id", "left_semi").dropDuplicates(["id"]), "sets")

    one = met.select("bucket", *[F.col(c).alias(f"{n}_src" if n else "src") for c, n in (("id", ""), ("size", "size"), *[(s, s) for s in sketch])])
    ends = [F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")]
    classes, links = None, None
    for turn in range(ROUNDS + 1):
        classed = one.withColumn("class_src", F.col("src"))
        if classes is not None:
            classed = one.join(classes, F.col("src") == F.col("node"), "left").select(*one.columns, F.coalesce("component", "src").alias("class_src"))
            parts = classed.groupBy("bucket", "class_src").agg(F.count(F.lit(1)).alias("n"))
            apart = parts.groupBy("bucket").agg(F.max(F.struct("n", "class_src")).alias("most"), F.count(F.lit(1)).alias("k")).where("k > 1")
            classed = written(classed.join(apart.select("bucket", F.col("most.class_src").alias("main")), "bucket"), "apart")
        if turn == ROUNDS:
            # Parities travel with the few rows whose buckets are still apart only.
            wanted = rows.join(classed.select(F.col("src").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id"])
            classed = classed.join(wanted.select(F.col("id").alias("src"), *[F.col(c).alias(f"{c}_src") for c in parity]), "src")
        other = classed.drop("main").select("bucket", *[F.col(c).alias(c.replace("src", "dst")) for c in classed.columns if c not in ("bucket", "main")])
        if turn < ROUNDS:
            draw = F.xxhash64("dst", F.lit(turn))
            # The head's own columns follow in a join: the least draw alone is aggregated.
            head = other.groupBy("bucket").agg(F.min(draw).alias("draw"))
            other = other.withColumn("draw", draw).join(head, ["bucket", "draw"]).drop("draw")
            pairs = classed.join(other, "bucket").where("class_src <> class_dst")
        else:
            lone = classed.where("class_src <> main")
            pairs = lone.join(other, "bucket").where("class_src <> class_dst and (class_dst = main or src < dst)").where(within)
        pairs = pairs.where(near).select("src", "dst")
        if turn == 0:
            pairs = pairs.unionByName(printed.select(F.col("id_src").alias("src"), F.col("id_dst").alias("dst")))
        new = written(linked(pairs.select(*ends).distinct(), sets), "links")
        links = new if links is None else links.unionByName(new)
        classes = written(connected_components(links), "classes")
    lows = rows.groupBy("id").agg(F.min("key").alias("low"))
    named = lows.join(classes, F.col("id") == F.col("node"), "left").select("id", "low", F.coalesce("component", "id").alias("class"))
    least = named.groupBy("class").agg(F.min("low").alias("component_id"))
    named = named.join(least, "class").select("id", "component_id")
    return rows.join(named, "id").select(F.col("key").alias(key), "component_id")
