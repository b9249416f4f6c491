"""Document fingerprints that subtract: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A paragraph: up to 100 characters without full stop or line end, and the stops after them.
PARAGRAPH = r"[^.\n]{1,100}[.\n]*|[.\n]+"
#: Cells of each of a bucket's three rows, first and at each retry; a bucket has about LOAD digests.
WIDTHS, LOAD = (4, 16, 64), 3
#: Bits of a digest: a checksum of the rest, then the bucket, then a place of seven bits per row.
CHECK, BUCKET, PLACE = 0xFFFF, 16, 32


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _inside(digest: str, cell: str, width: int) -> str:
    """Whether a digest belongs to a cell: the cell knows its row's shift and its place there."""
    return f"(shiftright({digest}, {cell}.s) & {width - 1}L) = {cell}.r"


def digests(text: str) -> str:
    """Paragraph digests of a text, sorted. The n-th copy of a paragraph has a digest of its own."""
    hashes = f"sort_array(transform(regexp_extract_all({text}, r'{PARAGRAPH}', 0), p -> xxhash64(p)))"
    copy = "if(i > 0 and get(s, i - 1) = x, i + 1 - array_position(s, x), 0L)"
    one = _let(f"xxhash64(x, {copy}) & ~65535L", "d", "d | (xxhash64(d) & 65535L)")
    return _let(hashes, "s", f"transform(s, (x, i) -> {one})")


def cells(ours: str, width: int, theirs: str | None = None) -> str:
    """Three rows of cells: how many digests fall in each, and their exclusive or; less another side's."""

    def row(shift: int) -> str:
        falls = lambda side: f"filter({side}, d -> (shiftright(d, {shift}) & {width - 1}L) = r)"
        folded = lambda side: f"aggregate({side}, 0L, (a, d) -> a ^ d)"
        if theirs is None:
            cell = _let(falls(ours), "x", f"named_struct('c', size(x), 'k', {folded('x')}, 's', {shift}, 'r', r)")
        else:
            minus = f"named_struct('c', size(both.x) - size(both.y), 'k', {folded('both.x')} ^ {folded('both.y')}, 's', {shift}, 'r', r)"
            cell = _let(f"named_struct('x', {falls(ours)}, 'y', {falls(theirs)})", "both", minus)
        return f"transform(sequence(0L, {width - 1}L), r -> {cell})"

    return f"concat({', '.join(row(PLACE + 7 * n) for n in range(3))})"


def peeled(ours: str, theirs: str, width: int) -> str:
    """The difference of two sketches taken apart: a cell with one digest left gives it away.

    A round takes out all digests that some cell gives away. Returns a struct of the cells that stay,
    and (sign, digest) of those found.
    """
    pure = f"abs(z.c) = 1 and {_inside('z.k', 'z', width)} and (xxhash64(z.k & ~65535L) & 65535L) = (z.k & 65535L)"
    seen = f"array_distinct(transform(filter(t.cells, z -> {pure}), z -> named_struct('c', z.c, 'k', z.k)))"
    less = "named_struct('c', z.c - o.c, 'k', z.k ^ o.k, 's', z.s, 'r', z.r)"
    taken = f"transform(t.cells, y -> aggregate(seen, y, (z, o) -> if({_inside('o.k', 'z', width)}, {less}, z)))"
    go_on = f"named_struct('cells', {taken}, 'found', concat(t.found, seen), 'go', true)"
    step = _let(seen, "seen", f"if(size(seen) = 0, named_struct('cells', t.cells, 'found', t.found, 'go', false), {go_on})")
    none = "cast(array() as array<struct<c: int, k: bigint>>)"
    start = f"named_struct('cells', {cells(ours, width, theirs)}, 'found', {none}, 'go', true)"
    return f"aggregate(sequence(1, size({ours}) + size({theirs})), {start}, (t, n) -> if(t.go, {step}, t))"


def bucket_difference(ours: str, theirs: str) -> str:
    """(sign, digest) of what differs in one bucket, and how many could not be told apart.

    A sketch that doesn't peel to nothing is made again, larger. What the largest leaves is counted
    from its cells: each digest is in three.
    """
    body = None
    for width in reversed(WIDTHS):
        stuck = "filter(t.cells, z -> z.c != 0 or z.k != 0)"
        failed = body or f"named_struct('found', t.found, 'open', cast(round(aggregate({stuck}, 0, (a, z) -> a + z.c * z.c) / 3) as int))"
        body = _let(peeled(ours, theirs, width), "t", f"if(size({stuck}) = 0, named_struct('found', t.found, 'open', 0), {failed})")
    none = "named_struct('found', cast(array() as array<struct<c: int, k: bigint>>), 'open', 0)"
    alone = lambda side, sign: f"named_struct('found', transform({side}, d -> named_struct('c', {sign}, 'k', d)), 'open', 0)"
    # Equal buckets subtract to nothing, and a bucket that one side lacks is the other side.
    return f"if({ours} = {theirs}, {none}, if(size({theirs}) = 0, {alone(ours, 1)}, if(size({ours}) = 0, {alone(theirs, -1)}, {body})))"


def difference(ours: str, theirs: str) -> str:
    """Buckets' differences of two digest lists. Digests go to groups by some bits and from there to
    buckets, so the work is near the number of digests."""
    bits = f"least(greatest(cast(ceil(log2((size({ours}) + size({theirs})) / {LOAD} + 1)) as int), 0), 16)"
    half = "cast(b div 2 as int)"
    masks = f"named_struct('g', shiftleft(1L, {half}) - 1, 's', {BUCKET} + {half}, 'h', shiftleft(1L, b - {half}) - 1)"
    in_group = lambda side: f"filter({side}, d -> (shiftright(d, {BUCKET}) & m.g) = g)"
    in_bucket = lambda side: f"filter({side}, d -> (shiftright(d, m.s) & m.h) = h)"
    bucket = _let(f"named_struct('x', {in_bucket('q.x')}, 'y', {in_bucket('q.y')})", "w", bucket_difference("w.x", "w.y"))
    group = _let(f"named_struct('x', {in_group(ours)}, 'y', {in_group(theirs)})", "q", f"transform(sequence(0L, m.h), h -> {bucket})")
    return _let(bits, "b", _let(masks, "m", f"flatten(transform(sequence(0L, m.g), g -> {group}))"))


def likeness(ours: str, theirs: str) -> str:
    """Shared digests among all, from the recovered difference; two empty texts are alike."""
    apart = f"aggregate({difference(ours, theirs)}, 0, (a, x) -> a + size(x.found) + x.open)"
    total = f"(size({ours}) + size({theirs}))"
    return _let(apart, "v", f"if({total} = 0, 1D, least(greatest(({total} - v) / ({total} + v), 0D), 1D))")


def printed(items: str) -> str:
    """The smallest sketch over all digests, as hex: 12 cells of a count and a key."""
    return f"array_join(transform({cells(items, WIDTHS[0])}, z -> concat(lpad(hex(z.c), 6, '0'), lpad(hex(z.k), 16, '0'))), '')"


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, next): each row's text and that of the next row by key; after the last comes the first.

    Rows are dealt to ranges of the key, cut at approximate quantiles, and each range also gets the
    first row of the one after it, so no window holds more than a range. Null keys come first, equal
    keys are ordered by text, and a null text is empty.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] or []
    cuts = sorted(set(cuts))
    # Binary search by halves would be nested conditions; a list of cuts is short enough to count.
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("key"))) if cuts else F.lit(0)
    dealt = rows.withColumn("part", F.greatest(part, F.lit(0))).withColumn("guest", F.lit(False))
    heads = dealt.groupBy("part").agg(F.min(F.struct("key", "text")).alias("head"))
    by_part = Window.orderBy("part")
    host = F.coalesce(F.lag("part").over(by_part), F.max("part").over(Window.partitionBy()))
    guests = heads.select(F.col("head.key").alias("key"), F.col("head.text").alias("text"), host.alias("part"), F.lit(True).alias("guest"))
    following = F.lead("text").over(Window.partitionBy("part").orderBy("guest", "key", "text"))
    return dealt.unionByName(guests).withColumn("next", following).where("not guest").select(F.col("key").alias(key), "text", "next")


def sketch_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Adds the digests of text columns: names of new columns by text column."""
    return df.withColumns({new: F.expr(digests(f"`{old}`")) for old, new in names.items()})


def compare_versions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sketches of every text, of an edited version of it, and their likeness.

    The edited text has the last floor(n / 2) of its n code points replaced by as many of the next
    row's first ones (all of them, if it is shorter). Returns (key, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next); ``near`` is the share of paragraph digests in common,
    from subtracting sketches and peeling the difference. Equal texts have equal fingerprints.

    A null text is empty, and an empty one has no digests. Repeated rows are each other's next row.
    Other columns are ignored; an empty table gives no rows.
    """
    pairs = with_next(docs, key, text).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next", F.lit(1), half))
    made = sketch_columns(pairs.withColumn("edited", edited), {"text": "ours", "edited": "theirs", "next": "others"})
    return made.select(
        key, "n_chars", "edited",
        F.expr(printed("ours")).alias("fingerprint"), F.expr(printed("theirs")).alias("edited_fingerprint"),
        F.expr(likeness("ours", "theirs")).alias("near_edited"), F.expr(likeness("ours", "others")).alias("near_next"),
    )
