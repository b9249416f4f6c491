"""A prefix trie of conversations from sorted matrices of turn ids.

A conversation is a row of 16-byte turn ids, cut into slabs of ``WIDTH`` turns. Slabs are dealt to range
shards by (slab, what came before, ids, conversation), so that the members of every node lie next to
each other. A shard is one padded matrix: a lexsort brings equal prefixes together, the changes from
row to row, accumulated by OR along the columns, mark where nodes start, and reduceat adds up each
depth. Only the nodes of a shard's first and last row can go on in another shard; their parts are put
together afterwards, and what they hold is handed up to the nodes above them.

A node below the last column of a slab continues in the next slab. What a later slab holds under its
root is handed to one member of the root, whose rows of the earlier slabs add it to their nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.llm.common import written
from plumeline.llm.merkle import crc_sql
from plumeline.llm.order import earlier_totals, placed

#: Turns of a slab, and rows that a shard has on average.
WIDTH, SHARD = 16, 16_384
#: Bytes of a turn's id, and its end in hex digits.
ID = 16
#: Conversation ids in one part of the list of a node that may lie in several shards.
PART = 4096
NOTHING = sha256(b"").hexdigest()


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth from 1, id, size, n_turns) of every turn: its place, digest, and the UTF-8 bytes of its text.

    Turns are ordered by number (null first), equal numbers by a digest of role and text. Null role or
    text is empty. Rows without a conversation id belong to no conversation and are left out.
    """
    who, what = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what)
    rows = conversations.where(conversations[conv].isNotNull()).select(
        conversations[conv].cast("long").alias("conv_id"), conversations[turn].alias("turn"), F.substring(F.sha2(told, 256), 1, 2 * ID).alias("id"), F.octet_length(what).cast("long").alias("size")
    )
    rows = placed(written(rows, "turns"), ["conv_id"], ["turn", "id"])
    return rows.select("conv_id", (F.col("place") + 1).alias("depth"), "id", "size", F.col("total").alias("n_turns"))


def rebuilt(turns: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """Every conversation with its first h turns from the first conversation of its group of ids.

    h is the id's CRC-32 modulo ``most`` + 1, and a conversation's own turns follow after its first h.
    Missing turns are not replaced. A row of depth 0 stands for each conversation.
    """
    turns = written(turns, "numbered")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1))
    lead = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    convs = turns.where("depth = 1").select("conv_id", "n_turns")
    others = convs.where(F.pmod("conv_id", F.lit(group)) != 0).select("conv_id", h.alias("h"), lead.alias("lead"))
    leads = convs.where(F.pmod("conv_id", F.lit(group)) == 0).select(F.col("conv_id").alias("lead"), "n_turns")
    others = written(others.join(leads, "lead", "left").select(F.col("conv_id").alias("c"), "h", F.least("h", F.coalesce("n_turns", F.lit(0))).alias("m")), "leads")
    first = turns.where((F.pmod("conv_id", F.lit(group)) == 0) & (F.col("depth") <= most))
    first = first.select(F.explode(F.sequence(F.col("conv_id") + 1, F.col("conv_id") + group - 1)).alias("c"), "depth", "id", "size")
    first = first.join(others, "c").where("depth <= h").select(F.col("c").alias("conv_id"), "depth", "id", "size")
    own = turns.join(others, F.col("conv_id") == F.col("c"), "left").where("c is null or depth > h")
    own = own.select("conv_id", (F.col("depth") - F.coalesce(F.col("h") - F.col("m"), F.lit(0))).alias("depth"), "id", "size")
    none = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("id"), F.lit(0).cast("long").alias("size"))
    return first.unionByName(own).unionByName(none)


def slabs_of(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, slab, ids, sizes, more, pa, pb): a conversation's turns by so many, and a digest of the turns before.

    A slab that is full is followed by another, even if that is empty; ``more`` tells whether it has turns.
    """
    turns = written(turns.select("conv_id", "depth", "id", "size"), "steps")
    one = F.when(F.col("depth") > 0, F.struct("depth", "id", "size"))
    slab = F.when(F.col("depth") > 0, F.expr(f"(depth - 1) div {width}")).otherwise(F.lit(0))
    rows = turns.select("conv_id", slab.alias("slab"), one.alias("turn"), F.lit(False).alias("more"))
    nothing = F.lit(None).cast(rows.schema["turn"].dataType).alias("turn")
    ends = turns.where((F.col("depth") > 0) & (F.col("depth") % width == 0)).select("conv_id", F.expr(f"depth div {width}").alias("slab"), nothing, F.lit(False).alias("more"))
    starts = turns.where((F.col("depth") > width) & (F.col("depth") % width == 1 % width)).select("conv_id", F.expr(f"(depth - 1) div {width} - 1").alias("slab"), nothing, F.lit(True).alias("more"))
    grouped = rows.unionByName(ends).unionByName(starts).groupBy("conv_id", "slab").agg(F.sort_array(F.collect_list("turn")).alias("turns"), F.max("more").alias("more"))
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    found = grouped.select("conv_id", "slab", ids.alias("ids"), F.transform("turns", lambda t: t["size"]).alias("sizes"), "more")
    found = written(found, "slabs")
    zero = [F.lit(0).cast("long").alias(c) for c in ("pa", "pb")]
    long = (F.col("slab") > 0) | (F.size("sizes") == width)
    if found.where("slab > 0").isEmpty():
        return found.select("*", *zero)
    before = earlier_totals(
        found.where(long), ["conv_id"], ["slab"], {"pa": F.xxhash64("slab", "ids"), "pb": F.xxhash64("ids", F.lit(7), "slab")}, F.bit_xor, lambda a, b: a.bitwiseXOR(b)
    )
    return written(found.where(~long).select("*", *zero).unionByName(before), "slabs")


NODES = (
    "slab long, pa long, pb long, depth long, key binary, parent binary, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, more boolean, ends_sha256 string, ends string"
)
NAMES = [p.split()[0] for p in NODES.split(", ")]


def node_key(slab: int, a: int, b: int, depth: int, prefix: bytes) -> bytes:
    """A node's name: its slab's root, and the ids down to it."""
    return blake2b(b"%d,%d,%d,%d;" % (slab, a, b, depth) + prefix, digest_size=ID).digest()


def shard_nodes(rows: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard, depth by depth; those of its first and last row with a key, to be put together."""
    n = rows.num_rows
    if n == 0:
        return
    ids = rows.column("ids").combine_chunks()
    lengths = np.array([len(x) // ID for x in ids.to_pylist()], np.int64) if n else np.zeros(0, np.int64)
    deepest = int(lengths.max())
    matrix = np.zeros((n, max(deepest, 1), 2), np.uint64)
    sizes = np.zeros((n, max(deepest, 1)), np.int64)
    cells = np.arange(max(deepest, 1))[None, :] < lengths[:, None]
    matrix[cells] = np.frombuffer(b"".join(ids.to_pylist()), ">u8").reshape(-1, 2)
    sizes[cells] = rows.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    number = {c: rows.column(c).to_numpy() for c in ("slab", "pa", "pb", "conv_id", "x_children", "x_leaves", "x_saved")}
    more = rows.column("more").to_numpy().astype(bool)

    # Shorter rows come before the longer ones that go on from them: a column that is not there is least.
    columns = [k for j in range(deepest - 1, -1, -1) for k in (matrix[:, j, 1], matrix[:, j, 0], cells[:, j])]
    order = np.lexsort([number["conv_id"], *columns, number["pb"], number["pa"], number["slab"]])
    matrix, sizes, cells, lengths, more = matrix[order], sizes[order], cells[order], lengths[order], more[order]
    number = {c: v[order] for c, v in number.items()}

    changed = np.ones((n, deepest + 1), bool)
    changed[1:, 0] = False
    for c in ("slab", "pa", "pb"):
        changed[1:, 0] |= number[c][1:] != number[c][:-1]
    if deepest:
        changed[1:, 1:] = (matrix[1:, :deepest] != matrix[:-1, :deepest]).any(axis=2) | (cells[1:, :deepest] != cells[:-1, :deepest])
    started = np.logical_or.accumulate(changed, axis=1)

    kept = []  # per depth: member rows, starts, and each node's sums
    for d in range(deepest + 1):
        at = np.flatnonzero(lengths >= d)
        start = started[at, d].copy()
        start[0] = True
        first = np.flatnonzero(start)
        name = np.cumsum(start) - 1
        count = np.diff(np.append(first, len(at)))
        whole = np.ones(len(first), bool)
        whole[0] &= at[0] != 0
        whole[-1] &= at[-1] != n - 1
        kept.append({"at": at, "first": first, "name": name, "count": count, "whole": whole, "conv": np.minimum.reduceat(number["conv_id"][at], first)})

    below = None
    for d in range(deepest, -1, -1):
        node = kept[d]
        at, first = node["at"], node["first"]
        full = d == width
        going = np.logical_or.reduceat(more[at] & (lengths[at] == d), first) if full else np.zeros(len(first), bool)
        if full:
            children, leaves, saved = (np.add.reduceat(number[c][at], first) for c in ("x_children", "x_leaves", "x_saved"))
        else:
            children, leaves, saved = (np.zeros(len(first), np.int64) for _ in range(3))
        if below is not None:
            place = np.full(n, -1)
            place[at] = node["name"]
            parent = place[below["at"][below["first"]]]
            below["parent"] = parent
            children = children + np.bincount(parent, below["whole"], len(first)).astype(np.int64)
            for total, c in ((leaves, "leaves"), (saved, "saved")):
                np.add.at(total, parent, below[c])
        node["size"] = sizes[at[first], d - 1] if d else np.zeros(len(first), np.int64)
        bare = node["whole"] & (children == 0) & ~going
        if d == 0:
            bare &= number["slab"][at[first]] == 0
        node.update(children=children, leaves=leaves + bare, saved=saved + np.where(node["whole"], (node["count"] - 1) * node["size"], 0), going=going)
        below = node

    keys: list[dict[int, bytes]] = []
    for d, node in enumerate(kept):
        own = {}
        for i in np.flatnonzero(~node["whole"]).tolist():
            r = node["at"][node["first"][i]]
            own[i] = node_key(*(int(number[c][r]) for c in ("slab", "pa", "pb")), d, matrix[r, :d].astype(">u8").tobytes())
        keys.append(own)

    schema = pa.schema(
        [(x, {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}[k]) for x, k in (p.split() for p in NODES.split(", "))]
    )
    for d, node in enumerate(kept):
        at, first, m = node["at"], node["first"], len(node["first"])
        here = at[first]
        ended = np.flatnonzero((lengths[at] == d) & ~(more[at] & (d == width)))
        owner, conv = node["name"][ended], number["conv_id"][at[ended]]
        cut = np.searchsorted(owner, np.arange(m + 1))
        digests, parts = [NOTHING] * m, []
        for i in np.unique(owner).tolist():
            told = [str(c) for c in conv[cut[i] : cut[i + 1]].tolist()]
            if node["whole"][i]:
                digests[i] = sha256(",".join(told).encode()).hexdigest()
            else:
                parts += [(i, int(told[k]), ",".join(told[k : k + PART])) for k in range(0, len(told), PART)]
        if d:
            up, above = node["parent"], kept[d - 1]
            parent_conv = pa.array(above["conv"][up], pa.int64(), mask=~above["whole"][up])
            parent_key = pa.array([keys[d - 1].get(i) for i in up.tolist()], pa.binary())
        else:
            parent_conv, parent_key = pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array(number[c][here], pa.int64()) for c in ("slab", "pa", "pb")], pa.array(np.full(m, d), pa.int64()), pa.array([keys[d].get(i) for i in range(m)], pa.binary()),
                parent_key, pa.array(node["conv"], pa.int64()), parent_conv, *[pa.array(node[c].astype(np.int64)) for c in ("count", "children", "leaves", "saved", "size")],
                pa.array(node["going"], pa.bool_()), pa.array(digests, pa.string()), pa.nulls(m, pa.string()),
            ], schema=schema,
        )
        if parts:
            rest = {"key": [keys[d][i] for i, _, _ in parts], "conv_id": [c for _, c, _ in parts], "ends": [e for _, _, e in parts]}
            yield pa.RecordBatch.from_arrays([pa.array(rest[f.name], f.type) if f.name in rest else pa.nulls(len(parts), f.type) for f in schema], schema=schema)


def ends_of(parts: DataFrame) -> DataFrame:
    """(key, ended): the digest of each node's list, read part by part in order; a list is never held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["key", "ended"])

        for batch in batches:
            for key, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != last:
                    if last is not None:
                        yield done()
                    last, state = key, sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
        if last is not None:
            yield done()

    return parts.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, ended string")


def slab_nodes(slabs: DataFrame, width: int, shard: int) -> DataFrame:
    """Every node of every slab, its columns whole: shards first, then the nodes that lie in several."""
    spark = slabs.sparkSession
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-slabs.count() // shard))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if found:
            yield from shard_nodes(pa.Table.from_batches(found), width)

    raw = written(slabs.repartitionByRange(shards, "slab", "pa", "pb", "ids", "conv_id").mapInArrow(scan, NODES), "nodes")
    nodes, parts = raw.where("ends is null").drop("ends"), raw.where("ends is not null").select("key", "conv_id", "ends")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    low = F.min(F.struct("slab", "pa", "pb", "depth", "parent", "size")).alias("of")
    shared = nodes.where("key is not null").groupBy("key").agg(low, F.min("conv_id").alias("conv_id"), *sums, F.max("more").alias("more"))
    shared = written(shared.select("key", "of.*", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "more"), "shared")
    kids = shared.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    shared = shared.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    bare = (F.col("n_children") == 0) & ~F.col("more") & ((F.col("depth") > 0) | (F.col("slab") == 0))
    shared = written(shared.withColumn("own_leaf", bare.cast("long")).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("size")), "shared")
    # What a shared node adds itself goes to it and to all above it, one level a turn.
    up = shared.select("key", "parent", "own_leaf", "own_saved", F.col("key").alias("top"))
    levels = [up]
    parents = shared.select(F.col("key").alias("of"), F.col("parent").alias("next"))
    for _ in range(width):
        step = levels[-1].where("parent is not null").select("own_leaf", "own_saved", F.col("parent").alias("top"))
        step = step.groupBy("top").agg(F.sum("own_leaf").alias("own_leaf"), F.sum("own_saved").alias("own_saved"))
        levels.append(written(step.join(parents, F.col("top") == F.col("of")).select("own_leaf", "own_saved", "top", F.col("next").alias("parent")), "up"))
        if levels[-1].isEmpty():
            break
    total = None
    for level in levels:
        part = level.select("top", "own_leaf", "own_saved")
        total = part if total is None else total.unionByName(part)
    total = total.groupBy(F.col("top").alias("key")).agg(F.sum("own_leaf").alias("add_leaf"), F.sum("own_saved").alias("add_saved"))
    shared = shared.join(total, "key").join(ends_of(parts), "key", "left").select(
        "key", "slab", "pa", "pb", "depth", "parent", "conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("add_leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("add_saved")).alias("saved_tokens"), "more", F.coalesce("ended", F.lit(NOTHING)).alias("ends_sha256"),
    )
    shared = written(shared, "shared")
    whole = nodes.where("key is null")
    columns = ["slab", "depth", "parent", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    every = whole.select(*columns).unionByName(shared.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    names = shared.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    inside = every.where("parent is null")
    below = every.where("parent is not null").join(names, F.col("parent") == F.col("up"), "left").withColumn("parent_conv_id", F.col("up_conv")).drop("up", "up_conv")
    return inside.unionByName(below).drop("parent")


def prefix_trie(turns: DataFrame, width: int = WIDTH, shard: int = SHARD) -> DataFrame:
    """One row per node: the different sequences of a conversation's first turns, the empty one included.

    ``turns`` has (conv_id, depth, id, size) as ``numbered`` gives them, gapless from depth 1; a row of
    depth 0 only says that its conversation exists. Turns are equal if their ids are. Columns: conv_id
    (the smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. An empty table has no nodes. Equal conversations are members of the same
    nodes; conversations of any length and nodes with any number of members are spread over shards.
    """
    slabs = slabs_of(turns, width)
    extra = ["x_children", "x_leaves", "x_saved"]
    zero = [F.lit(0).cast("long").alias(c) for c in extra]
    later = slabs.where("slab > 0")
    if later.isEmpty():
        found = slab_nodes(written(slabs.select("*", *zero), "rows"), width, shard)
    else:
        roots = slab_nodes(written(later.select("*", *zero), "rows"), width, shard).where("depth = 0")
        roots = written(roots.select("conv_id", "slab", "n_children", "n_leaves", "saved_tokens"), "roots")
        # A later slab's sums go to all earlier slabs of its root's first member, its children to the one before.
        told = roots.select("conv_id", "slab", F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
        with_own = slabs.join(told, ["conv_id", "slab"], "left").withColumn("l", F.coalesce("l", F.lit(0))).withColumn("s", F.coalesce("s", F.lit(0)))
        long = (F.col("slab") > 0) | (F.size("sizes") == width)
        plain = slabs.where(~long).select("*", *zero)
        deep = earlier_totals(with_own.where(long), ["conv_id"], ["slab"], {"x_leaves": F.col("l"), "x_saved": F.col("s")}, F.sum, lambda a, b: a + b, down=True)
        kids = roots.select("conv_id", (F.col("slab") - 1).alias("slab"), F.col("n_children").alias("x_children"))
        deep = deep.drop("l", "s").join(kids, ["conv_id", "slab"], "left").withColumn("x_children", F.coalesce("x_children", F.lit(0)))
        found = slab_nodes(written(plain.unionByName(deep.select(*plain.columns)), "rows"), width, shard)
    found = found.where("depth > 0 or slab = 0")
    return found.select(
        "conv_id", (F.col("slab") * width + F.col("depth")).alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, {crc_sql("conv_id")} % 9 AS h, conv_id - conv_id % 5 AS lead FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.lead AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1 AS part, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
), s AS (
  SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY part, i) AS ids, list(strlen(text) ORDER BY part, i) AS sizes
  FROM r GROUP BY conv_id
), m AS (
  SELECT c.conv_id, s.ids, s.sizes, coalesce(len(s.ids), 0) AS n FROM c LEFT JOIN s ON s.conv_id = c.conv_id
), p AS (
  SELECT conv_id, n, sizes, ids, unnest(range(n + 1)) AS d FROM m
), k AS (
  SELECT conv_id, n, d, CASE WHEN d = 0 THEN '' ELSE array_to_string(ids[1:d], '') END AS prefix, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size FROM p
), nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM k GROUP BY prefix, d
), kids AS (
  SELECT substr(prefix, 1, 64 * (d - 1)) AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), whole AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.prefix = nodes.prefix AND kids.d = nodes.d
), above AS (
  SELECT substr(prefix, 1, 64 * a) AS prefix, a AS d, (n_children = 0)::INT AS leaf, (n_convs - 1) * size AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM whole)
), sums AS (
  SELECT prefix, d, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY ALL
)
SELECT w.conv_id, w.d AS depth, o.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON s.prefix = w.prefix AND s.d = w.d
LEFT JOIN nodes o ON o.d = w.d - 1 AND o.prefix = substr(w.prefix, 1, 64 * (w.d - 1)) AND w.d > 0
"""
