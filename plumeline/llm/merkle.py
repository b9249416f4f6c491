"""A Merkle manifest of a table: a tree per group, a tree over their roots, and every row's proof.

Rows take places inside their group; 4096 neighbours make a superblock, which is a whole subtree. A
first pass turns each superblock into its top node, and the tops go the same way until one node per
group is left. On the way back the nodes outside a superblock that its rows' proofs need come to it as
one row: leaves and outer nodes are cogrouped, and there the superblock's own levels, the rows' proofs
and the fold of a claimed leaf up to the root are worked out together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.llm.common import written
from plumeline.llm.order import placed

#: Children of a node, and levels of a superblock.
FAN, LEVELS = 8, 4
#: One group over the groups' roots; no group's code looks like it.
TOP = "root"


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, ``:`` and itself; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    """SHA-256 of a row's fields one after another, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def digest(nodes: list[str]) -> str:
    """SHA-256 of digests given in hex, joined as text; in hex."""
    return sha256("".join(nodes).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    found = 0
    while n > 1:
        n, found = -(-n // FAN), found + 1
    return found


def levels_of(nodes: list[str], up: int) -> list[list[str]]:
    """The nodes, and the levels above them; every 8 consecutive nodes make one, the last run may have fewer."""
    levels = [nodes]
    for _ in range(up):
        low = levels[-1]
        levels.append([digest(low[i : i + FAN]) for i in range(0, len(low), FAN)])
    return levels


def unpacked(proof: bytes, runs: bytes) -> Iterator[tuple[str, str]]:
    """The siblings before and after a node, level by level, each joined in hex."""
    at, text = 0, proof.hex()
    for own, size in zip(runs[::2], runs[1::2]):
        yield text[at : at + 64 * own], text[at + 64 * own : at + 64 * (size - 1)]
        at += 64 * (size - 1)


def fold(leaf: str, siblings: Iterator[tuple[str, str]]) -> str:
    """The root that a leaf and its proof lead to."""
    for before, after in siblings:
        leaf = sha256((before + leaf + after).encode()).hexdigest()
    return leaf


def in_hex(column: pd.Series) -> list[str]:
    return [bytes(x).hex() for x in column]


def _tops(nodes: DataFrame, size: int, up: int) -> DataFrame:
    """One node per superblock of (tree, place, total, node), in the same columns."""

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        n = int(rows["total"].iloc[0])
        one = levels_of(in_hex(rows["node"]), min(up, height(n)))[-1][0]
        first = int(rows["place"].iloc[0]) // size
        return pd.DataFrame({"tree": rows["tree"].iloc[:1].to_numpy(), "place": [first], "total": [-(-n // size)], "node": [bytes.fromhex(one)]})

    keyed = nodes.select("tree", "place", "total", "node", F.expr(f"place div {size}").alias("block"))
    return written(keyed.groupBy("tree", "block").applyInPandas(top, "tree string, place long, total long, node binary"), "tops")


PATH = "proof binary, runs binary, subroot binary, root binary"


def _paths(nodes: DataFrame, outer: DataFrame | None, size: int, up: int, extra: str = "", finish=None) -> DataFrame:
    """Proofs of (tree, place, total, node): siblings inside the superblock, then those of ``outer``.

    ``outer`` has a row (tree, block, proof, runs, subroot, root) per superblock; without it the
    superblock's top is the root. ``finish`` adds columns from the rows, their siblings and paths.
    """

    def path(rows: pd.DataFrame, above: pd.DataFrame | None) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        levels = levels_of(in_hex(rows["node"]), min(up, height(int(rows["total"].iloc[0]))))
        raw = [[bytes.fromhex(x) for x in level] for level in levels]
        end = (b"", b"", raw[-1][0], raw[-1][0]) if above is None else tuple(bytes(above[c].iloc[0]) for c in ("proof", "runs", "subroot", "root"))
        proofs, runs = [], []
        for i in range(len(rows)):
            parts, own = [], bytearray()
            for level in raw[:-1]:
                a = i - i % FAN
                run = level[a : a + FAN]
                own += bytes((i - a, len(run)))
                parts += run[: i - a] + run[i - a + 1 :]
                i //= FAN
            proofs.append(b"".join(parts) + end[0])
            runs.append(bytes(own) + end[1])
        found = pd.DataFrame({"tree": rows["tree"], "place": rows["place"], "proof": proofs, "runs": runs, "subroot": end[2], "root": end[3]})
        return finish(rows, found) if finish else found

    schema = f"tree string, place long, {PATH}{extra}"
    keyed = nodes.withColumn("block", F.expr(f"place div {size}"))
    if outer is None:
        return keyed.groupBy("tree", "block").applyInPandas(lambda rows: path(rows, None), schema)
    return keyed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(lambda a, b: path(a, b), schema)


def _climb(nodes: DataFrame, size: int, up: int) -> list[DataFrame]:
    """The nodes, their superblocks' tops, those of the tops, until every tree has one node."""
    stages = [nodes]
    most = nodes.agg(F.max("total")).first()[0] or 1
    while True:
        stages.append(_tops(stages[-1], size, up))
        most = -(-most // size)
        if most == 1:
            return stages


def _descend(stages: list[DataFrame], outer: DataFrame | None, size: int, up: int) -> DataFrame | None:
    """Outer rows for the superblocks of ``stages[0]``, from those of the whole trees."""
    for nodes in stages[:0:-1]:
        if outer is None:  # the one node left is the root
            outer = nodes.select("tree", F.col("place").alias("block"), F.lit(b"").alias("proof"), F.lit(b"").alias("runs"), F.col("node").alias("subroot"), F.col("node").alias("root"))
            continue
        if nodes is not stages[-1]:
            paths = _paths(nodes, outer, size, up)
            outer = written(paths.withColumnRenamed("place", "block"), "outer")
    return outer


def manifest(
    docs: DataFrame, fields: Sequence[str], tree: str = "lang", key: str = "doc_id", claims: dict[str, Column] | None = None, levels: int = LEVELS
) -> DataFrame:
    """(key, leaf, subroot, root, proof, runs, folded_root, verified) of every row.

    A leaf is the SHA-256 of the row's ``fields``. Leaves of one ``tree`` value ascend by key (null
    first) and are joined by eights up to a subroot; subroots, null first and then in byte order, are
    joined in the same way up to the root. ``proof`` has the siblings' digests level by level up to the
    root, left to right, 32 bytes each, and ``runs`` two bytes a level: the own place in its run, and
    the run's length. ``claims`` gives other values for some fields; ``folded_root`` is where the leaf
    of the claimed row and the proof lead, and ``verified`` whether that is the root.

    Nulls are values like others. Rows with equal keys are ordered by leaf; repeated rows are leaves of
    their own. A text is only ever one field, whatever its length; digests alone are shuffled. An empty
    table gives no rows. ``key`` is of a type that can be cast to text and back.
    """
    size = FAN**levels
    kind = docs.schema[key].dataType
    code = F.coalesce(F.concat(F.lit("="), docs[tree].cast("string")), F.lit("-"))
    claimed = [(claims or {}).get(f, docs[f]) for f in fields]
    # rand tells repeated rows apart where they are dealt to ranges; the table keeps what it drew.
    leaves = docs.select(
        code.alias("tree"), docs[key].alias("key"), leaf_of([docs[f] for f in fields]).alias("node"), leaf_of(claimed).alias("claim"), F.rand(13).alias("salt")
    )
    rows = placed(written(leaves, "leaves"), ["tree"], ["key", "node", "salt"])
    rows = written(rows.select("tree", "place", "total", "node", "claim", F.col("key").cast("string").alias("key")), "placed")
    stages = _climb(rows.select("tree", "place", "total", "node"), size, levels)
    subroots = placed(stages[-1].select(F.lit(TOP).alias("one"), "tree", "node"), ["one"], ["tree"])
    subroots = written(subroots.select(F.col("one").alias("tree"), "place", "total", "node", F.col("tree").alias("name")), "subroots")
    above = _climb(subroots.select("tree", "place", "total", "node"), size, levels)
    inside = _paths(subroots.drop("name"), _descend(above, None, size, levels), size, levels)
    named = inside.drop("subroot").join(subroots.select("place", "name", "node"), "place")
    outer = named.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "proof", "runs", F.col("node").alias("subroot"), "root")
    outer = _descend(stages, written(outer, "outer"), size, levels)

    def finish(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        folded = [bytes.fromhex(fold(c, unpacked(p, r))) for c, p, r in zip(in_hex(rows["claim"]), found["proof"], found["runs"])]
        return found.assign(leaf=rows["node"], folded_root=folded, key=rows["key"])

    proved = _paths(rows, outer, size, levels, ", leaf binary, folded_root binary, key string", finish)
    return proved.select(
        F.col("key").cast(kind).alias(key), "leaf", "subroot", "root", "proof", "runs", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def crc_sql(number: str) -> str:
    """CRC-32 of a number's decimal digits, bit by bit."""
    bits = f"flatten(list_transform(string_split({number}::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295)"


def _levels_sql(name: str, depth: int) -> list[str]:
    """From nodes ``{name}0`` (t, p, c, h), the levels above them and each level's siblings ``{name}s``."""
    tables = []
    for k in range(depth):
        side = f"coalesce(string_agg(h, '') OVER (PARTITION BY t, p // {FAN} ORDER BY p ROWS BETWEEN {{}}), '')"
        before, after = side.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        tables.append(f"{name}s{k} AS (SELECT t, p, c, {before} AS l, {after} AS r FROM {name}{k})")
        up = "CASE WHEN max(c) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END"
        tables.append(f"{name}{k + 1} AS (SELECT t, p // {FAN} AS p, (max(c) + {FAN - 1}) // {FAN} AS c, {up} AS h FROM {name}{k} GROUP BY t, p // {FAN})")
    return tables


def _sql(depth: int = 7, over: int = 3) -> str:
    """The manifest of documents, for at most 8**depth rows a language and 8**over languages."""

    def leaf(text: str) -> str:
        values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    claim = leaf(f"(CASE WHEN {crc_sql('doc_id')} % 3 = 0 THEN {lower} ELSE text END)")
    tables = [
        f"leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS t, {leaf('text')} AS leaf, {claim} AS claim FROM documents)",
        "d AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY t) AS c FROM leaves)",
        "n0 AS (SELECT t, p, c, leaf AS h FROM d)",
        *_levels_sql("n", depth),
        f"m0 AS (SELECT '{TOP}' AS t, row_number() OVER (ORDER BY t) - 1 AS p, count(*) OVER () AS c, h, t AS name FROM n{depth})",
        *_levels_sql("m", over),
        f"f0 AS (SELECT d.doc_id, d.leaf, d.t AS dt, d.p AS dp, m0.t AS mt, m0.p AS mp, m0.h AS subroot, m{over}.h AS root, d.claim AS v, '' AS proof "
        f"FROM d JOIN m0 ON m0.name = d.t JOIN m{over} ON m{over}.t = m0.t)",
    ]
    turns = [("n", "d", k) for k in range(depth)] + [("m", "m", k) for k in range(over)]
    for i, (name, side, k) in enumerate(turns):
        up = "CASE WHEN s.c > 1 THEN sha256(s.l || f.v || s.r) ELSE f.v END AS v, CASE WHEN s.c > 1 THEN f.proof || s.l || s.r ELSE f.proof END AS proof"
        tables.append(
            f"f{i + 1} AS (SELECT f.doc_id, f.leaf, f.dt, f.dp, f.mt, f.mp, f.subroot, f.root, {up} FROM f{i} f JOIN {name}s{k} s ON s.t = f.{side}t AND s.p = f.{side}p // {FAN**k})"
        )
    return (
        f"WITH {', '.join(tables)} SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, v AS folded_root, v = root AS verified FROM f{len(turns)}"
    )


SQL = _sql()
