"""The manifest against a plain recursion, its proofs, and what a change of one row does."""

from hashlib import sha256
from random import Random

import pytest
from pyspark.sql import functions as F

from plumeline.llm import merkle

FIELDS = ["doc_id", "lang", "text"]


def told(values):
    return sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode()).hexdigest()


def combined(nodes):
    """The root over some nodes, and each node's siblings level by level."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
    root, above = combined([sha256("".join(r).encode()).hexdigest() for r in runs])
    return root, [runs[i // 8][: i % 8] + runs[i // 8][i % 8 + 1 :] + above[i // 8] for i in range(len(nodes))]


def brute(rows):
    """{(tree, place): (row, leaf, subroot, root, siblings)} of (doc_id, lang, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, told(r), r))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    inner = {t: combined([x[2] for x in sorted(trees[t], key=lambda x: x[:3])]) for t in order}
    root, above = combined([inner[t][0] for t in order])
    out = []
    for k, t in enumerate(order):
        for x, siblings in zip(sorted(trees[t], key=lambda x: x[:3]), inner[t][1]):
            out.append((x[3][0], x[2], inner[t][0], root, "".join(siblings + above[k])))
    return sorted(out, key=str)


def cases():
    rng = Random(3)
    rows = [(i, "a", f"Text {i}") for i in range(700)] + [(i * 2, None, None) for i in range(9)]
    rows += [(i, f"l{rng.randrange(40)}", rng.choice(["", "é", "X" * 9000])) for i in range(200)]
    rows += [(5, "one", "x"), (None, "ß", "x"), (None, "ß", "y"), (7, "ß", None)] + [(11, "again", "same")] * 30 + [(11, "again", "other")] * 2
    rng.shuffle(rows)
    return rows


def table_of(spark, rows):
    data = [(*r, b"n", "t", 1) for r in rows]
    return spark.createDataFrame(data, "doc_id long, lang string, text string, node binary, tree string, place int").repartition(3)


def hexed(found):
    return sorted(((r["doc_id"], *(bytes(r[c]).hex() for c in ("leaf", "subroot", "root", "proof"))) for r in found), key=str)


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_against_recursion(spark, levels):
    rows = cases()
    claims = {"text": F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))}
    found = merkle.manifest(table_of(spark, rows), FIELDS, claims=claims, levels=levels).collect()
    assert hexed(found) == brute(rows)
    changed = [(r[0], r[1], r[2].lower() if r[2] and r[0] is not None and r[0] % 3 == 0 else r[2]) for r in rows]
    bad = sum(a != b for a, b in zip(rows, changed))
    assert bad > 100 and sum(not r["verified"] for r in found) == bad
    for r in found:
        leaf, root = bytes(r["leaf"]).hex(), bytes(r["root"]).hex()
        assert merkle.fold(leaf, merkle.unpacked(bytes(r["proof"]), bytes(r["runs"]))) == root
        assert (bytes(r["folded_root"]).hex() == root) == r["verified"]


def test_one_row_and_none(spark):
    rows = [(3, None, "x")]
    found = merkle.manifest(table_of(spark, rows), FIELDS).collect()
    assert hexed(found) == [(3, told(rows[0]), told(rows[0]), told(rows[0]), "")] and found[0]["verified"]
    assert merkle.manifest(table_of(spark, rows).where("false"), FIELDS).count() == 0


def test_other_columns(spark):
    docs = spark.createDataFrame([("b", 1, 2.5), ("a", 1, None), ("a", 2, 0.0)], "name string, part int, value double")
    found = merkle.manifest(docs, ["name", "part", "value"], tree="part", key="name")
    assert found.columns[0] == "name" and {r["name"] for r in found.collect()} == {"a", "b"}
    assert found.where("not verified").count() == 0
