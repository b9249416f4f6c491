"""The trie against a dictionary of prefixes."""

from collections import defaultdict
from hashlib import sha256
from random import Random
from zlib import crc32

import pytest

from plumeline.llm import queries, trie


def originals(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            told = sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[: 2 * trie.ID]
            found[conv].append((turn is not None, turn or 0, told, role, text))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in found.items()}


def exchanged(convs):
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    rows = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(of), len(node), parent, len(of), children[node], leaves[node], saved[node], sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def cases(seed):
    """Long and short conversations over few texts, many of them copies of one; ties, nulls, an id below zero."""
    rng, rows = Random(seed), []
    hot = [(rng.choice("ua"), f"t{rng.randrange(3)}") for _ in range(19)]
    for c in range(160):
        kind = rng.randrange(4)
        turns = hot if kind == 0 else hot[: rng.randrange(20)] + [(rng.choice("ua"), f"t{rng.randrange(2)}") for _ in range(rng.randrange(4))]
        for i, (role, text) in enumerate(turns):
            rows.append((c * 3 - 7, i, role, text))
    rows += [(1000, None, None, None), (1000, 3, "u", None), (1000, 3, "u", "é" * 50), (1001, 0, "u", ""), (None, 1, "u", "x"), (1003, 0, "", "u"), (1004, 0, "u", "")]
    rows += [(1010 + i, t, "u", "x" * t) for i in range(2) for t in range(70)]
    rng.shuffle(rows)
    return rows


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn int, role string, text string, depth int, id string").repartition(3)


@pytest.mark.parametrize("width,shard", [(16, trie.SHARD), (3, 9), (1, 40)])
def test_against_dictionary(spark, width, shard):
    rows = cases(width)
    found = trie.prefix_trie(trie.numbered(table_of(spark, rows)), width, shard)
    assert sorted(map(tuple, found.collect()), key=str) == brute(originals(rows))


def test_rebuilt(spark):
    rows = cases(4)
    found = trie.prefix_trie(trie.rebuilt(trie.numbered(table_of(spark, rows))), 4, 11)
    assert sorted(map(tuple, found.collect()), key=str) == brute(exchanged(originals(rows)))


def test_turnless_and_empty(spark):
    """Conversations without turns end at the root; without conversations there is no root."""
    rows = [(c, 0, "u", "x") for c in (1, 2, 3, 4, 6, 7, 11)]
    found = trie.prefix_trie(trie.rebuilt(trie.numbered(table_of(spark, rows))))
    assert sorted(map(tuple, found.collect()), key=str) == brute(exchanged(originals(rows)))
    empty = table_of(spark, rows).where("false")
    assert trie.prefix_trie(trie.rebuilt(trie.numbered(empty))).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op12(spark, sf).collect()), key=str) == brute(exchanged(originals(rows)))
