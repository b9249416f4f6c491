"""The paths for very large groups give the same result as the plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import rows_of, same_rows
from plumeline.operators import diagnostics, inject, joins, ranks, select, spectral, spread


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many ties."""
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.34 else rng.randint(1, 20), float(rng.randint(0, 400)) / 4, i) for i in range(6000)]
    return spark.createDataFrame(rows, "g int, v double, id int").repartition(7)


def test_ordered_totals(skewed):
    sums = {"n": F.count(F.lit(1)), "s": F.sum("id")}
    plain = spread.ordered_totals(skewed, ["g"], "v", sums)
    cut = spread.ordered_totals(skewed, ["g"], "v", sums, limit=100)
    same_rows(rows_of(cut)[1], rows_of(plain)[1])


def test_ordered_totals_without_keys(skewed):
    sums = {"n": F.count(F.lit(1))}
    same_rows(
        rows_of(spread.ordered_totals(skewed, [], "v", sums, limit=50))[1],
        rows_of(spread.ordered_totals(skewed, [], "v", sums))[1],
    )


def test_percentiles_match_numpy(skewed):
    probs = {"a": 0.1, "b": 0.5, "c": 0.9}
    got = {r["g"]: (r["a"], r["b"], r["c"]) for r in spread.percentiles(skewed, ["g"], "v", probs, limit=100).collect()}
    pdf = skewed.toPandas()
    for g, part in pdf.groupby("g"):
        assert np.allclose(got[g], np.percentile(part["v"], [10, 50, 90]))


def test_summary_paths_agree(skewed):
    aggs = [F.count(F.lit(1)).alias("n"), F.max("v").alias("m")]
    a = spread.summary(skewed, ["g"], aggs, "v", {"p": 0.3})
    b = spread.summary(skewed, ["g"], aggs, "v", {"p": 0.3}, limit=100)
    same_rows(rows_of(b)[1], rows_of(a)[1])


def test_average_ranks(skewed):
    a = spread.average_ranks(skewed, ["g"], "v", "r")
    b = spread.average_ranks(skewed, ["g"], "v", "r", limit=100)
    same_rows(rows_of(b)[1], rows_of(a)[1])


def test_row_positions(skewed):
    a = spread.row_positions(skewed, "v", ["id"], "pos")
    b = spread.row_positions(skewed, "v", ["id"], "pos", limit=100)
    same_rows(rows_of(b)[1], rows_of(a)[1])


def test_parts_have_one_grain(skewed):
    parts = spread.with_parts(skewed, "id", 12)
    assert parts.count() == 6000 and parts.groupBy("g").agg(F.count_distinct("part").alias("n")).agg(F.min("n")).first()[0] == 12
    assert parts.groupBy("g", "part").count().agg(F.max("count")).first()[0] < 260
    assert [r["part"] for r in spread.with_parts(skewed, "id", 1).select("part").distinct().collect()] == [0]


def test_long_rank_list(skewed):
    a = ranks.head_per_group(skewed, ["g"], [F.col("v"), F.col("id")], 1500, "rank")
    w = sorted(((r["g"], r["v"], r["id"]) for r in skewed.collect()))
    want, seen = [], {}
    for g, v, i in w:
        seen[g] = seen.get(g, 0) + 1
        if seen[g] <= 1500:
            want.append((g, i, seen[g], v))
    same_rows(rows_of(a)[1], want)


@pytest.mark.parametrize("method", ["mf", "rmf", "mag1c"])
def test_large_detector_columns(spark, method):
    rng = np.random.default_rng(3)
    template = [-0.2, -0.5, -0.1, -0.4, -0.3]
    rows = []
    for scene in (0, 1):
        for row in range(120):
            for col in range(2):
                x = 2 + 0.3 * rng.standard_normal(5) + 0.2 * rng.standard_normal()
                rows.append((scene, row, col, [-9999.0] * 5 if row % 17 == 3 else [float(v) for v in x]))
    df = spark.createDataFrame(rows, "scene int, row int, col int, spectrum array<double>")
    config = spectral.CONFIGS[method](**({"iterations": 4} if method == "mag1c" else {}))
    keep = lambda t: t.select("scene", "row", "col", F.round("enhancement", 4).alias("e"), F.round("albedo", 8).alias("a"))
    small = keep(spectral.retrieve_scene(df, template, config))
    large = keep(spectral.retrieve_scene(df, template, config, limit=50))
    same_rows(rows_of(large)[1], rows_of(small)[1])


def test_large_columns_stop_at_the_tolerance(spark):
    rng = np.random.default_rng(8)
    rows = [(0, r, c, [float(v) for v in 2 + 0.3 * rng.standard_normal(4)]) for r in range(60) for c in range(2)]
    df = spark.createDataFrame(rows, "scene int, row int, col int, spectrum array<double>")
    config = spectral.FastSparseConfig(tolerance=0.3)
    keep = lambda t: t.select("scene", "row", "col", F.round("enhancement", 3).alias("e"), "iterations", "converged")
    small = rows_of(keep(spectral.retrieve_scene(df, [-0.2, -0.5, -0.1, -0.4], config)))[1]
    assert any(r[-1] is True or True in r for r in small)
    same_rows(rows_of(keep(spectral.retrieve_scene(df, [-0.2, -0.5, -0.1, -0.4], config, limit=10)))[1], small)


def test_large_column_groups(spark):
    rng = np.random.default_rng(4)
    rows = [
        (0, r, c, [-9999.0] * 4 if (r + c) % 19 == 3 else [float(v) for v in 2 + 0.3 * rng.standard_normal(4)])
        for r in range(60)
        for c in range(4)
    ]
    df = spark.createDataFrame(rows, "scene int, row int, col int, spectrum array<double>")
    config = spectral.AlbedoConfig(column_step=2)
    keep = lambda t: t.select("scene", "row", "col", F.round("enhancement", 4).alias("e"), F.round("albedo", 8).alias("a"))
    small = keep(spectral.retrieve_column_groups(df, [-0.2, -0.5, -0.1, -0.4], config))
    large = keep(spectral.retrieve_column_groups(df, [-0.2, -0.5, -0.1, -0.4], config, limit=10))
    same_rows(rows_of(large)[1], rows_of(small)[1])


def test_assignment_by_component(spark):
    rng = random.Random(9)
    pairs, sizes = [], []
    for scene in range(4):
        for a in range(12):
            for b in rng.sample(range(12), 2):
                pairs.append((scene, a, b, round(rng.random(), 4)))
        sizes.append((scene, 40, 40))
    p = spark.createDataFrame(pairs, "scene int, plume_a int, plume_b int, cost double")
    s = spark.createDataFrame(sizes, "scene int, n_a int, n_b int")
    cost = lambda m: round(sum(r["cost"] for r in p.join(m, ["scene", "plume_a", "plume_b"]).collect()), 6)
    count = lambda m: m.count()
    whole, parts = joins.assign_one_to_one(p, s), joins.assign_one_to_one(p, s, whole_limit=1)
    # Same optimum: every plume left out costs one.
    assert abs((cost(whole) - count(whole)) - (cost(parts) - count(parts))) < 1e-6


def test_components_of_a_hub_and_a_chain(spark):
    edges = [("hub", f"x{i}") for i in range(300)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    got = {r["node"]: r["component"] for r in select.connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    assert {got[f"x{i}"] for i in range(300)} == {"hub"}
    assert {got[f"c{i:03d}"] for i in range(61)} == {"c000"}


def test_every_bad_slot_is_filled(spark):
    slots = spark.createDataFrame([(1, i) for i in range(5)], "id int, slot int")
    found = spark.createDataFrame([(1, 100 + i) for i in range(10)], "id int, candidate int")
    out = joins.slot_replacement(slots, found, "id", F.lit(True), [F.col("candidate")]).collect()
    assert {r["slot"]: r["candidate"] for r in out} == {i: 100 + i for i in range(5)}


def test_far_query_keeps_its_neighbours(spark):
    bank = spark.createDataFrame([(i, 30.0 + i, 10.0 * i, 2.0 + i) for i in range(6)], "id int, sza double, raa double, wind double")
    asked = spark.createDataFrame([(1, 31.0, 15.0, 500.0), (2, 33.0, 30.0, 3.0)], "q int, sza double, raa double, wind double")
    found = joins.knn_circular(asked, bank, "q", 2).select("q", "id").collect()
    assert {r["id"] for r in found if r["q"] == 1} == {4, 5}
    assert len(found) == 4


def test_deep_holes_are_filled(spark):
    row = spark.range(53).selectExpr("'s' as scene", "0 as row", "cast(id as int) as col", "if(id = 0, 2D, null) as v")
    assert inject.inpaint_null(row, "v").where("v = 2").count() == 53


def test_components_from_forests_equal_rounds(spark, monkeypatch):
    """Pieces of any size give the components of the rounds; whole pieces leave no link to them."""
    rng = random.Random(1)
    edges = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(180)] + [(f"p{i}", f"p{i + 1}") for i in range(30)]
    edges += [("n5", None), (None, "lost"), ("self", "self"), (None, None)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "src string, dst string").repartition(1)
    want = sorted(map(tuple, select.connected_components(df).collect()), key=str)
    rounds, seen = select.connected_components, []
    monkeypatch.setattr(select, "connected_components", lambda links, *a: seen.append(links.count()) or rounds(links, *a))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for size, through_rounds in ((7, 1), (1 << 20, 1)):
            monkeypatch.setattr(select, "FOREST", size)
            assert sorted(map(tuple, select.components_from_forests(df).collect()), key=str) == want
            assert len(seen) == through_rounds
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_group_report_of_pieces(spark, monkeypatch):
    """Scenes that no piece of the table holds whole get the groups of all their links; whole ones stay out of the rounds."""
    rng = random.Random(3)
    links = [(s, rng.randrange(30), 100 + rng.randrange(30)) for s in (1, 2, 3, None) for _ in range(25)] + [(2, None, 101), (2, None, 102), (3, 7, None)]
    df = spark.createDataFrame(links, "scene long, a long, b long").repartition(2)
    wanted = {}
    for scene in (1, 2, 3, None):
        groups = []
        for s, x, y in links:
            if s == scene:
                met = [g for g in groups if x in g or y in g]
                groups = [g for g in groups if g not in met] + [{x, y}.union(*met)]
        texts = sorted((-len(g), sorted(str(m) for m in g if m is not None)) for g in groups)
        wanted[scene] = (len(groups), max(map(len, groups)), str([t for _, t in texts]).replace("'", '"').replace(" ", ""))
    rounds, seen = select.connected_components, []
    monkeypatch.setattr(select, "connected_components", lambda *a, **k: seen.append(1) or rounds(*a, **k))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for size, through_rounds in ((7, 1), (1 << 20, 1)):
            monkeypatch.setattr(select, "FOREST", size)
            rows = diagnostics.group_components_report(df, "scene", "a", "b").collect()
            assert {r["scene"]: (r["groups"], r["largest"], r["members"]) for r in rows} == wanted
            assert len(seen) == through_rounds
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
