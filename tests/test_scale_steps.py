"""Steps rewritten to grow with their input: the same results, and the form that bounds them."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from plumeline.functions import udfs
from plumeline.operators import joins, select, spread


def test_percentiles_count_only_under_wanted_digits(spark):
    """Rows are not repeated per digit: no row is exploded, and the positions' digits reach the rows by broadcast."""
    rng = np.random.default_rng(3)
    v = rng.normal(1, 0.4, 4000)
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(4000) % 3, "v": v}))
    found = spread.percentiles(df, ["g"], "v", {"p": 0.5, "q": 0.1}, limit=50)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    for r in found.collect():
        own = v[np.arange(4000) % 3 == r["g"]]
        assert np.allclose([r["p"], r["q"]], np.quantile(own, [0.5, 0.1]), rtol=1e-12, atol=0)


def test_best_split_is_the_highest_score():
    rng = random.Random(5)
    for _ in range(2000):
        aims = np.array([[rng.choice([0.0, rng.uniform(1, 50)]) for _ in range(9)] for _ in range(3)])
        held = np.array([[rng.randint(0, 20) for _ in range(9)] for _ in range(3)], float)
        at = [0, 1, 2, *sorted(rng.sample(range(3, 9), 3))]
        load = [float(rng.randint(1, 9)), *[float(rng.randint(0, 2)) for _ in range(2)], *[float(rng.randint(1, 4)) for _ in range(3)]]
        wanted = (aims > 0).all(axis=0).tolist()
        for rule, k in (("need", 6), ("room", 1)):
            score = select.scores(rule, held[:, at[:k]], aims[:, at[:k]], np.array(load[:k]))
            expected = int(np.argmax([score(s, np.zeros(1))[0] for s in range(3)]))
            assert select.best_split(rule, held.tolist(), aims.tolist(), wanted, at[:k], load[:k]) == expected


def test_grouped_map_takes_groups_in_batches(spark):
    """Groups with a null key, groups longer than a batch, and whole numbers beside nulls keep what a group alone has."""
    big = (1 << 53) + 1
    rows = [(None, "a", 1), (None, "a", None), (big, None, 2), *[(7, "b", i) for i in range(25)], (8, "b", None)]
    df = spark.createDataFrame(rows, "k long, s string, v int").repartition(3)

    def show(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "s": pdf["s"].iloc[:1], "n": len(pdf), "kind": str(pdf["v"].dtype), "first": int(pdf.index[0])})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        found = udfs.grouped_map(df, ["k", "s"], show, "k long, s string, n long, kind string, first long")
        assert "MapInPandas" in found._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(tuple(r) for r in found.fillna({"k": -1, "s": "-"}).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(-1, "a", 2, "float64", 0), (7, "b", 25, "int32", 0), (8, "b", 1, "float64", 0), (big, "-", 1, "int32", 0)]


def test_greedy_pairs_start_where_cells_are_thin(spark):
    rng = random.Random(8)
    points = [("s", i, float(rng.randint(0, 60)), float(rng.randint(0, 60))) for i in range(240)]
    df = spark.createDataFrame(points, "scene string, id long, x double, y double")
    a, b = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    left = a.select("scene", F.col("x").alias("ax"), F.col("y").alias("ay"))
    right = b.select("scene", F.col("x").alias("bx"), F.col("y").alias("by"))
    assert len(joins._search_levels(left, right, "scene", 100.0, joins.MAX_CELL_PAIRS)) > 1
    got = {(r["a"], r["b"]) for r in joins.greedy_distance_pairs(a, b, "scene", "id", 100.0).collect()}
    odd, even = [p for p in points if p[1] % 2], [p for p in points if p[1] % 2 == 0]
    ranked = sorted((float(np.hypot(p[2] - o[2], p[3] - o[3])), p[1], o[1]) for p in even for o in odd)
    # Coincident points are paired by their position in id order before all others.
    spots, expected, used = {}, set(), set()
    for side, group in enumerate((even, odd)):
        for p in sorted(group, key=lambda p: p[1]):
            spots.setdefault((p[2], p[3]), ([], []))[side].append(p[1])
    for x, y in spots.values():
        expected |= set(zip(x, y))
    used = {i for pair in expected for i in pair}
    for d, x, y in ranked:
        if d < 100 and x not in used and y not in used:
            expected.add((x, y))
            used |= {x, y}
    assert got == expected


def test_lone_edges_stay_out_of_the_rounds(spark, monkeypatch):
    """Edges that are a component by themselves are settled first; the rest and all labels are as before."""
    rng = random.Random(2)
    edges = [(f"a{i}", f"b{i}") for i in range(200)] + [(f"c{rng.randrange(60)}", f"d{rng.randrange(60)}") for _ in range(40)]
    edges += [edges[0], edges[0][::-1], ("e", "e"), ("e2", None), ("a5", "a5")]
    df = spark.createDataFrame(edges, "src string, dst string")
    plain = sorted(map(tuple, select.connected_components(df).collect()), key=str)
    counts, cut = [], select.cut_lineage
    monkeypatch.setattr(select, "cut_lineage", lambda d: counts.append((found := cut(d)).count()) or found)
    assert sorted(map(tuple, select.connected_components(df, lone=True).collect()), key=str) == plain
    assert counts[0] - counts[1] == counts[2] < 41 and counts[1] >= 200
    assert max(counts[2:]) < 100


def test_nearest_keeps_left_points_single(spark, monkeypatch):
    """Only right items are spread over cells, pairs beyond the cell size are dropped, and the result is that of all pairs."""
    rng = random.Random(4)
    left = [(i, rng.uniform(-3, 3), rng.uniform(-3, 3)) for i in range(60)] + [(60, 40.0, 1.0), (61, None, 1.0), (5, 1.0, 1.0)]
    right = [(i, x := rng.uniform(-3, 3), x + rng.choice([0, 0.5]), y := rng.uniform(-3, 3), y) for i in range(50)]
    dl = spark.createDataFrame(left, "q int, x double, y double")
    dr = spark.createDataFrame(right, "id int, x_lo double, x_hi double, y_lo double, y_hi double")
    gap = F.hypot(F.greatest(F.col("x_lo") - F.col("x"), F.col("x") - F.col("x_hi"), F.lit(0.0)), F.col("y") - F.col("y_lo"))
    plans, cut = [], joins.cut_lineage
    monkeypatch.setattr(joins, "cut_lineage", lambda d: plans.append(d._jdf.queryExecution().optimizedPlan().toString()) or cut(d))
    found = joins.nearest_in_cells(dl, dr, "q", "id", ["x", "y"], gap, 3, 0.5, 60.0)
    got = sorted((r["q"], r["rank"], r["id"], round(r["distance"], 9)) for r in found.collect())
    assert plans[0].count("Generate explode") == 2
    best: dict = {}
    for q, x, y in left:
        for i, lo, hi, at, _ in right if x is not None else []:
            d = np.hypot(max(lo - x, x - hi, 0.0), y - at)
            best.setdefault(q, {})[i] = min(d, best.get(q, {}).get(i, np.inf))
    want = [(q, n + 1, i, round(float(d), 9)) for q, b in best.items() for n, (d, i) in enumerate(sorted((d, i) for i, d in b.items())[:3])]
    assert got == sorted(want)


def line_tables(spark, folder, n):
    """Line items of orders of which one has two rows, with repeated keys and nulls."""
    rng = random.Random(n)
    lines = [(rng.choice([None, *range(20)]), rng.randrange(30), rng.choice([None, 1, 2, 3]), rng.randrange(1, 4), float(rng.randrange(50)), rng.uniform(0, 30000), rng.choice([0.0, 0.1]), rng.choice([0.0, 0.1]), rng.choice("ANR"), "1995-01-01") for _ in range(n)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate string"
    spark.createDataFrame(lines, names).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(k, 1, "1995-01-01") for k in [*range(15), 3]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").write.parquet(f"{folder}/orders.parquet")
    return lines, orders


def test_partitions_grow_with_line_items(spark, monkeypatch, tmp_path):
    """What a task groups has a bounded number of rows, and the sums are those of all rows."""
    from plumeline.plans import queries_aggs, queries_pixels

    monkeypatch.setattr(spread, "TASK_ROWS", 20)
    lines, orders = line_tables(spark, tmp_path, 600)
    found = queries_aggs.null_preserving_sum(spark, str(tmp_path))
    assert "hashpartitioning(l_orderkey" in (plan := found._jdf.queryExecution().executedPlan().toString()) and ", 30), REPARTITION_BY_NUM" in plan
    # The grouping adds no shuffle of its own.
    assert "hashpartitioning(tile" not in plan
    want: dict = {}
    for order, _, source, _, _, price, discount, tax, *_ in lines:
        for _ in [k for k, *_ in orders if k == order]:
            own = want.setdefault((order, source), [])
            own += [] if discount == 0 and tax == 0 else [round(price / 10, 3)]
    got = {(r["tile"], r["source"]): r["flux"] for r in found.collect()}
    assert set(got) == set(want)
    assert all(got[k] is None if not v else abs(got[k] - sum(v)) < 0.01 for k, v in want.items())
    sites = queries_aggs.split_site_report(spark, str(tmp_path))
    assert ", 30), REPARTITION_BY_NUM" in sites._jdf.queryExecution().executedPlan().toString()
    assert ", 30), REPARTITION_BY_NUM" in queries_pixels.pixel_iou(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_code_iou_gathers_each_pixel_once(spark):
    """Repeated pixels, two codes of one pair and pixels of one side only, with and without a number of parts."""
    from plumeline.operators import pixels

    a = [(1, r, 0, c) for r in range(4) for c in (1, 2)] + [(1, 0, 0, 1), (2, 0, 0, 1)]
    b = [(1, r, 0, 1) for r in range(2, 7)]
    side = lambda rows: spark.createDataFrame(rows, "scene int, row int, col int, code int")
    wanted = spark.createDataFrame([(1, 1, "a", 1), (1, 1, "a", 2), (1, 1, "b", 1), (2, 1, "a", 1)], "scene int, pair int, side string, code int")
    for parts in (None, 3):
        found = pixels.code_iou(side(a), side(b), wanted, parts)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2
        assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 2, 7, 4, 5, 2 / 7), (2, 1, 0, 1, 1, 0, 0.0)]


def holes_of(pixels: set) -> tuple[int, int]:
    """Enclosed regions and their pixels, by filling a mask's box."""
    if not pixels:
        return 0, 0
    (r0, c0), (r1, c1) = (tuple(f(p[i] for p in pixels) + d for i in range(2)) for f, d in ((min, -1), (max, 1)))
    left = {(r, c) for r in range(r0, r1 + 1) for c in range(c0, c1 + 1)} - pixels
    sizes = []
    while left:
        todo, region = [left.pop()], []
        while todo:
            r, c = todo.pop()
            region.append((r, c))
            near = {(r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)} & left
            left -= near
            todo += near
        if not any(r in (r0, r1) or c in (c0, c1) for r, c in region):
            sizes.append(len(region))
    return len(sizes), sum(sizes)


def test_holes_of_masks_over_many_tiles(spark, monkeypatch):
    """Small and wide masks, holes across tiles, empty tiles, null keys, keys that join to one text, repeated pixels."""
    from plumeline.operators import pixels

    rng = random.Random(15)
    masks = {
        ("a", "b/c"): {(r, c) for r in range(70) for c in range(150) if rng.random() < 0.55},
        ("a/b", "c"): {(r, c) for r in range(-40, 30) for c in range(90) if rng.random() < 0.4},
        ("ring", "x"): {(r, c) for r in range(200) for c in range(140) if r in (0, 199) or c in (0, 139)} | {(100, c) for c in range(140)},
        ("gap", "x"): {(r, c) for r in range(200) for c in range(140) if (r in (0, 199) or c in (0, 139)) and (r, c) != (150, 0)},
        ("two", "x"): {(-300, 5), (10, 400)},
        ("one", "x"): {(7, 7)},
        **{(str(i), "s"): {(rng.randrange(12), rng.randrange(12)) for _ in range(90)} for i in range(40)},
    }
    rows = [(*k, r, c) for k, m in masks.items() for r, c in m] * 2
    ring = [(r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)]
    rows += [(None, "x", r, c) for r, c in ring] + [("part", "x", r, c) for r, c in ring] + [("part", "x", None, 1), ("part", "x", 90, None), ("none", "x", None, None)]
    df = spark.createDataFrame(rows, "scene string, side string, row int, col int")
    seen = []
    components = select.connected_components
    monkeypatch.setattr(select, "connected_components", lambda links: seen.append(links.count()) or components(links))
    got = {(r["scene"], r["side"]): (r["holes"], r["hole_pixels"]) for r in pixels.mask_holes(df, ["scene", "side"]).collect()}
    # a row without a column still widens the box, by whose rim nothing is enclosed anew
    wanted = {k: holes_of(m) for k, m in masks.items()} | {(None, "x"): (0, 0), ("part", "x"): (1, 1), ("none", "x"): (0, 0)}
    assert got == wanted
    # masks within one tile add nothing to the rounds
    small = df.where("side = 's'")
    assert pixels.mask_holes(small, ["scene", "side"]).count() == 40 and seen[0] > 0 and seen[1] == 0


def test_greedy_chain_takes_few_rounds(spark, monkeypatch):
    """Pairs that wait for each other along a line of 80 are settled in a few rounds, repeated and missing ids included."""
    spots, x = [], 0.0
    for i in range(80):
        spots.append(("s", i, x, 0.0))
        x += 1.5 - i * 0.01
    spots += [("s", 70, spots[70][2], 0.0), ("t", None, 0.0, 0.0), ("t", 1, 1.0, 0.0), ("t", 2, 3.0, 0.0), ("t", 9, 3.5, 0.0), ("t", 12, 3.0, -0.5)]
    df = spark.createDataFrame(spots, "scene string, id long, x double, y double")
    written = []
    for name in ("settled", "cut_lineage"):
        monkeypatch.setattr(joins, name, lambda d, write=getattr(joins, name): written.append(1) or write(d))
    found = joins.greedy_distance_pairs(df.where("id % 2 = 0 or id is null"), df.where("id % 2 = 1"), "scene", "id", 2.0, max_pairs=10**6)
    got = {(r["scene"], r["a"], r["b"]) for r in found.collect()}
    # The missing id takes no partner, and its neighbour waits for it in vain.
    assert got == {("s", i, i + 1) for i in range(0, 80, 2)} | {("t", 2, 9)}
    assert len(written) < 25
