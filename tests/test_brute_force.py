"""Operators without check SQL against direct computations on small data."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import rows_of, same_rows
from plumeline import schemas
from plumeline.functions import tails
from plumeline.functions.draws import draw
from plumeline.operators import bank, inject, joins, pixels, select, spectral, stats


def test_min_cost_assignment():
    rng = np.random.default_rng(0)
    for n, m in ((3, 3), (4, 6), (6, 4), (1, 5), (5, 5)):
        cost = rng.random((n, m))
        best = min(
            sum(cost[i, j] for i, j in zip(rows, cols))
            for rows in itertools.combinations(range(n), min(n, m))
            for cols in itertools.permutations(range(m), min(n, m))
        )
        got = joins.min_cost_assignment(cost)
        assert len(got) == min(n, m) and abs(sum(cost[i, j] for i, j in got) - best) < 1e-9


@pytest.mark.parametrize("max_pairs", [10**6, 3])
def test_greedy_pairs(spark, max_pairs):
    rng = random.Random(4)
    pts = [(s, i, rng.choice([0.0, 1.0]) if i < 4 else rng.random() * 6, rng.random() * 6 if i >= 4 else 2.0) for s in range(3) for i in range(20)]
    df = spark.createDataFrame(pts, "scene int, id int, x double, y double")
    a, b = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    got = {(r["scene"], r["a"], r["b"]) for r in joins.greedy_distance_pairs(a, b, "scene", "id", 2.0, max_pairs=max_pairs).collect()}
    want = set()
    for s in range(3):
        left = [p for p in pts if p[0] == s and p[1] % 2 == 0]
        right = [p for p in pts if p[0] == s and p[1] % 2 == 1]
        while left and right:
            d, i, j, p, q = min((math.hypot(p[2] - q[2], p[3] - q[3]), p[1], q[1], p, q) for p in left for q in right)
            if d >= 2.0:
                break
            want.add((s, i, j))
            left.remove(p)
            right.remove(q)
    assert got == want


def test_crowded_places_are_numbered_once(spark):
    df = spark.createDataFrame([(0, 1.0, i) for i in range(500)] + [(1, 2.0, i) for i in range(20)], "s int, x double, i int")
    out = joins._numbered(df, ["s", "x"], "i", limit=50)
    for s, k in ((0, 500), (1, 20)):
        assert sorted(r["n"] for r in out.where(F.col("s") == s).collect()) == list(range(1, k + 1))


def test_balanced_select_equals_row_walk(spark):
    rng = random.Random(8)
    rows = [
        (i, rng.choice(["has_weak", "strong_only", "strong_only"]), rng.choice([2022, 2023]), rng.choice("AB"), rng.choice("XY"), rng.randint(1, 4))
        for i in range(80)
    ]
    df = spark.createDataFrame(rows, "scene int, flux_bin string, year int, region string, sector string, n_plumes int")
    targets = {
        "flux_bin": {"has_weak": 20.0, "strong_only": 30.0},
        "year": {"2022": 20.0, "2023": 30.0},
        "region": {"A": 10.0, "B": 40.0},
        "sector": {"X": 25.0, "Y": 25.0},
    }
    n = 50
    cell = lambda r: (r[1], str(r[2]), r[3], r[4])
    chosen = [r for r in rows if r[1] == "has_weak"]
    pool = [r for r in rows if r[1] != "has_weak"]
    counts = {ax: dict.fromkeys(t, 0) for ax, t in targets.items()}
    for r in chosen:
        for ax, v in zip(targets, cell(r)):
            counts[ax][v] += 1
    while len(chosen) < n and pool:
        gain = lambda r: sum(max((targets[ax][v] - counts[ax][v]) / targets[ax][v], 0) for ax, v in zip(targets, cell(r)))
        top = max(gain(r) for r in pool)
        pick = min((r for r in pool if gain(r) == top), key=lambda r: (r[5], cell(r), r[0]))
        chosen.append(pick)
        pool.remove(pick)
        for ax, v in zip(targets, cell(pick)):
            counts[ax][v] += 1
    got = {r["scene"] for r in select.balanced_select(df, n, "scene", targets).collect()}
    assert got == {r[0] for r in chosen}


def test_site_fold(spark):
    sizes = [(f"s{i}", 60 - i) for i in range(30)]
    got = {r["site"]: r["split"] for r in select.assign_sites(spark.createDataFrame(sizes, "site string, n int"), "site", "n", 1).collect()}
    have, total = dict.fromkeys(select.SITE_SHARES, 0), sum(n for _, n in sizes)
    for site, n in sizes:
        best = max(have, key=lambda s: select.SITE_SHARES[s] * total - have[s])
        have[best] += n
        assert got[site] == best


def _filter(x, t, alpha, method, iterations=0):
    """The published recursion written out with a full covariance in every round."""
    mu = x.mean(axis=0)

    def solve(mu, centred):
        c = centred.T @ centred / len(x)
        c = c + alpha * (np.diag(np.diag(c)) - c)
        target = t * mu
        white = np.linalg.solve(c, target)
        return target, white, max(target @ white, 1e-9)

    target, white, norm = solve(mu, x - mu)
    r = np.ones(len(x)) if method == "mf" else x @ mu / (mu @ mu)
    mf = np.maximum((x - mu) @ white / (r * norm), 0)
    for _ in range(iterations):
        changed = x - (r * mf)[:, None] * target
        mu = changed.mean(axis=0)
        target, white, norm = solve(mu, changed - mu)
        mf = np.maximum(((x - mu) @ white - 1 / (r * (mf + 1e-9))) / (r * norm), 0)
    return mf * 1e5, r


@pytest.mark.parametrize("method,iterations", [("mf", 0), ("rmf", 0), ("mag1c", 6), ("mag1c_fast", 6)])
def test_filters(method, iterations):
    rng = np.random.default_rng(1)
    x = 3 + rng.standard_normal((80, 6)) * 0.2
    t = -np.linspace(0.1, 0.6, 6)
    config = spectral.CONFIGS[method](**({"iterations": iterations} if iterations else {}))
    score, albedo, runs, _ = spectral.filter_column(x, t, config)
    want, r = _filter(x, t, config.alpha, method, iterations)
    assert np.allclose(score, want, rtol=1e-6, atol=1e-3) and np.allclose(albedo, r) and runs == iterations


def test_fast_filter_stops_early():
    rng = np.random.default_rng(1)
    x = 3 + rng.standard_normal((60, 4)) * 0.2
    _, _, runs, done = spectral.filter_column(x, -np.linspace(0.1, 0.4, 4), spectral.FastSparseConfig(tolerance=1e-3, iterations=200))
    assert done and runs < 200


def test_wide_window_bands():
    bands = spectral.window_bands(spectral.WIDE_WINDOW_NM, spectral.WIDE_EXCLUDED_NM)
    centres = [spectral.band_centre(b) for b in bands]
    assert all(1000 <= c <= 2500 and not 1340 <= c < 1450 and not 1800 <= c < 1960 for c in centres)
    assert len(spectral.window_bands(spectral.RETRIEVAL_WINDOW_NM)) == 49


def test_mbmp_plus(spark):
    rng = np.random.default_rng(6)
    t, r = 1 + 0.2 * rng.random((90, 5)), 1 + 0.2 * rng.random((90, 5))
    rows = [(0, i, 0, [float(v) for v in t[i]], [float(v) for v in r[i]]) for i in range(90)]
    df = spark.createDataFrame(rows, "scene int, row int, col int, t array<double>, r array<double>")
    out = spectral.mbmp_plus(df, "scene", "t", "r", (3, 4), 5).orderBy("row").collect()
    y = t[:, 3] / t[:, 4] - r[:, 3] / r[:, 4]
    x = (t / r)[:, :3]
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose([o["mbmp_plus"] for o in out], y - (z @ w + y.mean()), atol=1e-9)


def test_ridge(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((120, 4))
    y = (x[:, 0] + 0.3 * rng.standard_normal(120) > 0).astype(int)
    rows = [([float(v) for v in a], int(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "x array<double>, y int").repartition(5)
    w = stats.ridge_fit(df, "x", "y", [2.0])[2.0]
    t = np.where(y == 1, 1.0, -1.0)
    xc = x - x.mean(0)
    want = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(4), xc.T @ (t - t.mean()))
    assert np.allclose(w[:-1], want) and abs(w[-1] - (t.mean() - x.mean(0) @ want)) < 1e-9


def test_tails():
    # Values of the t, normal and binomial tables.
    assert abs(tails.beta_tail(5.0, 0.5, 10 / (10 + 2.228139**2)) - 0.05) < 1e-5
    assert abs(tails._sign_one(2, 12) - 2 * sum(math.comb(12, k) for k in range(3)) / 2**12) < 1e-12
    assert tails._sign_one(6, 12) == 1.0


def test_sources_keep_distance(spark):
    p = spark.createDataFrame([(i, 70, 60, 5) for i in range(30)], "patch int, height int, width int, n int")
    rows = inject.place_sources(p, seed=1, attempts=100).collect()
    by = {}
    for r in rows:
        assert 10 <= r["row"] < 60 and 10 <= r["col"] < 50
        by.setdefault(r["patch"], []).append((r["row"], r["col"]))
    assert len(by) == 30 and max(map(len, by.values())) <= 5
    for ps in by.values():
        assert all(math.hypot(a[0] - b[0], a[1] - b[1]) >= 15 for a, b in itertools.combinations(ps, 2))


def test_resolved_plumes_differ(spark):
    s = spark.createDataFrame([(p, k, k, k) for p in range(3) for k in range(4)], "patch int, source int, row int, col int")
    wind = s.select("patch", "row", "col", F.lit(2.0).alias("u"), F.lit(1.0).alias("v"))
    sun = spark.createDataFrame([(p, 30.0, 120.0) for p in range(3)], "patch int, sza double, saa double")
    nodes = spark.createDataFrame([(i, 2.0, 30.0, float(i % 6 * 60)) for i in range(40)], "id int, wind double, sza double, raa double")
    out = inject.resolve_wind(s, wind, sun, nodes).collect()
    assert len(out) == 12
    for p in range(3):
        assert len({r["bank_id"] for r in out if r["patch"] == p}) == 4


def test_footprint_of_a_flat_map_is_flat(spark):
    grid = spark.createDataFrame(
        [(0, r, c, 10 + c * 0.0004, 40 - r * 0.0003) for r in range(9) for c in range(8)], "scene int, row int, col int, lon double, lat double"
    )
    shape = spark.createDataFrame([(0, 9, 8)], "scene int, height int, width int")
    plume = spark.createDataFrame([(0, 0, 4, 3, 30.0, 1, 60.0, 60.0)], "scene int, plume int, row int, col int, direction double, map int, source_row double, source_col double")
    flat = spark.createDataFrame([(1, r, c, 7.0) for r in range(121) for c in range(121)], "map int, row int, col int, ppb double")
    out = inject.footprint_average(grid, shape, plume, flat).collect()
    assert len(out) == 72 and all(abs(r["ppb"] - 7.0) < 1e-9 for r in out)
    # A map that rises with its column: along the wind the mean grows by the pixel's metres.
    ramp = flat.withColumn("ppb", F.col("col").cast("double"))
    east = plume.withColumn("direction", F.lit(0.0))
    got = {(r["row"], r["col"]): r["ppb"] for r in inject.footprint_average(grid, shape, east, ramp).collect()}
    metres = math.radians(0.0004) * 6378137.0 * math.cos(math.radians(40 - 4 * 0.0003)) / math.sqrt(1 - 0.00669437999014 * math.sin(math.radians(40 - 4 * 0.0003)) ** 2)
    assert abs(got[(4, 3)] - 60.0) < 1e-6 and abs(got[(4, 4)] - 60.0 - metres / 20.0) < 1e-3


def test_injected_radiance(spark):
    waves = np.arange(2300.0, 2330.0, 1.0)
    mrs = [0.0, 1900.0, 3000.0, 6000.0]
    t = lambda w, m: math.exp(-m * 1e-5 * (1 + math.sin(w)))
    lut = spark.createDataFrame([(0, float(w), m, t(w, m)) for w in waves for m in mrs], "scene int, wavelength double, mr double, t double")
    lw = spark.createDataFrame([(float(w), 1.0) for w in waves], "wavelength double, step double")
    bands = spark.createDataFrame([(0, 2312.0, 4.0)], "band int, centre double, fwhm double")
    back = spark.createDataFrame([(0, 1900.0)], "scene int, mr0 double")
    factors = inject.band_factors(lut, inject.srf_weights(bands, lw), back)
    rad = spark.createDataFrame([(0, 0, 0, 0, 5.0), (0, 0, 1, 0, 5.0), (0, 0, 2, 0, -9999.0)], "scene int, row int, col int, band int, value double")
    enh = spark.createDataFrame([(0, 0, 0, 700.0), (0, 0, 2, 700.0)], "scene int, row int, col int, ppb double")
    got = {r["col"]: r["value"] for r in inject.inject_radiance(rad, enh, factors, back).collect()}
    sg = 4.0 / (2 * math.sqrt(2 * math.log(2)))
    use = [w for w in waves if 2312 - 5 * sg <= w < 2312 + 5 * sg and w < waves[-1]]
    g = np.array([math.exp(-0.5 * ((w - 2312) / sg) ** 2) for w in use])
    lerp = np.array([t(w, 1900.0) + (2600 - 1900) / 1100 * (t(w, 3000.0) - t(w, 1900.0)) for w in use])
    factor = (g / g.sum()) @ (lerp / np.array([t(w, 1900.0) for w in use]))
    assert abs(got[0] - 5.0 * factor) < 1e-9 and got[1] == 5.0 and got[2] == -9999.0


def test_retrieval_after_injection_sees_the_change(spark):
    rng = np.random.default_rng(0)
    t = [-0.3, -0.1, -0.5, -0.2]
    rows = [(0, r, c, [float(v) for v in 4 + 0.05 * rng.standard_normal(4)]) for r in range(40) for c in range(3)]
    cube = spark.createDataFrame(rows, "scene int, row int, col int, spectrum array<double>")
    changed = cube.where("row = 5 and col = 1").withColumn("spectrum", F.transform(F.arrays_zip("spectrum", F.array(*[F.lit(v) for v in t]).alias("k")), lambda p: p["spectrum"] * (1 + 0.3 * p["k"])))
    patch = spark.createDataFrame([(0, 4, 1, 3, 1)], "scene int, row_off int, col_off int, height int, width int")
    out = {r["row"]: r["enhancement"] for r in inject.retrieve_after_injection(cube, changed, patch, t, ["mf"]).collect()}
    assert set(out) == {4, 5, 6} and out[5] > 10 * max(out[4], out[6], 1.0)


def test_instance_codes(spark):
    names = lambda xs: spark.createDataFrame([(0, x) for x in xs], "scene int, plume int")
    pair = "scene int, plume_a int, plume_b int"
    matched = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], pair)
    inner = spark.createDataFrame([(0, 2, 3, 0.2, 0.3)], pair + ", in_a double, in_b double")
    none = spark.createDataFrame([], pair + ", in_a double, in_b double")
    got = [(r["kind"], r["plume_a"], r["plume_b"], r["code"]) for r in pixels.instance_codes(names([1, 2, 3]), names([1, 2]), matched, inner, none).orderBy("code").collect()]
    assert got == [(0, 1, 1, 1), (1, 2, 2, 2), (2, 3, None, 3), (4, 2, 3, 4)]


def test_placements_stay_inside(spark):
    box = spark.createDataFrame([(i, 2, 4, 3, 6, 20, 18) for i in range(20)], "scene int, row0 int, row1 int, col0 int, col1 int, height int, width int")
    for r in pixels.random_placements(box, "height", "width", 30, 1, central=0.5).collect():
        assert 0 <= 2 + r["dy"] and 4 + r["dy"] <= 19 and 0 <= 3 + r["dx"] and 6 + r["dx"] <= 17
        assert abs(3 + r["dy"] - 9.5) <= 0.5 * 19 / 2 and abs(4.5 + r["dx"] - 8.5) <= 0.5 * 17 / 2


def _blob(spark, level=10, at=(40, 40), width=3.0):
    rows = [
        ("v", level, r, c, math.exp(-((r - at[0]) ** 2 + (c - at[1]) ** 2) / (2 * width**2)))
        for r in range(at[0] - 12, at[0] + 13)
        for c in range(at[1] - 12, at[1] + 13)
    ]
    return spark.createDataFrame(rows, "volume string, level int, row int, col int, ppb double")


@pytest.mark.parametrize("raa,want", [(0.0, (40.0, 30.0)), (90.0, (30.0, 40.0)), (180.0, (40.0, 50.0)), (270.0, (50.0, 40.0))])
def test_projection_moves_a_blob(spark, raa, want):
    """At 45 degrees a level ten pixels up moves ten pixels against the azimuth; both paths are mixed."""
    nodes = spark.createDataFrame([(0, 45.0, raa)], "node int, sza double, raa double")
    m = bank.project_volume(_blob(spark), nodes, 49)
    v = F.col("ppb")
    mass, r, c = m.agg(F.sum(v), F.sum(v * F.col("row")), F.sum(v * F.col("col"))).first()
    assert abs(mass - _blob(spark).agg(F.sum("ppb")).first()[0]) < 1e-9
    a = math.sqrt(2.0)
    mix = lambda moved: (a * moved + 40.0) / (a + 1)
    assert abs(r / mass - mix(want[0])) < 1e-6 and abs(c / mass - mix(want[1])) < 1e-6


def test_view_angle_shifts_the_centre(spark):
    nodes = spark.createDataFrame([(0, 0.0, 0.0)], "node int, sza double, raa double")
    for vza in (5.0, 20.0):
        m = bank.project_volume(_blob(spark), nodes, 49, vza=vza, vaa=180.0)
        v = F.col("ppb")
        mass, c = m.agg(F.sum(v), F.sum(v * F.col("col"))).first()
        tan, cos = math.tan(math.radians(vza)), math.cos(math.radians(vza))
        assert abs(c / mass - 40.0 - 10 * tan / (1 + cos)) < 1e-6


def test_mass_is_kept_at_every_node(spark):
    maps = bank.project_volume(_blob(spark), bank.sun_nodes(spark), 49)
    want = _blob(spark).agg(F.sum("ppb")).first()[0]
    worst = maps.groupBy("node").agg((F.abs(F.sum("ppb") - want) / want).alias("e")).agg(F.max("e"), F.count(F.lit(1))).first()
    assert worst[0] < 1e-9 and worst[1] == 855
    _, stats_ = bank.threshold_and_crop(maps.where("node < 40"), ["volume", "node"])
    assert stats_.agg(F.max((F.col("mass_before") - F.col("mass_after")) / F.col("mass_before"))).first()[0] <= 1e-3


def test_sun_nodes_golden(spark):
    n = bank.sun_nodes(spark)
    top = n.agg(F.count(F.lit(1)), F.count_distinct("ring"), F.max("sza")).first()
    assert top[0] == 855 and top[1] == 17 and round(top[2], 1) == 71.0


def test_partition_invariance(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 5), rng.randint(0, 9), rng.randint(0, 9), rng.randint(0, 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "scene int, row int, col int, plume int").distinct()
    a = joins.self_overlap_pairs(df)
    b = joins.self_overlap_pairs(df.repartition(7).orderBy(F.rand(3)))
    same_rows(rows_of(a)[1], rows_of(b)[1])


def test_splits_follow_the_greatest_need(spark):
    rows = [(c, i, "ab"[(c + i) % 2], c % 3, (c + i) % 2) for c in range(12) for i in range(1 + c % 4)]
    scenes = spark.createDataFrame([(c, *x) for c, *x in rows], "component int, i int, kind string, n_weak int, n_strong int")
    shares = {"train": 0.6, "val": 0.2, "test": 0.2}
    got = {r["component"]: r["split"] for r in select.assign_split_by_component(scenes, "component", ("kind",), shares).collect()}
    facts = lambda some: {"size": len(some), "weak": sum(r[3] for r in some), "strong": sum(r[4] for r in some), **{k: sum(r[2] == k for r in some) for k in "ab"}}
    total, placed = facts(rows), {s: [] for s in shares}
    owned = {c: [r for r in rows if r[0] == c] for c in range(12)}
    turn = {r["component"]: r["t"] for r in scenes.select("component", draw(F.col("component")).alias("t")).distinct().collect()}
    order = lambda f: (-f["size"], f["weak"], f["strong"], [(k, f[k]) for k in "ab" if f[k]])
    for c in sorted(range(12), key=lambda c: (order(facts(owned[c])), turn[c])):
        own = owned[c]
        f = facts(own)
        value = {}
        for s, share in shares.items():
            have = facts(placed[s])
            lack = {k: 1 - have[k] / (share * total[k]) for k in total}
            value[s] = lack["size"] + sum(max(lack[k], 0) * f[k] / f["size"] for k in "ab") + sum(2 * max(lack[k], 0) for k in ("weak", "strong") if f[k])
        top = max(value.values())
        assert value[got[c]] > top - 1e-9
        placed[got[c]] += own


def test_order_of_the_scene_table():
    names = schemas.level0_schema().names
    assert len(names) == 64 and names[:3] == ["id", "type", "detection:n_a"]
    assert names[33:42] == [
        "target:sza", "target:vza", "target:saa", "target:vaa", "target:raa",
        "sensor:amf", "sensor:phase", "sensor:path_length", "sensor:earth_sun_distance",
    ]
    assert names[-3:] == ["selection:split", "selection:is_free", "selection:flux_bin"]
    assert set(schemas.level0_digits()) <= set(names)
