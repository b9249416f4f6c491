"""Spectral filters and similarity measures over the driver tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from plumeline.operators import spectral as S
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.queries_pixels import REFS, refs
from plumeline.plans.registry import query

BANDS = 64
# An absorption signature and wavelengths for the 64 positions of a vector.
TEMPLATE = [-(0.2 + 0.1 * math.sin(b / 3.0)) for b in range(BANDS)]
WAVELENGTHS = [1000.0 + 25.0 * b for b in range(BANDS)]


def cube(spark, d):
    """Spectra shifted by one; a few pixels carry fill."""
    s = fx.spectra(spark, d)
    bad = (F.col("row") * 10 + F.col("col")) % 23 == 7
    values = F.transform("spectrum", lambda v: F.when(bad, F.lit(-9999.0)).otherwise(v.cast("double") + 1))
    return s.select("scene", "row", "col", "mask", "label", values.alias("spectrum"))


def _rounded_scores(df):
    nan = lambda c: F.when(~F.isnan(c), F.round(c, 3))
    return df.select("scene", "row", "col", nan("enhancement").alias("enhancement"), nan("albedo").alias("albedo"), "iterations")


@query(
    "mbmp",
    f"WITH {REFS} SELECT scene, row, col, round(((t[12] + 1e-9) / (r[12] + 1e-9)) / ((t[11] + 1e-9) / (r[11] + 1e-9)) - 1, 8) AS mbmp FROM refs",
)
def mbmp(spark, d):
    t = lambda c, k: F.get(F.col(c), F.lit(k))
    v = S.mbmp(t("t", 10), t("t", 11), t("r", 10), t("r", 11))
    return rounded(refs(spark, d).select("scene", "row", "col", v.alias("mbmp")), 8)


FOUR = f"""{fx.SPECTRA}, four AS (SELECT a.scene, a.row, a.col, a.spectrum AS s, b.scene AS ref, b.spectrum AS q FROM spectra a JOIN spectra b ON a.row = b.row AND a.col = b.col AND a.scene <> b.scene)"""


def four(spark, d):
    s = fx.spectra(spark, d)
    b = s.select(F.col("scene").alias("ref"), "row", "col", F.col("spectrum").alias("q"))
    return s.select("scene", "row", "col", F.col("spectrum").alias("s")).join(b, ["row", "col"]).where("scene <> ref")


@query(
    "mbmp_multi_reference",
    f"""WITH {FOUR}, m AS (SELECT scene, row, col, ((s[12] :: DOUBLE + 1) / (q[12] :: DOUBLE + 1)) / ((s[11] :: DOUBLE + 1) / (q[11] :: DOUBLE + 1)) - 1 AS v FROM four)
    SELECT scene, row, col, round(quantile_cont(v, 0.5), 7) AS mbmp, count(*) AS references FROM m GROUP BY ALL""",
)
def mbmp_multi_reference(spark, d):
    t = lambda c, k: F.get(F.col(c), F.lit(k)).cast("double") + 1
    v = S.mbmp(t("s", 10), t("s", 11), t("q", 10), t("q", 11), eps=0.0)
    m = four(spark, d).select("scene", "row", "col", v.alias("v"))
    return rounded(S.mbmp_multi_reference(m, ["scene", "row", "col"], "v"), 7)


@query("mbmp_plus")
def mbmp_plus(spark, d):
    out = S.mbmp_plus(refs(spark, d), "scene", "t", "r", (10, 11), 16)
    return rounded(out.select("scene", "row", "col", "plain", "mbmp_plus"))


@query(
    "mbmp_gauss",
    f"""WITH {fx.SPECTRA}, hw AS (SELECT scene, max(row) + 1 AS h, max(col) + 1 AS w FROM spectra GROUP BY 1), v AS (SELECT scene, row, col, spectrum[1] :: DOUBLE AS v FROM spectra),
      k AS (SELECT i AS k, exp(-0.5 * i * i) / (SELECT sum(exp(-0.5 * j * j)) FROM range(-4, 5) u(j)) AS w FROM range(-4, 5) t(i)),
      a AS (SELECT x.scene, x.row, x.col, sum(k.w * y.v) AS v FROM v x JOIN hw USING (scene) CROSS JOIN k JOIN v y ON y.scene = x.scene AND y.col = x.col AND y.row = CASE WHEN ((x.row + k) % (2 * h) + 2 * h) % (2 * h) < h THEN ((x.row + k) % (2 * h) + 2 * h) % (2 * h) ELSE 2 * h - 1 - ((x.row + k) % (2 * h) + 2 * h) % (2 * h) END GROUP BY ALL),
      b AS (SELECT x.scene, x.row, x.col, sum(k.w * y.v) AS v FROM v x JOIN hw USING (scene) CROSS JOIN k JOIN a y ON y.scene = x.scene AND y.row = x.row AND y.col = CASE WHEN ((x.col + k) % (2 * hw.w) + 2 * hw.w) % (2 * hw.w) < hw.w THEN ((x.col + k) % (2 * hw.w) + 2 * hw.w) % (2 * hw.w) ELSE 2 * hw.w - 1 - ((x.col + k) % (2 * hw.w) + 2 * hw.w) % (2 * hw.w) END GROUP BY ALL)
    SELECT v.scene, v.row, v.col, round(v.v - b.v, 7) AS residual FROM v JOIN b USING (scene, row, col)""",
)
def mbmp_gauss(spark, d):
    v = fx.spectra(spark, d).select("scene", "row", "col", F.get("spectrum", F.lit(0)).cast("double").alias("v"))
    size = v.groupBy("scene").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    return rounded(S.gaussian_residual(v, "scene", "v", size).drop("v"), 7)


LONG_REFS = f"""{REFS}, lr AS (SELECT scene, row, col, CAST(i - 1 AS INT) AS band, t[i] AS t, r[i] AS r FROM refs, range(1, 65) k(i))"""


def long_refs(spark, d):
    z = refs(spark, d).select("scene", "row", "col", F.posexplode(F.arrays_zip("t", "r")).alias("band", "p"))
    return z.select("scene", "row", "col", "band", "p.t", "p.r")


@query(
    "mars_difference",
    f"""WITH {LONG_REFS}, g AS (SELECT scene, band, avg(t) / avg(r) AS g FROM lr GROUP BY ALL HAVING count(*) >= 80), b AS (SELECT scene, band, avg(abs(t - g * r)) AS d FROM lr JOIN g USING (scene, band) GROUP BY ALL)
    SELECT scene, round(avg(d), 8) AS difference, count(*) AS bands FROM b GROUP BY scene""",
)
def mars_difference(spark, d):
    return rounded(S.mars_difference(long_refs(spark, d), ["scene"], "band", "t", "r", min_pixels=80), 8)


@query(
    "methane_fraction",
    f"""WITH {fx.SPECTRA}, r AS (SELECT scene, (spectrum[7] :: DOUBLE + 1) / (spectrum[6] :: DOUBLE + 1) AS r FROM spectra), m AS (SELECT scene, quantile_cont(r, 0.5) AS m FROM r GROUP BY 1)
    SELECT scene, round(avg(CASE WHEN r < 0.92 * m THEN 1 ELSE 0 END), 8) AS methane FROM r JOIN m USING (scene) GROUP BY scene""",
)
def methane_fraction(spark, d):
    at = lambda k: F.get("spectrum", F.lit(k)).cast("double") + 1
    s = fx.spectra(spark, d).select("scene", at(5).alias("a"), at(6).alias("b"))
    return rounded(S.methane_fraction(s, ["scene"], "a", "b"), 8)


@query(
    "qa_clear_score",
    """SELECT l_suppkey AS scene, round(100 * avg(CASE WHEN (l_partkey & 30) = 0 THEN 1 ELSE 0 END), 8) AS clear FROM lineitem GROUP BY 1""",
)
def qa_clear_score(spark, d):
    t = fx.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("scene"), "l_partkey")
    return rounded(S.qa_clear_score(t, ["scene"], "l_partkey"), 8)


@query(
    "coregister_shift",
    f"""WITH {fx.SPECTRA}, p AS (SELECT scene, row, col, spectrum[1] :: DOUBLE AS t, spectrum[2] :: DOUBLE + (SELECT s.spectrum[1] :: DOUBLE FROM spectra s WHERE s.scene = a.scene AND s.row = a.row + 1 AND s.col = a.col - 1) * 0.7 AS b FROM spectra a),
      o AS (SELECT y, x FROM range(-2, 3) a(y), range(-2, 3) b(x)),
      c AS (SELECT p.scene, y AS dy, x AS dx, corr(p.t, q.b) AS c FROM p CROSS JOIN o JOIN p q ON q.scene = p.scene AND q.row = p.row - y AND q.col = p.col - x GROUP BY ALL)
    SELECT scene, CAST(dy AS INT) AS dy, CAST(dx AS INT) AS dx, round(c, 6) AS correlation FROM c QUALIFY row_number() OVER (PARTITION BY scene ORDER BY c DESC) = 1""",
)
def coregister_shift(spark, d):
    at = lambda k: F.get("spectrum", F.lit(k)).cast("double")
    s = fx.spectra(spark, d).select("scene", "row", "col", at(0).alias("t"), at(1).alias("n"))
    moved = s.select("scene", (F.col("row") - 1).alias("row"), (F.col("col") + 1).alias("col"), F.col("t").alias("m"))
    p = s.join(moved, ["scene", "row", "col"], "left").withColumn("b", F.col("n") + F.col("m") * 0.7)
    out = S.coregister_shift(p, "scene", "t", "b", 2)
    return rounded(out.select("scene", "dy", "dx", "correlation"))


@query(
    "target_reference_ratio",
    f"""WITH {LONG_REFS} SELECT scene, row, col, band, round(t / r - 1, 8) AS ratio FROM lr""",
)
def target_reference_ratio(spark, d):
    out = S.target_reference_ratio(refs(spark, d), "t", ["r"])
    long = out.where("ok0").select("scene", "row", "col", F.posexplode("r0").alias("band", "ratio"))
    return rounded(long, 8)


@query(
    "feature_sets",
    f"""WITH {REFS}, n AS (SELECT a.scene, a.row, a.col, a.t, a.r, b.r AS r2 FROM refs a JOIN refs b ON b.scene = (a.scene + 1) % 5 AND b.row = a.row AND b.col = a.col)
    SELECT scene, row, col, len(t) :: INTEGER AS n_target, 2 * len(t) :: INTEGER AS n_r4, 3 * len(t) :: INTEGER AS n_r4t, round((t[5] / r[5] - 1 + t[5] / r2[5] - 1) / 2, 8) AS mean_ratio FROM n""",
)
def feature_sets(spark, d):
    a = refs(spark, d)
    b = a.select(((F.col("scene") + 4) % 5).alias("scene"), "row", "col", F.col("r").alias("q"))
    f = S.feature_sets(S.target_reference_ratio(a.join(b, ["scene", "row", "col"]), "t", ["r", "q"]), "t", ["r0", "r1"])
    return rounded(
        f.select(
            "scene",
            "row",
            "col",
            F.size("f_target").alias("n_target"),
            F.size("f_r4").alias("n_r4"),
            F.size("f_r4t").alias("n_r4t"),
            F.get("f_rmean", F.lit(4)).alias("mean_ratio"),
        ),
        8,
    )


@query(
    "fill_nodata_column_mean",
    f"""WITH {fx.PIXELS}, c AS (SELECT scene, row, col, band, CASE WHEN (row * 10 + col) % 23 = 7 OR col = 9 AND band = 5 THEN NULL ELSE value END AS v FROM pixels), m AS (SELECT scene, col, band, avg(v) AS m FROM c GROUP BY ALL)
    SELECT scene, row, col, band, round(coalesce(v, m), 7) AS v, m IS NULL AS empty FROM c JOIN m USING (scene, col, band)""",
)
def fill_nodata_column_mean(spark, d):
    hole = ((F.col("row") * 10 + F.col("col")) % 23 == 7) | ((F.col("col") == 9) & (F.col("band") == 5))
    c = fx.pixels(spark, d).select("scene", "row", "col", "band", F.when(~hole, F.col("value")).alias("v"))
    return rounded(S.fill_nodata_column_mean(c, ["scene", "col", "band"], "v"), 7)


def _by_name(name, method, **settings):
    @query(name)
    def run(spark, d):
        return _rounded_scores(S.retrieve(cube(spark, d), TEMPLATE, method, WAVELENGTHS, **settings))

    run.__name__ = name
    return run


matched_filter = _by_name("matched_filter", "mf", alpha=0.05)
albedo_matched_filter = _by_name("albedo_matched_filter", "rmf", alpha=0.05)
iterative_sparse_filter = _by_name("iterative_sparse_filter", "mag1c", alpha=0.05)
iterative_sparse_filter_fast = _by_name("iterative_sparse_filter_fast", "mag1c_fast", alpha=0.05, iterations=30, tolerance=1e-6)
wide_window_filter = _by_name("wide_window_filter", "wwmf", alpha=0.05)
retrieve_column_groups = _by_name("retrieve_column_groups", "mf", alpha=0.05, column_step=4)


@query(
    "retrieve_scene",
    f"""WITH {fx.SPECTRA} SELECT scene, col, count(*) FILTER ((row * 10 + col) % 23 <> 7) AS valid, count(*) FILTER ((row * 10 + col) % 23 <> 7) = 0 AS empty,
      count(*) FILTER ((row * 10 + col) % 23 <> 7) < 64 AS underdetermined FROM spectra GROUP BY ALL""",
)
def retrieve_scene(spark, d):
    """Column report of a full retrieval: the pixels that came back valid, per detector column."""
    out = S.retrieve(cube(spark, d), TEMPLATE, "rmf", alpha=0.05)
    g = out.groupBy("scene", "col").agg(F.count("enhancement").alias("valid"))
    return g.select("*", (F.col("valid") == 0).alias("empty"), (F.col("valid") < BANDS).alias("underdetermined"))
