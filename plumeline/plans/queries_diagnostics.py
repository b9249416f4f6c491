"""Cross-catalogue diagnostics over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import aggs as G
from plumeline.operators import diagnostics as D
from plumeline.operators import joins as J
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.queries_joins import OVERLAPS, overlaps, polygons
from plumeline.plans.registry import query

SELF = f"""{fx.MASKS}, mm AS (SELECT * FROM masks WHERE side = 'b'), ma AS (SELECT scene, plume, count(*) AS area FROM mm GROUP BY ALL),
  ms AS (SELECT a.scene, a.plume AS plume_a, b.plume AS plume_b, count(*) AS inter FROM mm a JOIN mm b ON a.scene = b.scene AND a.row = b.row AND a.col = b.col AND a.plume < b.plume GROUP BY ALL),
  sf AS (SELECT ms.*, inter / (p.area + q.area - inter) AS iou, inter / p.area AS in_a, inter / q.area AS in_b FROM ms JOIN ma p ON p.scene = ms.scene AND p.plume = plume_a JOIN ma q ON q.scene = ms.scene AND q.plume = plume_b)"""


def self_overlaps(spark, d):
    return J.self_overlap_pairs(fx.masks(spark, d).where("side = 'b'"))


def _sources(spark, d):
    return fx.masks(spark, d).where("side = 'b'").select("scene", "plume").distinct().withColumn("source", F.col("plume") % 3)


@query(
    "twin_pairs",
    f"""WITH {SELF} SELECT scene, count(*) FILTER (iou >= 0.5) AS twins, count(*) AS touching, round(max(iou), 6) AS max_iou FROM sf WHERE plume_a % 3 <> plume_b % 3 GROUP BY scene""",
)
def twin_pairs(spark, d):
    return rounded(D.twin_report(D.twin_pairs(self_overlaps(spark, d), _sources(spark, d))))


@query(
    "group_components_report",
    """WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS s, l_partkey AS a, l_suppkey + 100000 AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
      u AS (SELECT s, a, b FROM e UNION ALL SELECT s, b, a FROM e), r AS (SELECT DISTINCT s, a AS node, a AS seen FROM u UNION SELECT r.s, r.node, u.b FROM r JOIN u ON u.s = r.s AND u.a = r.seen),
      c AS (SELECT s, node, min(seen) AS comp FROM r GROUP BY ALL), g AS (SELECT s, comp, count(*) AS k, list_sort(list(node :: VARCHAR)) AS m FROM c GROUP BY ALL)
    SELECT s AS scene, count(*) AS groups, max(k) AS largest, to_json(list(m ORDER BY k DESC, m)) :: VARCHAR AS members FROM g GROUP BY s""",
)
def group_components_report(spark, d):
    li = fx.table(spark, d, "lineitem")
    links = li.join(fx.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("scene"), F.col("l_partkey").alias("a"), (F.col("l_suppkey") + 100000).alias("b")
    )
    return D.group_components_report(links, "scene", "a", "b")


@query(
    "orphan_kinds",
    f"""WITH {SELF}, o AS (SELECT DISTINCT scene, plume FROM mm WHERE plume % 2 = 0), b AS (SELECT scene, plume_a AS plume, plume_b AS other, iou, in_a AS inside FROM sf UNION ALL SELECT scene, plume_b, plume_a, iou, in_b FROM sf),
      h AS (SELECT scene, plume, max(iou) AS i, max(inside) AS c FROM b WHERE other % 2 = 1 GROUP BY ALL)
    SELECT scene, plume, round(coalesce(i, 0), 6) AS best_iou, round(coalesce(c, 0), 6) AS best_inside, CASE WHEN i >= 0.5 OR c >= 0.9 THEN 'twin' WHEN i > 0 THEN 'partial' ELSE 'genuine' END AS kind FROM o LEFT JOIN h USING (scene, plume)""",
)
def orphan_kinds(spark, d):
    names = fx.masks(spark, d).where("side = 'b'").select("scene", "plume").distinct()
    return rounded(D.orphan_kinds(names.where("plume % 2 = 0"), names.where("plume % 2 = 1"), self_overlaps(spark, d)))


@query(
    "pairs_with_twin",
    OVERLAPS + """, tw AS (SELECT a.scene, a.plume AS p, b.plume AS q FROM masks a JOIN masks b ON a.scene = b.scene AND a.row = b.row AND a.col = b.col AND a.plume < b.plume AND a.side = 'b' AND b.side = 'b' GROUP BY ALL HAVING count(*) >= 6),
      nm AS (SELECT scene, p AS plume_b FROM tw UNION SELECT scene, q FROM tw)
    SELECT scene, count(*) AS pairs, count(nm.plume_b) AS with_twin FROM pairs LEFT JOIN nm USING (scene, plume_b) GROUP BY scene HAVING count(nm.plume_b) > 0""",
)
def pairs_with_twin(spark, d):
    return D.pairs_with_twin(overlaps(spark, d), self_overlaps(spark, d).where("inter >= 6"))


FLUXES = """fl AS (SELECT l_suppkey AS scene, CASE WHEN l_returnflag = 'A' THEN 'a' ELSE 'b' END AS side, l_linenumber AS plume, avg(l_extendedprice) / 10 AS flux, avg(l_discount) * 100 - 2 AS wind FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY ALL)"""


def fluxes(spark, d):
    t = fx.table(spark, d, "lineitem").where(F.col("l_returnflag").isin("A", "R"))
    return t.groupBy(
        F.col("l_suppkey").alias("scene"), F.when(F.col("l_returnflag") == "A", "a").otherwise("b").alias("side"), F.col("l_linenumber").alias("plume")
    ).agg((F.avg("l_extendedprice") / 10).alias("flux"), (F.avg("l_discount") * 100 - 2).alias("wind"))


@query(
    "pair_similarity",
    OVERLAPS + f""", {FLUXES} SELECT pairs.scene, plume_a, plume_b, round(a.flux, 3) AS flux_a, round(b.flux, 3) AS flux_b, round(b.flux / a.flux, 6) AS flux_ratio, round(area_b / area_a, 6) AS area_ratio, round(iou, 6) AS iou, round(dist, 6) AS dist
      FROM pairs LEFT JOIN fl a ON a.scene = pairs.scene AND a.side = 'a' AND a.plume = plume_a LEFT JOIN fl b ON b.scene = pairs.scene AND b.side = 'b' AND b.plume = plume_b""",
)
def pair_similarity(spark, d):
    f = fluxes(spark, d)
    out = D.pair_similarity(overlaps(spark, d), f.where("side = 'a'"), f.where("side = 'b'"))
    return rounded(out.withColumn("flux_a", F.round("flux_a", 3)).withColumn("flux_b", F.round("flux_b", 3)))


@query(
    "flux_vs_wind_ratio",
    OVERLAPS + f""", {FLUXES} SELECT pairs.scene, plume_a, plume_b, round(b.flux / a.flux, 6) AS flux_ratio, round(b.wind / a.wind, 6) AS wind_ratio
      FROM pairs JOIN fl a ON a.scene = pairs.scene AND a.side = 'a' AND a.plume = plume_a JOIN fl b ON b.scene = pairs.scene AND b.side = 'b' AND b.plume = plume_b WHERE a.wind > 0 AND b.wind > 0""",
)
def flux_vs_wind_ratio(spark, d):
    f = fluxes(spark, d)
    return rounded(D.flux_vs_wind_ratio(overlaps(spark, d), f.where("side = 'a'"), f.where("side = 'b'")))


@query(
    "wind_sampling_modes",
    f"""WITH {fx.MASKS}, {FLUXES}, fd AS (SELECT l_suppkey AS scene, CAST(l_partkey % 12 AS INT) AS row, CAST(l_quantity AS INT) % 12 AS col, avg(l_tax) * 100 AS speed FROM lineitem GROUP BY ALL), m AS (SELECT * FROM masks WHERE side = 'a'),
      pt AS (SELECT scene, plume, min(row * 100 + col) AS k FROM m GROUP BY ALL), sc AS (SELECT scene, avg(speed) AS s FROM fd GROUP BY scene), ov AS (SELECT scene, plume, avg(speed) AS o FROM m JOIN fd USING (scene, row, col) GROUP BY ALL)
    SELECT fl.scene, fl.plume, round(fl.wind, 6) AS theirs, round(p.speed, 6) AS at_point, round(o, 6) AS over_plume, round(s, 6) AS scene_mean FROM fl LEFT JOIN pt USING (scene, plume) LEFT JOIN fd p ON p.scene = fl.scene AND p.row = k // 100 AND p.col = k % 100
      LEFT JOIN ov ON ov.scene = fl.scene AND ov.plume = fl.plume LEFT JOIN sc ON sc.scene = fl.scene WHERE side = 'a' AND fl.wind > 0""",
)
def wind_sampling_modes(spark, d):
    field = fx.table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("scene"), (F.col("l_partkey") % 12).cast("int").alias("row"), (F.col("l_quantity").cast("int") % 12).alias("col")
    ).agg((F.avg("l_tax") * 100).alias("speed"))
    m = fx.masks(spark, d).where("side = 'a'").drop("side")
    point = m.groupBy("scene", "plume").agg(F.min(F.struct("row", "col")).alias("p")).select("scene", "plume", "p.*")
    pub = fluxes(spark, d).where("side = 'a'").select("scene", "plume", F.col("wind").alias("theirs"))
    return rounded(D.wind_sampling_modes(field, m, point, pub))


@query(
    "wind_intrascene_spread",
    f"""WITH {fx.PLUMES_B}, w AS (SELECT granule, (flux - 20) / 10 AS u, (k - 45) / 9.0 + 0.01 AS v FROM plumes_b), s AS (SELECT granule, sqrt(u * u + v * v) AS s, atan2(u, v) AS d FROM w), g AS (SELECT granule, min(s) AS lo, max(s) AS hi, avg(sin(d)) AS a, avg(cos(d)) AS b FROM s GROUP BY granule)
    SELECT granule, round(lo, 6) AS speed_min, round(hi, 6) AS speed_max, round(hi / lo, 4) AS speed_ratio, round(degrees(sqrt(-2 * ln(sqrt(a * a + b * b)))), 4) AS circular_sd, round(sqrt(a * a + b * b), 6) AS resultant FROM g""",
)
def wind_intrascene_spread(spark, d):
    b = fx.plumes_b(spark, d)
    out = D.wind_intrascene_spread(b, "granule", (F.col("flux") - 20) / 10, (F.col("k") - 45) / F.lit(9.0) + 0.01)
    r = lambda c, n: F.round(c, n).alias(c)
    return out.select("granule", r("speed_min", 6), r("speed_max", 6), r("speed_ratio", 4), r("circular_sd", 4), r("resultant", 6))


@query(
    "flux_area_relation",
    """WITH g AS (SELECT l_orderkey, sum(l_extendedprice) AS f, sum(l_quantity) * 40 AS a FROM lineitem GROUP BY 1), r AS (SELECT a, rank() OVER (ORDER BY log10(f)) + (count(*) OVER (PARTITION BY log10(f)) - 1) / 2.0 AS rf, rank() OVER (ORDER BY log10(a)) + (count(*) OVER (PARTITION BY log10(a)) - 1) / 2.0 AS ra FROM g)
    SELECT count(*) AS n, round(avg(CASE WHEN a <= 1024 THEN 1 ELSE 0 END), 6) AS fits_64, round(avg(CASE WHEN a <= 4096 THEN 1 ELSE 0 END), 6) AS fits_128, round(avg(CASE WHEN a <= 16384 THEN 1 ELSE 0 END), 6) AS fits_256, round(corr(rf, ra), 6) AS rho FROM r""",
)
def flux_area_relation(spark, d):
    g = fx.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("f"), (F.sum("l_quantity") * 40).alias("a"))
    return rounded(D.flux_area_relation(g, "f", "a"))


@query(
    "polygon_area",
    """WITH p AS (SELECT n_name AS name, n_nationkey // 5 * 30.0 - 60 AS cy, 12.037 + n_nationkey % 7 + n_nationkey * 0.0013 AS r FROM nation)
    SELECT name, round(radians(r) * 6371000.0 * 6371000.0 * (sin(radians(cy + r)) - sin(radians(cy - r))) / 1e6, 2) AS km2 FROM p""",
)
def polygon_area(spark, d):
    return polygons(spark, d).select("name", F.round(D.ring_area_m2(F.col("ring")) / 1e6, 2).alias("km2"))


@query(
    "unquantified_profile",
    f"""WITH {fx.CATALOGUE_A} SELECT CASE WHEN flux IS NULL THEN 'without flux' ELSE 'with flux' END AS kind, count(*) AS n, quantile_cont(qty, 0.25) AS q1, quantile_cont(qty, 0.5) AS median, quantile_cont(qty, 0.75) AS q3 FROM catalogue_a GROUP BY 1""",
)
def unquantified_profile(spark, d):
    return D.unquantified_profile(fx.catalogue_a(spark, d), "flux", "qty")


@query(
    "stale_negatives",
    """WITH l AS (SELECT user_id AS granule, count(*) AS late_plumes, min(ts) AS first_late FROM events WHERE ts > TIMESTAMP '2024-01-20' GROUP BY 1)
    SELECT granule, late_plumes, first_late FROM (SELECT c_custkey AS granule FROM customer WHERE c_acctbal < 3000) JOIN l USING (granule)""",
)
def stale_negatives(spark, d):
    free = fx.table(spark, d, "customer").where("c_acctbal < 3000").select(F.col("c_custkey").alias("granule"))
    e = fx.table(spark, d, "events").select(F.col("user_id").alias("granule"), "ts")
    return D.stale_negatives(free, e, "granule", "ts", F.lit("2024-01-20").cast("timestamp_ntz"))


@query(
    "isolate_catalog_attribution",
    """SELECT count(*) AS rows, count(*) FILTER (contains(url, 'example.org')) AS ours, count(*) FILTER (contains(url, 'example.net')) AS theirs FROM pages""",
)
def isolate_catalog_attribution(spark, d):
    return D.isolate_attribution(fx.table(spark, d, "pages"), "url", {"ours": "example.org", "theirs": "example.net"})


@query(
    "representativeness_report",
    f"""WITH {fx.SCENES}, p AS (SELECT 'all' AS population, * FROM scenes UNION ALL SELECT 'weak', * FROM scenes WHERE flux_bin = 'has_weak'),
      l AS (SELECT population, 'region' AS dimension, region AS key FROM p UNION ALL SELECT population, 'year', CAST(year AS VARCHAR) FROM p UNION ALL SELECT population, 'flux', CASE WHEN flux_max < 100 THEN '0-100' WHEN flux_max < 300 THEN '100-300' WHEN flux_max < 1000 THEN '300-1000' WHEN flux_max < 3000 THEN '1000-3000' WHEN flux_max >= 3000 THEN '3000+' END FROM p),
      c AS (SELECT population, dimension, key, count(*) AS n FROM l WHERE key IS NOT NULL GROUP BY ALL)
    SELECT *, round(100 * n / sum(n) OVER (PARTITION BY population, dimension), 6) AS share FROM c""",
)
def representativeness_report(spark, d):
    s = fx.scenes(spark, d)
    names = F.when(F.col("flux_bin") == "has_weak", F.array(F.lit("all"), F.lit("weak"))).otherwise(F.array(F.lit("all")))
    p = s.withColumn("population", F.explode(names))
    dims = {"region": F.col("region"), "year": F.col("year"), "flux": G.flux_bin(F.col("flux_max"))}
    return rounded(D.representativeness_report(p, "population", dims))
