"""Joins over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import aggs as G
from plumeline.operators import joins as J
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.registry import query


@query(
    "consensus_join",
    f"""WITH {fx.PLUMES_A}, {fx.PLUMES_B},
     a AS (SELECT granule, count(*) AS n_a, max(flux) AS flux_max_a, round(quantile_cont(flux, 0.5), 6) AS flux_med_a,
       min(country) AS first_country, CAST(min(year(day)) AS INTEGER) AS year FROM plumes_a GROUP BY granule),
     b AS (SELECT granule, count(*) AS n_b, max(flux) AS flux_max_b, round(quantile_cont(flux, 0.5), 6) AS flux_med_b FROM plumes_b GROUP BY granule)
    SELECT granule, coalesce(n_a, 0) AS n_a, flux_max_a, flux_med_a, first_country, coalesce(n_b, 0) AS n_b, flux_max_b, flux_med_b,
      coalesce(n_a, 0) > 0 AND coalesce(n_b, 0) > 0 AS consensus, year FROM a FULL JOIN b USING (granule)""",
)
def consensus_join(spark, d):
    extra = [F.min("country").alias("first_country"), F.min(F.year("day")).alias("year")]
    a = G.granule_rollup(fx.plumes_a(spark, d), "granule", "flux", "a", extra)
    b = G.granule_rollup(fx.plumes_b(spark, d), "granule", "flux", "b")
    return rounded(J.consensus_join(a, b, "granule", "n_a", "n_b"))


@query(
    "lookup_left_join",
    """SELECT event_id, coalesce(c_name, 'id-' || event_id) AS source_name FROM events
       LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON user_id = c_custkey""",
)
def lookup_left_join(spark, d):
    names = fx.table(spark, d, "customer").where("c_custkey % 3 = 0").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("source_name")
    )
    e = fx.table(spark, d, "events").select("event_id", "user_id")
    fallback = F.concat(F.lit("id-"), F.col("event_id"))
    return J.lookup_left(e, names, "user_id", "source_name", fallback).drop("user_id")


@query(
    "map_path_join",
    """SELECT o_orderkey, coalesce(c_name || '.nc', '') AS path FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def map_path_join(spark, d):
    paths = fx.table(spark, d, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.concat("c_name", F.lit(".nc")).alias("path")
    )
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return J.lookup_left(o, paths, "o_custkey", "path", F.lit("")).drop("o_custkey")


@query("semi_join_keys", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def semi_join_keys(spark, d):
    keys = fx.table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    return fx.table(spark, d, "customer").select("c_custkey", "c_name").join(keys, "c_custkey", "left_semi")


@query("anti_join_missing", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def anti_join_missing(spark, d):
    keys = fx.table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    return fx.table(spark, d, "customer").select("c_custkey").join(keys, "c_custkey", "left_anti")


KEYS4 = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "multi_key_enrich",
    """WITH k AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, max(l_quantity) AS width, CASE WHEN max(l_tax) > 0 THEN max(l_discount) END AS share FROM lineitem GROUP BY ALL)
    SELECT count(*) FILTER (width IS NULL) AS width, count(*) FILTER (share IS NULL) AS share FROM lineitem JOIN k USING (l_orderkey, l_partkey, l_suppkey, l_linenumber)""",
)
def multi_key_enrich(spark, d):
    t = fx.table(spark, d, "lineitem")
    widths = t.groupBy(*KEYS4).agg(F.max("l_quantity").alias("width"))
    shares = t.groupBy(*KEYS4).agg(F.max("l_discount").alias("share"), F.max("l_tax").alias("_t")).where("_t > 0").drop("_t")
    return J.missing_report(J.enrich(t.select(*KEYS4), [widths, shares], KEYS4), ["width", "share"])


@query(
    "old_new_compare_join",
    """WITH v AS (SELECT l_suppkey AS k, l_linenumber AS n, max(l_quantity) FILTER (l_returnflag = 'A') AS o, max(l_quantity) FILTER (l_returnflag = 'R') AS w FROM lineitem GROUP BY ALL)
    SELECT k, n, o AS flux_old, w AS flux_new, abs(o - w) AS gap FROM v WHERE o IS NOT NULL AND w IS NOT NULL""",
)
def old_new_compare_join(spark, d):
    t = fx.table(spark, d, "lineitem")
    v = lambda f: t.where(F.col("l_returnflag") == f).groupBy(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.max("l_quantity").alias("flux"))
    return J.compare_versions(v("A"), v("R"), ["k", "n"], "flux").withColumn("gap", F.abs(F.col("flux_old") - F.col("flux_new")))


HOURLY = """hourly AS (SELECT event_type AS node, date_trunc('hour', ts) AS hour, avg(value) AS u, avg(value * 2 - 5) AS v FROM events GROUP BY ALL)"""


def hourly(spark, d):
    return (
        fx.table(spark, d, "events")
        .groupBy(F.col("event_type").alias("node"), F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.avg("value").alias("u"), F.avg(F.col("value") * 2 - 5).alias("v"))
    )


@query(
    "equi_join_hours",
    f"""WITH {HOURLY} SELECT a.node, a.hour, round(a.u, 6) AS u0, round(b.u, 6) AS u1 FROM hourly a JOIN hourly b ON a.node = b.node AND b.hour = a.hour + INTERVAL 1 HOUR""",
)
def equi_join_hours(spark, d):
    h = hourly(spark, d)
    a = h.select("node", "hour", F.col("u").alias("u0"))
    b = h.select("node", (F.col("hour") - F.expr("interval 1 hour")).alias("hour"), F.col("u").alias("u1"))
    return rounded(a.join(b, ["node", "hour"]))


RANKED = """ranked AS (SELECT o_custkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rank,
  CAST(o_orderdate AS DATE) AS date, o_totalprice AS cloud, o_orderkey AS file FROM orders)"""


def ranked(spark, d, n=3):
    from plumeline.operators.ranks import head_per_group

    t = fx.table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("cloud"),
        F.col("o_orderkey").alias("file"),
    )
    return head_per_group(t, ["id"], [F.col("date"), F.col("file")], n, "rank")


@query(
    "pivot_references",
    f"""WITH {RANKED} SELECT c_custkey AS id, max(date) FILTER (rank = 1) AS date1, max(cloud) FILTER (rank = 1) AS cloud1,
      max(date) FILTER (rank = 2) AS date2, max(cloud) FILTER (rank = 2) AS cloud2, max(date) FILTER (rank = 3) AS date3, max(cloud) FILTER (rank = 3) AS cloud3
    FROM customer LEFT JOIN ranked ON id = c_custkey GROUP BY 1""",
)
def pivot_references(spark, d):
    wide = J.pivot_references(ranked(spark, d), "id", "rank", ["date", "cloud"])
    return fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id")).join(wide, "id", "left")


OVERLAPS = f"""WITH {fx.MASKS}, ar AS (SELECT scene, side, plume, count(*) AS area, avg(row) * 60.0 AS y, avg(col) * 60.0 AS x FROM masks GROUP BY ALL),
  sh AS (SELECT a.scene, a.plume AS plume_a, b.plume AS plume_b, count(*) AS inter FROM masks a JOIN masks b
    ON a.scene = b.scene AND a.row = b.row AND a.col = b.col AND a.side = 'a' AND b.side = 'b' GROUP BY ALL),
  pairs AS (SELECT sh.*, p.area AS area_a, q.area AS area_b, inter / (p.area + q.area - inter) AS iou, inter / p.area AS in_a, inter / q.area AS in_b,
    sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS dist
    FROM sh JOIN ar p ON p.scene = sh.scene AND p.side = 'a' AND p.plume = plume_a JOIN ar q ON q.scene = sh.scene AND q.side = 'b' AND q.plume = plume_b)"""


def overlaps(spark, d):
    """Overlapping pairs of the two mask catalogues with the distance of their centres."""
    m = fx.masks(spark, d)
    a, b = m.where("side = 'a'"), m.where("side = 'b'")
    centre = lambda t, s: t.groupBy("scene", F.col("plume").alias(f"plume_{s}")).agg(
        (F.avg("row") * 60).alias(f"y_{s}"), (F.avg("col") * 60).alias(f"x_{s}")
    )
    pairs = J.overlap_pairs(a, b).join(centre(a, "a"), ["scene", "plume_a"]).join(centre(b, "b"), ["scene", "plume_b"])
    gap = F.hypot(F.col("x_a") - F.col("x_b"), F.col("y_a") - F.col("y_b"))
    return pairs.withColumn("dist", gap).drop("x_a", "x_b", "y_a", "y_b")


@query(
    "pair_overlap_theta_join",
    OVERLAPS + """ SELECT scene, plume_a, plume_b, inter, area_a, area_b, round(iou, 6) AS iou, round(in_a, 6) AS in_a, round(in_b, 6) AS in_b,
      round(dist, 6) AS dist, round(1 - greatest(in_a, in_b) + dist / 2000, 6) AS cost FROM pairs""",
)
def pair_overlap_theta_join(spark, d):
    return rounded(J.with_match_cost(overlaps(spark, d), "dist"))


@query(
    "unordered_self_join",
    f"""WITH {fx.MASKS}, m AS (SELECT * FROM masks WHERE side = 'a'), ar AS (SELECT scene, plume, count(*) AS area FROM m GROUP BY ALL),
      sh AS (SELECT a.scene, a.plume AS plume_a, b.plume AS plume_b, count(*) AS inter FROM m a JOIN m b ON a.scene = b.scene AND a.row = b.row AND a.col = b.col AND a.plume < b.plume GROUP BY ALL)
    SELECT sh.*, round(inter / (p.area + q.area - inter), 6) AS iou FROM sh JOIN ar p ON p.scene = sh.scene AND p.plume = plume_a JOIN ar q ON q.scene = sh.scene AND q.plume = plume_b""",
)
def unordered_self_join(spark, d):
    pairs = J.self_overlap_pairs(fx.masks(spark, d).where("side = 'a'"))
    return rounded(pairs.select("scene", "plume_a", "plume_b", "inter", "iou"))


def matched(spark, d):
    """One-to-one matches of the two mask catalogues that pass the acceptance rule."""
    m = fx.masks(spark, d)
    n = m.groupBy("scene").agg(
        F.count_distinct(F.when(F.col("side") == "a", F.col("plume"))).alias("n_a"),
        F.count_distinct(F.when(F.col("side") == "b", F.col("plume"))).alias("n_b"),
    )
    pairs = J.with_match_cost(overlaps(spark, d), "dist")
    chosen = J.assign_one_to_one(pairs, n)
    ok = J.accept_match(F.col("inter") * 3600, F.col("iou"), F.col("in_a"), F.col("in_b"), F.col("dist"))
    return pairs.join(chosen, ["scene", "plume_a", "plume_b"], "left_semi").where(ok)


@query("assign_one_to_one")
def assign_one_to_one(spark, d):
    return rounded(matched(spark, d).select("scene", "plume_a", "plume_b", "iou", "cost"))


@query("greedy_distance_pairs")
def greedy_distance_pairs(spark, d):
    p = fx.points(spark, d)
    place = lambda c: p.where(c).select(
        "country", "id", (F.col("lon") * 111.32 * F.cos(F.radians("lat"))).alias("x"), (F.col("lat") * 111.32).alias("y")
    )
    pairs = J.greedy_distance_pairs(place("id % 2 = 0"), place("id % 2 = 1"), "country", "id", 2000.0)
    return rounded(pairs.select("country", "a", "b", "distance"))


@query(
    "seasonal_window_join",
    f"""WITH {fx.TARGETS}, t AS (SELECT target, site, day AS target_day FROM targets),
      n AS (SELECT site, target, target_day, candidate, day, 0 AS branch FROM t JOIN candidates c USING (site) WHERE abs(day - target_day) BETWEEN 5 AND 120),
      s AS (SELECT * FROM t WHERE target NOT IN (SELECT target FROM n GROUP BY 1 HAVING count(*) >= 2)),
      w AS (SELECT *, CAST(target_day - to_years(y) AS DATE) AS anchor FROM s CROSS JOIN (SELECT unnest([0, 1, 2]) :: INTEGER AS y)),
      x AS (SELECT *, anchor - 45 AS f, CASE WHEN y = 0 THEN target_day - 5 ELSE anchor + 45 END AS u FROM w),
      z AS (SELECT site, target, target_day, candidate, day, y + 1 AS branch FROM x JOIN candidates c USING (site) WHERE u > f AND day BETWEEN f AND u AND day < target_day - 5),
      e AS (SELECT site, target, target_day, candidate, day, min(branch) AS branch FROM (SELECT * FROM n UNION ALL SELECT * FROM z) GROUP BY ALL),
      bc AS (SELECT target, branch, count(*) AS n FROM e GROUP BY ALL), b AS (SELECT target, branch, coalesce(sum(n) OVER (PARTITION BY target ORDER BY branch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM bc)
    SELECT target, branch, site, target_day, candidate, day FROM e JOIN b USING (target, branch) WHERE branch = 0 OR before < 2""",
)
def seasonal_window_join(spark, d):
    t = fx.targets(spark, d).select("target", "site", F.col("day").alias("target_day"))
    c = fx.candidates(spark, d).select("candidate", "site", "day")
    out = J.seasonal_window_join(t, c, "site", "target", "candidate", pool=2)
    return out.select("target", "branch", "site", "target_day", "candidate", "day")


@query(
    "within_days_join",
    f"""WITH {fx.TARGETS} SELECT t.target, c.candidate, abs(t.day - c.day) AS gap FROM targets t JOIN candidates c USING (site) WHERE abs(t.day - c.day) <= 120""",
)
def within_days_join(spark, d):
    t = fx.targets(spark, d).select("target", "site", F.col("day").alias("target_day"))
    c = fx.candidates(spark, d).select("candidate", "site", "day")
    gap = J.days_between(F.col("day"), F.col("target_day")).cast("bigint")
    return J.within_days_join(t, c, "site", 120).select("target", "candidate", gap.alias("gap"))


BANK = """bank AS (SELECT p_partkey AS id, CAST(2 + p_size % 5 AS DOUBLE) AS wind, CAST(p_partkey % 7 * 10 AS DOUBLE) AS sza, CAST(p_partkey % 36 * 10 AS DOUBLE) AS raa FROM part),
  q AS (SELECT event_id, value / 50 AS wind, CAST(regexp_extract(props, ': ([0-9]+)', 1) AS INT) * 0.7 AS sza, (event_id * 13.037 + 0.0137) % 360 AS raa FROM events)"""


def bank(spark, d):
    k = F.col("p_partkey")
    return fx.table(spark, d, "part").select(
        k.alias("id"),
        (2 + F.col("p_size") % 5).cast("double").alias("wind"),
        (k % 7 * 10).cast("double").alias("sza"),
        (k % 36 * 10).cast("double").alias("raa"),
    )


def bank_queries(spark, d):
    return fx.plumes_b(spark, d).select(
        F.col("plume_id").alias("event_id"),
        (F.col("flux") / 50).alias("wind"),
        (F.col("k") * F.lit(0.7)).alias("sza"),
        ((F.col("plume_id") * F.lit(13.037) + 0.0137) % 360).alias("raa"),
    )


@query(
    "snap_to_grid_lookup",
    f"""WITH {BANK}, gw AS (SELECT DISTINCT wind FROM bank), gs AS (SELECT DISTINCT sza FROM bank),
      s AS (SELECT event_id, raa, (SELECT g.wind FROM gw g ORDER BY abs(g.wind - q.wind), g.wind LIMIT 1) AS wind, (SELECT g.sza FROM gs g ORDER BY abs(g.sza - q.sza), g.sza LIMIT 1) AS sza FROM q),
      n AS (SELECT *, row_number() OVER (PARTITION BY wind, sza, raa ORDER BY id) AS t FROM bank QUALIFY t <= 2),
      j AS (SELECT s.event_id, n.id, least(abs(n.raa - s.raa), 360 - abs(n.raa - s.raa)) AS gap, t, wind, sza FROM s JOIN n USING (wind, sza))
    SELECT event_id, id, wind, sza, round(gap, 6) AS gap, row_number() OVER (PARTITION BY event_id ORDER BY round(gap, 9), t, id) AS rank FROM j QUALIFY rank <= 2""",
)
def snap_to_grid_lookup(spark, d):
    out = J.snap_to_grid_lookup(bank_queries(spark, d), bank(spark, d), "event_id", 2, tie=F.col("id"))
    return rounded(out.select("event_id", "id", "wind", "sza", "gap", F.col("rank").cast("bigint").alias("rank")))


@query(
    "knn_circular",
    f"""WITH {BANK}, nodes AS (SELECT wind, sza, raa, min(id) AS id FROM bank GROUP BY ALL),
      st AS (SELECT avg(sza) AS mz, stddev_pop(sza) AS sz, avg(sin(radians(raa))) AS ms, stddev_pop(sin(radians(raa))) AS ss, avg(cos(radians(raa))) AS mc, stddev_pop(cos(radians(raa))) AS sc, avg(wind) AS mw, stddev_pop(wind) AS sw FROM nodes),
      c AS (SELECT c_custkey, c_custkey % 61 + 0.3 AS sza, (c_custkey * 7.7 + 0.011) % 360 AS raa, c_custkey % 47 / 10.0 + 1.53 AS wind FROM customer),
      dd AS (SELECT c_custkey, id, sqrt(pow((c.sza - n.sza) / sz, 2) + pow((sin(radians(c.raa)) - sin(radians(n.raa))) / ss, 2) + pow((cos(radians(c.raa)) - cos(radians(n.raa))) / sc, 2) + pow((c.wind - n.wind) / sw, 2)) AS dist,
        least(abs(c.raa - n.raa), 360 - abs(c.raa - n.raa)) AS dr, c.sza - n.sza AS ds, abs(c.wind - n.wind) AS dw FROM c CROSS JOIN nodes n CROSS JOIN st)
    SELECT c_custkey, id, row_number() OVER (PARTITION BY c_custkey ORDER BY dist, id) AS rank, round(dist, 6) AS distance, round(sqrt(dr * dr + ds * ds), 6) AS angular_gap, round(dw, 6) AS wind_error FROM dd QUALIFY rank <= 3""",
)
def knn_circular(spark, d):
    nodes = bank(spark, d).groupBy("wind", "sza", "raa").agg(F.min("id").alias("id"))
    c = F.col("c_custkey")
    q = fx.table(spark, d, "customer").select(
        "c_custkey",
        (c % 61 + 0.3).alias("sza"),
        ((c * F.lit(7.7) + 0.011) % 360).alias("raa"),
        (c % 47 / F.lit(10.0) + 1.53).alias("wind"),
    )
    near = J.knn_circular(q, nodes, "c_custkey", 3)
    return rounded(near.withColumn("rank", F.col("rank").cast("bigint")))


POLYGONS = """poly AS (SELECT n_name AS name, n_nationkey % 5 * 70.0 - 140 AS cx, n_nationkey // 5 * 30.0 - 60 AS cy, 12.037 + n_nationkey % 7 + n_nationkey * 0.0013 AS r FROM nation)"""


def polygons(spark, d):
    n = F.col("n_nationkey")
    cx, cy, r = n % 5 * 70.0 - 140, F.floor(n / 5) * 30.0 - 60, n % 7 + 12.037 + n * F.lit(0.0013)
    corner = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    ring = F.array(corner(cx + r, cy), corner(cx, cy + r), corner(cx - r, cy), corner(cx, cy - r))
    return fx.table(spark, d, "nation").select(F.col("n_name").alias("name"), ring.alias("ring"))


@query(
    "point_in_polygon_join",
    f"""WITH {fx.POINTS}, {POLYGONS}, h AS (SELECT id, min(name) AS name FROM points JOIN poly ON abs(lon - cx) + abs(lat - cy) < r GROUP BY id),
      k AS (SELECT [cx + r, cx, cx - r, cx] AS px, [cy, cy + r, cy, cy - r] AS py, name FROM poly),
      e AS (SELECT name, px[i] AS x1, py[i] AS y1, px[i % 4 + 1] AS x2, py[i % 4 + 1] AS y2 FROM k, range(1, 5) t(i)),
      g AS (SELECT id, name, lon, lat, x1, y1, x2, y2, least(greatest(((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 0), 1) AS t
        FROM (SELECT * FROM points WHERE id NOT IN (SELECT id FROM h)) CROSS JOIN e),
      m AS (SELECT id, name, min(sqrt(pow(lon - x1 - t * (x2 - x1), 2) + pow(lat - y1 - t * (y2 - y1), 2))) AS distance FROM g GROUP BY ALL)
    SELECT id, name, 0.0 :: DOUBLE AS distance FROM h UNION ALL
    (SELECT id, name, round(distance, 6) FROM m QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, name) = 1)""",
)
def point_in_polygon_join(spark, d):
    out = J.point_in_polygon_join(fx.points(spark, d), polygons(spark, d), "id", "name", cell=20.0)
    return rounded(out.select("id", "name", "distance"))


GRID = f"""WITH {fx.SPECTRA}, px AS (SELECT scene, row, col, col * 0.013 AS lon, row * 0.011 AS lat FROM spectra),
  src AS (SELECT s_suppkey AS source, s_suppkey % 5 AS scene, (s_suppkey * 7 % 150) / 1000.0 + 0.0003 AS lon, (s_suppkey * 11 % 250) / 1000.0 + 0.0007 AS lat FROM supplier)"""


@query(
    "nearest_pixel_capped",
    GRID + """ SELECT px.scene, source, row, col, round(pow(px.lon - src.lon, 2) + pow(px.lat - src.lat, 2), 10) AS d2 FROM src JOIN px ON px.scene = src.scene
      WHERE pow(px.lon - src.lon, 2) + pow(px.lat - src.lat, 2) <= 0.0025
      QUALIFY row_number() OVER (PARTITION BY px.scene, source ORDER BY pow(px.lon - src.lon, 2) + pow(px.lat - src.lat, 2), row, col) = 1""",
)
def nearest_pixel_capped(spark, d):
    k = F.col("s_suppkey")
    src = fx.table(spark, d, "supplier").select(
        k.alias("source"),
        (k % 5).cast("int").alias("scene"),
        ((k * 7 % 150) / F.lit(1000.0) + 0.0003).alias("lon"),
        ((k * 11 % 250) / F.lit(1000.0) + 0.0007).alias("lat"),
    )
    px = fx.spectra(spark, d).select(
        "scene", "row", "col", (F.col("col") * F.lit(0.013)).alias("lon"), (F.col("row") * F.lit(0.011)).alias("lat")
    )
    return rounded(J.nearest_pixel_capped(src, px, "scene", "source"), 10)


@query(
    "best_overlap_candidate",
    OVERLAPS + """ SELECT scene, plume_a, plume_b, round(iou, 6) AS iou FROM pairs QUALIFY row_number() OVER (PARTITION BY scene, plume_a ORDER BY iou DESC, plume_b) = 1""",
)
def best_overlap_candidate(spark, d):
    m = fx.masks(spark, d)
    pairs = J.overlap_pairs(m.where("side = 'a'"), m.where("side = 'b'"))
    return rounded(J.best_overlap(pairs, ["scene", "plume_a"], "plume_b"))


@query(
    "lut_bracket_join",
    """WITH lut AS (SELECT p_size % 5 AS curve, CAST(p_size AS DOUBLE) AS x, avg(p_retailprice) AS y FROM part GROUP BY ALL),
      l2 AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, row_number() OVER w = 1 AS first FROM lut WINDOW w AS (PARTITION BY curve ORDER BY x)),
      q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 5 AS curve, l_quantity + 0.25 AS x FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN q.x < l.x THEN l.y WHEN l.nx IS NULL THEN l.y ELSE l.y + (q.x - l.x) / (l.nx - l.x) * (l.ny - l.y) END, 5) AS t
    FROM q JOIN l2 l ON q.curve = l.curve AND ((q.x >= l.x AND (q.x < l.nx OR l.nx IS NULL)) OR (l.first AND q.x < l.x))""",
)
def lut_bracket_join(spark, d):
    lut = (
        fx.table(spark, d, "part")
        .groupBy((F.col("p_size") % 5).alias("curve"), F.col("p_size").cast("double").alias("x"))
        .agg(F.avg("p_retailprice").alias("y"))
    )
    q = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_linenumber") % 5).alias("curve"), (F.col("l_quantity") + 0.25).alias("x")
    )
    return rounded(J.lut_bracket_join(q, lut, ["curve"], "x", "t").drop("curve", "x"), 5)


LERP = f"""WITH {HOURLY}, e AS (SELECT event_id, event_type AS node, ts, value AS published, date_trunc('hour', ts) AS h0, date_trunc('hour', ts) + INTERVAL 1 HOUR AS h1,
    (epoch_us(ts) - epoch_us(date_trunc('hour', ts))) / 3.6e9 AS frac FROM events),
  j AS (SELECT event_id, published, frac, a.u AS u0, b.u AS u1, a.u * (1 - frac) + b.u * frac AS u, a.v * (1 - frac) + b.v * frac AS v FROM e
    JOIN hourly a ON a.node = e.node AND a.hour = h0 JOIN hourly b ON b.node = e.node AND b.hour = h1)"""


def _lerp(spark, d):
    e = fx.table(spark, d, "events").select("event_id", F.col("event_type").alias("node"), "ts", F.col("value").alias("published"))
    return J.temporal_lerp(e, hourly(spark, d), ["node"], "ts", ["u", "v"])


@query("temporal_lerp", LERP + " SELECT event_id, round(u, 6) AS u, round(v, 6) AS v FROM j")
def temporal_lerp(spark, d):
    return _lerp(spark, d).select(
        "event_id", F.round("u", 6).alias("u"), F.round("v", 6).alias("v")
    )


@query(
    "asof_variants",
    LERP + """ SELECT variant, round(quantile_cont(gap, 0.5), 6) AS median_gap FROM (
      SELECT 'prev' AS variant, abs(u0 - published) AS gap FROM j UNION ALL SELECT 'next', abs(u1 - published) FROM j UNION ALL
      SELECT 'nearest', abs(CASE WHEN frac < 0.5 THEN u0 ELSE u1 END - published) FROM j UNION ALL SELECT 'interp', abs(u - published) FROM j) GROUP BY 1""",
)
def asof_variants(spark, d):
    return rounded(J.asof_variants(_lerp(spark, d), "u", "published"))


@query(
    "key_date_lookup",
    f"""WITH {RANKED}, w AS (SELECT id, id % 40 AS tile, max(date) FILTER (rank = 1) AS d1, max(date) FILTER (rank = 2) AS d2, max(date) FILTER (rank = 3) AS d3 FROM ranked GROUP BY id),
      m AS (SELECT o_custkey % 40 AS tile, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS platform FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL)
    SELECT id, a.platform AS platform1, b.platform AS platform2, c.platform AS platform3 FROM w LEFT JOIN m a ON a.tile = w.tile AND a.day = d1
      LEFT JOIN m b ON b.tile = w.tile AND b.day = d2 LEFT JOIN m c ON c.tile = w.tile AND c.day = d3""",
)
def key_date_lookup(spark, d):
    wide = J.pivot_references(ranked(spark, d), "id", "rank", ["date"]).withColumn("tile", F.col("id") % 40)
    scenes = (
        fx.table(spark, d, "orders")
        .where("o_orderstatus <> 'P'")
        .groupBy((F.col("o_custkey") % 40).alias("tile"), F.to_date("o_orderdate").alias("day"))
        .agg(F.max("o_orderpriority").alias("platform"))
    )
    return J.key_date_lookup(wide, scenes, "id", "tile", ["date1", "date2", "date3"], "platform")


@query(
    "slot_replacement_join",
    f"""WITH {RANKED}, s AS (SELECT id, rank AS slot, row_number() OVER (PARTITION BY id ORDER BY rank) AS n FROM ranked WHERE rank <= 3 AND cloud > 300000),
      c AS (SELECT o_custkey AS id, o_orderkey AS candidate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS n FROM orders WHERE o_orderstatus = 'P')
    SELECT s.id, CAST(slot AS INTEGER) AS slot, candidate FROM s JOIN c USING (id, n)""",
)
def slot_replacement_join(spark, d):
    slots = ranked(spark, d).select("id", F.col("rank").alias("slot"), "cloud")
    c = fx.table(spark, d, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("candidate"), F.col("o_totalprice").alias("price")
    )
    out = J.slot_replacement(slots, c, "id", F.col("cloud") > 300000, [F.col("price"), F.col("candidate")])
    return out.select("id", "slot", "candidate")


MATES = f"""{fx.MASKS}, pl AS (SELECT DISTINCT scene, side, plume FROM masks), pr AS (SELECT a.scene, a.plume AS p, b.plume AS q FROM pl a JOIN pl b
    ON a.scene = b.scene AND a.side = 'a' AND b.side = 'b' AND b.plume = (a.plume + a.scene) % 7 + 1 WHERE a.plume % 3 > 0)"""


@query(
    "pair_mate_join",
    f"""WITH {MATES}, m AS (SELECT scene, 'a' AS side, p AS plume, 'b' AS mate_side, q AS mate FROM pr UNION ALL SELECT scene, 'b', q, 'a', p FROM pr)
    SELECT scene, side, plume, mate_side, mate, CASE WHEN mate IS NOT NULL THEN 'pair' WHEN plume % 2 = 0 THEN 'orphan' END AS match FROM pl LEFT JOIN m USING (scene, side, plume)""",
)
def pair_mate_join(spark, d):
    pl = fx.masks(spark, d).select("scene", "side", "plume").distinct()
    a = pl.where("side = 'a' and plume % 3 > 0").select("scene", F.col("plume").alias("p"), ((F.col("plume") + F.col("scene")) % 7 + 1).alias("q"))
    b = pl.where("side = 'b'").select("scene", F.col("plume").cast("bigint").alias("q"))
    mates = J.pair_mates(a.join(b, ["scene", "q"]).withColumn("q", F.col("q").cast("int")), "scene", "p", "q")
    return J.pair_mate_join(pl, mates, pl.where("plume % 2 = 0"), "scene")


@query(
    "positional_alignment_join",
    """SELECT (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)) AS only_a, 0 :: BIGINT AS only_b""",
)
def positional_alignment_join(spark, d):
    a = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    b = fx.table(spark, d, "orders").where("o_totalprice > 490000").select(F.col("o_custkey").alias("k")).distinct()
    return J.alignment_gaps(a, b, "k")


@query(
    "experiment_grid",
    """WITH s AS (SELECT DISTINCT lang AS sensor FROM documents) SELECT sensor, seed, refs, model, count(*) AS scenes
       FROM s CROSS JOIN (SELECT unnest([0, 1, 2]) AS seed) CROSS JOIN (SELECT unnest([1, 4]) AS refs) CROSS JOIN (SELECT unnest(['ridge', 'trees']) AS model)
       JOIN documents ON lang = sensor GROUP BY ALL""",
)
def experiment_grid(spark, d):
    per = fx.table(spark, d, "documents").where("lang is not null").groupBy(F.col("lang").alias("sensor")).agg(F.count("*").alias("scenes"))
    return J.experiment_grid(per, {"seed": [0, 1, 2], "refs": [1, 4], "model": ["ridge", "trees"]})


@query(
    "granule_metadata_lookup",
    """WITH m AS (SELECT o_custkey AS g, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS sun FROM orders GROUP BY ALL),
      q AS (SELECT DISTINCT o_custkey AS g, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT g, day, sun FROM q LEFT JOIN m USING (g, day)""",
)
def granule_metadata_lookup(spark, d):
    o = fx.table(spark, d, "orders")
    m = o.groupBy(F.col("o_custkey").alias("g"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("sun"))
    q = fx.catalogue_a(spark, d).select(F.col("granule").alias("g"), "day").distinct()
    return J.granule_metadata_lookup(q, m, ["g"], "day", ["sun"])
