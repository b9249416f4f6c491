"""Rankings, top-k and set operations over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import ranks as R
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.registry import query


@query(
    "best_per_date",
    """SELECT user_id AS site, CAST(ts AS DATE) AS day, event_id, score FROM
      (SELECT *, CASE WHEN event_id % 9 > 0 THEN round(value) END AS score FROM events)
      QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY coalesce(score, 0) DESC, coalesce(CAST(regexp_extract(props, ': ([0-9]+)', 1) AS INT), 0) DESC, event_id) = 1""",
)
def best_per_date(spark, d):
    t = fx.plumes_b(spark, d).select(
        F.col("granule").alias("site"),
        F.to_date("ts").alias("day"),
        F.col("plume_id").alias("event_id"),
        F.when(F.col("plume_id") % 9 > 0, F.round("flux")).alias("score"),
        F.col("k").cast("double").alias("coverage"),
    )
    return R.best_per_date(t, "site", "day", "score", "coverage", "event_id").drop("coverage")


@query(
    "top_n_references",
    f"""WITH {fx.TARGETS}, p AS (SELECT *, CASE WHEN difference > 0.8 THEN NULL WHEN cloud <= 0.3 THEN 0 WHEN cloud <= 0.6 THEN 1 END AS pass FROM candidates)
    SELECT site, candidate, pass, row_number() OVER (PARTITION BY site ORDER BY pass, difference, candidate) AS rank FROM p WHERE pass IS NOT NULL
    QUALIFY rank <= 3""",
)
def top_n_references(spark, d):
    c = fx.candidates(spark, d).select("site", "candidate", "cloud", "difference")
    top = R.top_n_references(
        c, "site", "difference", "cloud", "difference", "candidate", cloud_max=0.3, cloud_relaxed=0.6, methane_max=0.8
    )
    return top.select("site", "candidate", "pass", F.col("rank").cast("bigint").alias("rank"))


def _pairs(spark, d):
    """Targets with the candidates of their site, one target per site."""
    t = fx.targets(spark, d).groupBy("site").agg(F.max("day").alias("target_day"))
    return fx.candidates(spark, d).join(t, "site").select("site", "target_day", "day", "candidate", "cloud")


PAIRS = f"""WITH {fx.TARGETS}, t AS (SELECT site, max(day) AS target_day FROM targets GROUP BY site),
  p AS (SELECT site, target_day, day, candidate, cloud FROM candidates JOIN t USING (site))"""


@query(
    "fill_short_list",
    PAIRS
    + """, b AS (SELECT *, cloud <= 0.2 AS passed, 1 - cloud AS clear FROM p
        QUALIFY row_number() OVER (PARTITION BY site, day ORDER BY (cloud <= 0.2) DESC, cloud, candidate) = 1),
      c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY site ORDER BY passed DESC,
        CASE WHEN passed THEN year(target_day) - year(day) END, CASE WHEN NOT passed THEN -clear END, day DESC, candidate) <= 4)
    SELECT site, target_day, day, candidate, passed, row_number() OVER (PARTITION BY site ORDER BY year(target_day) - year(day), day DESC, candidate) AS slot FROM c""",
)
def fill_short_list(spark, d):
    out = R.fill_short_list(
        _pairs(spark, d), "site", "target_day", "day", F.col("cloud") <= 0.2, 1 - F.col("cloud"), "candidate", 4
    )
    return out.drop("cloud").withColumn("slot", F.col("slot").cast("bigint"))


@query(
    "season_order",
    PAIRS + """ SELECT site, candidate, row_number() OVER (PARTITION BY site ORDER BY year(target_day) - year(day), day DESC, candidate) AS rank FROM p QUALIFY rank <= 5""",
)
def season_order(spark, d):
    order = R.season_order(F.col("day"), F.col("target_day"))
    return R.head_per_group(_pairs(spark, d), ["site"], [*order, F.col("candidate")], 5, "rank").select(
        "site", "candidate", F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "head_per_group",
    """SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 20""",
)
def head_per_group(spark, d):
    t = fx.table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    top = R.head_per_group(t, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 20)
    return top.drop("o_totalprice")


@query(
    "slot_number",
    """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS slot FROM orders QUALIFY slot <= 4""",
)
def slot_number(spark, d):
    t = fx.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    top = R.head_per_group(t, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], 4, "slot")
    return top.select("o_custkey", "o_orderkey", F.col("slot").cast("bigint").alias("slot"))


@query(
    "zscore_per_sample",
    f"""WITH {fx.PIXELS}, s AS (SELECT scene, band, avg(value) FILTER (mask = 0) AS m, stddev_pop(value) FILTER (mask = 0) AS s FROM pixels GROUP BY ALL)
    SELECT scene, row, col, band, round((value - m) / CASE WHEN s < 1e-12 THEN 1 ELSE s END, 6) AS z FROM pixels JOIN s USING (scene, band)""",
)
def zscore_per_sample(spark, d):
    p = fx.pixels(spark, d)
    z = R.zscore_per_sample(p, ["scene", "band"], "value", F.col("mask") == 0, "z")
    return z.select("scene", "row", "col", "band", F.round("z", 6).alias("z"))


@query(
    "visible_ratio_norm",
    f"""WITH {fx.PIXELS}, m AS (SELECT scene, avg(value) AS m FROM pixels WHERE band < 4 GROUP BY scene)
    SELECT scene, row, col, band, round(value / m, 6) AS ratio FROM pixels JOIN m USING (scene)""",
)
def visible_ratio_norm(spark, d):
    z = R.visible_ratio_norm(fx.pixels(spark, d), "scene", "value", F.col("band") < 4, "ratio")
    return z.select("scene", "row", "col", "band", F.round("ratio", 6).alias("ratio"))


@query(
    "mass_budget_threshold",
    f"""WITH {fx.VOXELS}, m AS (SELECT volume, row, col, sum(ppb) AS v FROM voxels GROUP BY ALL),
      c AS (SELECT volume, v, sum(v) OVER (PARTITION BY volume ORDER BY v) AS c, sum(v) OVER (PARTITION BY volume) AS t FROM m WHERE v > 0)
    SELECT volume, round(least(0.5 * max(v), min(CASE WHEN c > 0.05 * t THEN v END)), 6) AS threshold FROM c GROUP BY volume""",
)
def mass_budget_threshold(spark, d):
    m = fx.voxels(spark, d).groupBy("volume", "row", "col").agg(F.sum("ppb").alias("v"))
    return rounded(R.mass_budget_threshold(m, ["volume"], "v", budget=0.05, cap=0.5))


@query(
    "edge_slope",
    f"""WITH {fx.VOXELS}, p AS (SELECT volume, col, max(ppb) AS px FROM voxels GROUP BY ALL)
    SELECT volume, round(regr_slope(ln(greatest(px, 1e-3)), col), 8) AS slope FROM p WHERE col BETWEEN 10 AND 39 GROUP BY volume""",
)
def edge_slope(spark, d):
    p = fx.voxels(spark, d).groupBy("volume", "col").agg(F.max("ppb").alias("px"))
    return rounded(R.edge_slope(p, ["volume"], "col", "px", 10, 39), 8)


HEIGHTS = """h AS (SELECT s_suppkey AS volume, [CAST(s_suppkey % 5 AS DOUBLE), 10.0, 20.0 + s_suppkey % 7, 24.0, 40.0] AS z FROM supplier)"""


def _heights(spark, d):
    k = F.col("s_suppkey")
    z = F.array(*[x.cast("double") for x in (k % 5, F.lit(10), 20 + k % 7, F.lit(24), F.lit(40))])
    return fx.table(spark, d, "supplier").select(k.alias("volume"), z.alias("z"))


@query(
    "strictly_increasing_check",
    f"WITH {HEIGHTS} SELECT volume, z[1] < z[2] AND z[2] < z[3] AND z[3] < z[4] AND z[4] < z[5] AS increasing FROM h",
)
def strictly_increasing_check(spark, d):
    return _heights(spark, d).select("volume", R.strictly_increasing(F.col("z")).alias("increasing"))


@query(
    "midpoint_levels",
    f"WITH {HEIGHTS} SELECT volume, [(z[1]+z[2])/2, (z[2]+z[3])/2, (z[3]+z[4])/2, (z[4]+z[5])/2] AS mid FROM h",
)
def midpoint_levels(spark, d):
    return _heights(spark, d).select("volume", R.midpoints(F.col("z")).alias("mid"))


@query(
    "patience_early_stop",
    """WITH RECURSIVE r AS (SELECT l_suppkey AS run, CAST(l_quantity AS INT) AS it, avg(l_discount) AS a FROM lineitem GROUP BY ALL), s AS (SELECT run, it, a + it / 20000.0 :: DOUBLE AS ap FROM r),
      o AS (SELECT run, it, ap, row_number() OVER (PARTITION BY run ORDER BY it) AS i FROM s),
      f AS (SELECT run, i, it AS last, ap AS best, it AS stage, 0 AS idle FROM o WHERE i = 1
        UNION ALL SELECT f.run, o.i, o.it, CASE WHEN o.ap > f.best + 0.001 THEN o.ap ELSE f.best END,
          CASE WHEN o.ap > f.best + 0.001 THEN o.it ELSE f.stage END, CASE WHEN o.ap > f.best + 0.001 THEN 0 ELSE f.idle + 1 END
        FROM f JOIN o ON o.run = f.run AND o.i = f.i + 1 WHERE f.idle < 6)
    SELECT run, round(best, 8) AS best, stage :: BIGINT AS stage, last :: BIGINT AS last FROM f QUALIFY row_number() OVER (PARTITION BY run ORDER BY i DESC) = 1""",
)
def patience_early_stop(spark, d):
    q = F.col("l_quantity").cast("int")
    s = (
        fx.table(spark, d, "lineitem")
        .groupBy(F.col("l_suppkey").alias("run"), q.alias("it"))
        .agg(F.avg("l_discount").alias("a"))
        .select("run", "it", (F.col("a") + F.col("it") / 20000.0).alias("ap"))
    )
    return rounded(R.patience_early_stop(s, ["run"], "it", "ap", 6, 0.001, 300), 8)


SNAPS = """snaps AS (SELECT DISTINCT l_orderkey AS run, CAST(l_quantity AS INT) AS snap FROM lineitem)"""


@query(
    "choose_spaced_trio",
    f"""WITH {SNAPS}, t AS (SELECT a.run, [a.snap, b.snap, c.snap] AS s FROM snaps a JOIN snaps b ON a.run = b.run AND b.snap - a.snap >= 16
        JOIN snaps c ON c.run = b.run AND c.snap - b.snap >= 16
        QUALIFY row_number() OVER (PARTITION BY a.run ORDER BY abs(a.snap - 8) + abs(b.snap - 25) + abs(c.snap - 42), a.snap, b.snap, c.snap) = 1),
      p AS (SELECT a.run, [a.snap, b.snap] AS s FROM snaps a JOIN snaps b ON a.run = b.run AND b.snap - a.snap >= 16
        QUALIFY row_number() OVER (PARTITION BY a.run ORDER BY abs(a.snap - 8) + abs(b.snap - 42), a.snap, b.snap) = 1),
      o AS (SELECT run, [snap] AS s FROM snaps QUALIFY row_number() OVER (PARTITION BY run ORDER BY abs(snap - 25), snap) = 1)
    SELECT run, unnest(coalesce(t.s, p.s, o.s)) AS snap FROM o LEFT JOIN t USING (run) LEFT JOIN p USING (run)""",
)
def choose_spaced_trio(spark, d):
    t = (
        fx.table(spark, d, "lineitem")
        .select(F.col("l_orderkey").alias("run"), F.col("l_quantity").cast("int").alias("snap"))
    )
    return R.choose_spaced_trio(t, ["run"], "snap", (8, 25, 42), 16)


@query("order_table", "SELECT c_nationkey, c_mktsegment, c_custkey FROM customer ORDER BY ALL")
def order_table(spark, d):
    return fx.table(spark, d, "customer").select("c_nationkey", "c_mktsegment", "c_custkey").orderBy(
        "c_nationkey", "c_mktsegment", "c_custkey"
    )


@query("argmax_row", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def argmax_row(spark, d):
    return R.argmax_row(fx.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query(
    "topk_union_rank",
    """WITH a AS (SELECT l_suppkey AS id FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10),
      b AS (SELECT l_suppkey AS id FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)
    SELECT id, id IN (SELECT id FROM a) AS in_a, id IN (SELECT id FROM b) AS in_b FROM (SELECT id FROM a UNION SELECT id FROM b)""",
)
def topk_union_rank(spark, d):
    t = fx.table(spark, d, "lineitem")
    side = lambda f: t.where(F.col("l_returnflag") == f).groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("n"))
    return R.topk_union(side("A"), side("R"), "id", "n", 10)


@query("sample_limit", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 25")
def sample_limit(spark, d):
    return fx.table(spark, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(25)


@query(
    "nearest_row",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY abs(o_totalprice - 250000), o_orderkey LIMIT 1",
)
def nearest_row(spark, d):
    return R.nearest_row(fx.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 250000.0, "o_orderkey")


@query(
    "key_sets",
    """WITH a AS (SELECT DISTINCT o_custkey AS g FROM orders WHERE o_totalprice > 400000), b AS (SELECT DISTINCT user_id AS g FROM events)
    SELECT (SELECT count(*) FROM (SELECT g FROM a INTERSECT SELECT g FROM b)) AS both,
      (SELECT count(*) FROM (SELECT g FROM a EXCEPT SELECT g FROM b)) AS only_a,
      (SELECT count(*) FROM (SELECT g FROM b EXCEPT SELECT g FROM a)) AS only_b""",
)
def key_sets(spark, d):
    a = fx.table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("g"))
    b = fx.table(spark, d, "events").select(F.col("user_id").alias("g"))
    return R.key_sets(a, b, "g")


@query(
    "symmetric_difference",
    """WITH a AS (SELECT l_suppkey AS k, l_partkey AS p FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT l_suppkey AS k, l_partkey AS p FROM lineitem WHERE l_returnflag = 'R')
    (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def symmetric_difference(spark, d):
    t = fx.table(spark, d, "lineitem")
    side = lambda f: t.where(F.col("l_returnflag") == f).select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("p"))
    return R.symmetric_difference(side("A"), side("R"))


@query(
    "union_all_by_name",
    """SELECT c_custkey AS id, c_acctbal AS flux, c_mktsegment AS kind FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union_all_by_name(spark, d):
    c = fx.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"), F.col("c_acctbal").alias("flux")
    )
    s = fx.table(spark, d, "supplier").select(F.col("s_acctbal").alias("flux"), F.col("s_suppkey").alias("id"))
    return R.union_all([c, s])


@query(
    "union_distinct_windows",
    """SELECT p_partkey, list_distinct([p_size % 4, p_size % 3] || [p_size % 2, p_size % 5]) .list_sort() AS w FROM part""",
)
def union_distinct_windows(spark, d):
    s = F.col("p_size")
    a = F.array(s % 4, s % 3)
    b = F.array(s % 2, s % 5)
    return fx.table(spark, d, "part").select("p_partkey", F.array_sort(R.merge_window_lists(a, b)).alias("w"))


@query(
    "seen_unseen_split",
    f"""WITH {fx.SCORES} SELECT id, site, site IN (SELECT site FROM scores WHERE y2 = 1) AS seen FROM scores WHERE y2 = 0""",
)
def seen_unseen_split(spark, d):
    s = fx.scores(spark, d)
    return R.seen_flag(s.where("y2 = 0").select("id", "site"), s.where("y2 = 1"), "site")
