"""Selection, components, splits and sampling over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import select as S
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.registry import query
from plumeline.session import settled

DRAW = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"


def _links(spark, d):
    return fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("scene"), F.col("o_custkey").alias("source"))


def _components(links):
    edges = links.select(
        F.concat(F.lit("g:"), F.col("scene")).alias("src"), F.concat(F.lit("s:"), F.col("source")).alias("dst")
    )
    return S.components_from_forests(edges)


@query(
    "connected_components",
    """WITH RECURSIVE e AS (SELECT DISTINCT 'g:' || l_orderkey AS a, 's:' || l_partkey AS b FROM lineitem),
      u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e),
      r AS (SELECT DISTINCT a AS node, a AS low FROM u
        UNION ALL SELECT node, low FROM (SELECT *, bool_or(low <> was) OVER () AS moved
          FROM (SELECT u.a AS node, min(r.low) AS low, min(CASE WHEN u.a = u.b THEN r.low END) AS was FROM r JOIN u ON u.b = r.node GROUP BY u.a)) WHERE moved)
    SELECT node, min(low) AS component FROM r GROUP BY node""",
)
def connected_components(spark, d):
    # Every line item links its order to its part.
    t = fx.table(spark, d, "lineitem")
    return _components(t.select(F.col("l_orderkey").alias("scene"), F.col("l_partkey").alias("source")))


SELECT_TARGETS = {
    "flux_bin": {"has_weak": 2000.0, "strong_only": 4000.0},
    "year": {str(y): 900.0 for y in range(1995, 2001)},
    "region": {"AFRICA": 1000.0, "AMERICA": 1500.0, "ASIA": 1500.0, "EUROPE": 1500.0, "MIDDLE EAST": 500.0},
    "sector": {"1-URGENT": 2500.0, "2-HIGH": 2000.0, "3-MEDIUM": 900.0, "5-LOW": 600.0},
}


@query("balanced_select")
def balanced_select(spark, d):
    scenes = fx.scenes(spark, d)
    out = S.balanced_select(scenes, 6000, "scene", SELECT_TARGETS)
    return out.select("scene", "flux_bin", "year", "region", "sector", "n_plumes")


def _splits(spark, d):
    comp = _components(_links(spark, d)).where("node like 'g:%'").select(
        F.substring("node", 3, 20).cast("bigint").alias("scene"), "component"
    )
    columns = ["scene", *S.AXES, "n_weak", "n_strong", "component"]
    # Read several times, so written once.
    scenes = settled(fx.scenes(spark, d).join(comp, "scene").select(*columns))
    return scenes.join(S.assign_split_by_component(scenes, "component"), "component")


@query("assign_split_by_component")
def assign_split_by_component(spark, d):
    return _splits(spark, d).select("scene", "component", "split")


@query(
    "add_free_granules",
    """WITH s AS (SELECT c_custkey AS granule, CASE c_custkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split FROM customer WHERE c_acctbal > 0),
      f AS (SELECT c_custkey AS granule, row_number() OVER (ORDER BY c_custkey) AS n FROM customer WHERE c_acctbal <= 0 AND c_custkey NOT IN (SELECT user_id FROM events))
    SELECT granule, split, false AS is_free FROM s UNION ALL SELECT granule, CASE WHEN n <= 13 THEN 'train' WHEN n <= 17 THEN 'val' WHEN n <= 21 THEN 'test' END, true FROM f""",
)
def add_free_granules(spark, d):
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("granule"), "c_acctbal")
    names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    splits = c.where("c_acctbal > 0").select("granule", F.get(names, (F.col("granule") % 3).cast("int")).alias("split"))
    gone = fx.table(spark, d, "events").select(F.col("user_id").alias("granule"))
    return S.add_free_granules(splits, c.where("c_acctbal <= 0"), gone, "granule")


@query("assign_sites_6020")
def assign_sites_6020(spark, d):
    sizes = fx.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("site")).agg(F.count("*").alias("n"))
    return S.assign_sites(sizes, "site", "n", seed=7)


@query(
    "leak_check",
    """SELECT l_orderkey AS source, count(DISTINCT l_returnflag) AS splits FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1""",
)
def leak_check(spark, d):
    t = fx.table(spark, d, "lineitem")
    return S.leak_check(t.select(F.col("l_orderkey").alias("source"), F.col("l_returnflag").alias("split")), "source", "split")


@query(
    "sample_per_split",
    f"""SELECT o_orderpriority AS split, o_orderkey AS id FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY {DRAW.format("o_orderkey || '-11'")}, o_orderkey) <= 500""",
)
def sample_per_split(spark, d):
    t = fx.table(spark, d, "orders").select(F.col("o_orderpriority").alias("split"), F.col("o_orderkey").alias("id"))
    return S.sample_per_group(t, ["split"], "id", 500, 11)


@query(
    "balanced_pixel_draw",
    f"""WITH {fx.SPECTRA}, p AS (SELECT scene, row * 1000 + col AS pixel, mask FROM spectra), c AS (SELECT scene, sum(mask) AS np, sum(1 - mask) AS nb FROM p GROUP BY 1),
      q AS (SELECT scene, CASE WHEN least(np, 30) < 30 THEN least(np, 30) ELSE least(np, 60 - least(nb, 30)) END AS qp,
        CASE WHEN least(nb, 30) < 30 THEN least(nb, 30) ELSE least(nb, 60 - least(np, 30)) END AS qb FROM c)
    SELECT scene, pixel, mask AS y FROM p JOIN q USING (scene) QUALIFY row_number() OVER (PARTITION BY scene, mask ORDER BY {DRAW.format("scene || '-' || pixel || '-5'")}, pixel) <= CASE WHEN mask = 1 THEN qp ELSE qb END""",
)
def balanced_pixel_draw(spark, d):
    p = fx.spectra(spark, d).select("scene", (F.col("row") * 1000 + F.col("col")).alias("pixel"), "mask")
    return S.balanced_pixel_draw(p, "scene", "mask", "pixel", 30, 5).select("scene", "pixel", "y")


@query(
    "cluster_bootstrap",
    f"""WITH {fx.SCORES}, dl AS (SELECT site, score - 7 - y * 0.2 AS delta FROM scores), su AS (SELECT site, sum(delta) AS s, count(*) AS k FROM dl GROUP BY 1),
      ix AS (SELECT row_number() OVER (ORDER BY {DRAW.format('site')}, site) - 1 AS i, s, k FROM su), n AS (SELECT count(*) AS n FROM su),
      pk AS (SELECT b, {DRAW.format("b || '-' || x || '-3'")} % n AS i FROM n, range(2000) t(b), range(1000) u(x) WHERE x < n),
      m AS (SELECT b, sum(s) / sum(k) AS m FROM pk JOIN ix USING (i) GROUP BY b)
    SELECT (SELECT round(sum(s) / sum(k), 6) FROM su) AS mean_delta, (SELECT sum(k) :: BIGINT FROM su) AS n_scenes, (SELECT n FROM n) AS n_sites,
      round(quantile_cont(m, 0.025), 6) AS ci_lo, round(quantile_cont(m, 0.975), 6) AS ci_hi, round(avg(CASE WHEN m > 0 THEN 1 ELSE 0 END), 6) AS share_positive FROM m""",
)
def cluster_bootstrap(spark, d):
    s = fx.scores(spark, d).select("site", (F.col("score") - 7 - F.col("y") * F.lit(0.2)).alias("delta"))
    return rounded(S.cluster_bootstrap(s, "site", "delta", seed=3))


@query(
    "random_row_sample",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
       ORDER BY {DRAW.format("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || '-9'")}, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) LIMIT 300""",
)
def random_row_sample(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    t = fx.table(spark, d, "lineitem").select(*keys).distinct().withColumn("id", F.concat_ws("-", *keys))
    return S.random_row_sample(t, "id", 300, 9).drop("id")
