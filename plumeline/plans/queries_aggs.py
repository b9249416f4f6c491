"""Aggregation operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import aggs as G
from plumeline.operators import clean as C
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_scalars import FACET_ARGS, FACETS, facets
from plumeline.plans.registry import query


def rounded(df, digits=6):
    """Doubles rounded so that results do not depend on the order of summation."""
    types = dict(df.dtypes)
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if types[c] == "double" else F.col(f"`{c}`") for c in df.columns])


@query(
    "granule_rollup",
    f"""WITH {fx.PLUMES_A} SELECT granule, count(*) AS n_a, max(flux) AS flux_max_a,
      round(quantile_cont(flux, 0.5), 6) AS flux_med_a, min(country) AS first_country FROM plumes_a GROUP BY granule""",
)
def granule_rollup(spark, d):
    a = fx.plumes_a(spark, d)
    return rounded(G.granule_rollup(a, "granule", "flux", "a", [F.min("country").alias("first_country")]))


@query(
    "conditional_counts",
    f"""WITH {fx.CATALOGUE_A} SELECT source, count(*) FILTER (flux > 0 AND flux < 1000) AS n_weak,
      count(*) FILTER (flux >= 1000) AS n_strong FROM catalogue_a GROUP BY source""",
)
def conditional_counts(spark, d):
    weak, strong = G.class_counts(F.col("flux"))
    return fx.catalogue_a(spark, d).groupBy("source").agg(weak.alias("n_weak"), strong.alias("n_strong"))


@query(
    "distinct_count",
    """SELECT l_orderkey AS granule, count(DISTINCT l_suppkey) AS n_sources FROM lineitem GROUP BY 1""",
)
def distinct_count(spark, d):
    t = fx.table(spark, d, "lineitem")
    return t.groupBy(F.col("l_orderkey").alias("granule")).agg(F.count_distinct("l_suppkey").alias("n_sources"))


@query(
    "mode_agg",
    """WITH c AS (SELECT o_custkey, CASE WHEN o_totalprice > 60000 THEN o_orderpriority END AS v FROM orders),
      n AS (SELECT o_custkey, v, count(*) AS n FROM c WHERE v IS NOT NULL GROUP BY ALL)
    SELECT k.o_custkey AS granule, coalesce(m.v, 'unknown') AS sector FROM (SELECT DISTINCT o_custkey FROM orders) k
    LEFT JOIN (SELECT o_custkey, v FROM n QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, v) = 1) m USING (o_custkey)""",
)
def mode_agg(spark, d):
    t = fx.table(spark, d, "orders").select(
        F.col("o_custkey").alias("granule"), F.when(F.col("o_totalprice") > 60000, F.col("o_orderpriority")).alias("v")
    )
    return G.mode_agg(t, "granule", "v", "sector")


@query(
    "dominant_category",
    f"""WITH {fx.PLUMES_B}, s AS (SELECT granule, kind, sum(k) AS w, min(plume_id) AS f FROM plumes_b GROUP BY ALL)
    SELECT granule, kind AS sector FROM s QUALIFY row_number() OVER (PARTITION BY granule ORDER BY w DESC, f) = 1""",
)
def dominant_category(spark, d):
    return G.dominant_category(fx.plumes_b(spark, d), "granule", "kind", F.col("k"), F.col("plume_id"), "sector")


@query(
    "null_preserving_sum",
    f"""WITH {fx.CATALOGUE_A} SELECT tile, source, round(sum(flux), 3) AS flux FROM catalogue_a GROUP BY tile, source""",
)
def null_preserving_sum(spark, d):
    return fx.catalogue_a(spark, d, by_tile=True).groupBy("tile", "source").agg(F.round(F.sum("flux"), 3).alias("flux"))


@query(
    "collect_json",
    """WITH s AS (SELECT l_orderkey AS scene, l_suppkey AS source, CAST(max(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL)
    SELECT scene, 0 AS part, '{' || string_agg('"' || source || '":' || q, ',' ORDER BY CAST(source AS VARCHAR)) || '}' AS fluxes FROM s GROUP BY scene""",
)
def collect_json(spark, d):
    s = (
        fx.table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("scene"), F.col("l_suppkey").alias("source"))
        .agg(F.max("l_quantity").cast("bigint").alias("q"))
    )
    return G.collect_json(s, "scene", "source", "q", "fluxes")


@query(
    "explode_map_values",
    """SELECT event_id, 'k' AS name, CAST(regexp_extract(props, ': ([0-9]+)', 1) AS DOUBLE) AS value FROM events""",
)
def explode_map_values(spark, d):
    return G.explode_map_values(fx.table(spark, d, "events").select("event_id", "props"), "props")


@query(
    "collection_totals",
    """SELECT count(DISTINCT source) AS collections, count(*) AS samples, sum(n_chars) :: BIGINT AS size FROM documents""",
)
def collection_totals(spark, d):
    per = fx.table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("s"))
    return per.agg(
        F.count("source").alias("collections"), F.sum("n").alias("samples"), F.sum("s").alias("size")
    )


@query(
    "value_counts",
    """SELECT p_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM part GROUP BY p_type""",
)
def value_counts(spark, d):
    return rounded(G.value_counts(fx.table(spark, d, "part"), "p_type"))


AXES = [
    ["flux_bin", "year"],
    ["flux_bin", "region"],
    ["flux_bin", "year", "region"],
    ["flux_bin", "year", "sector"],
    ["flux_bin", "year", "region", "sector"],
]


def _occupancy_sql():
    parts = [
        f"SELECT '{' x '.join(a)}' AS axes, count(*) AS n FROM scenes GROUP BY {', '.join(a)}" for a in AXES
    ]
    return f"""WITH {fx.SCENES}, cells AS ({' UNION ALL '.join(parts)}),
      base AS (SELECT axes, count(*) AS cells, min(n) AS min_n, quantile_cont(n, 0.5) AS median_n, max(n) AS max_n FROM cells GROUP BY axes)
    SELECT axes, b.cells, min_n, median_n, max_n, target, count(*) FILTER (n >= target / b.cells) AS fillable,
      CAST(sum(least(n, ceil(target / b.cells))) AS BIGINT) AS reachable
    FROM base b CROSS JOIN (SELECT unnest([500, 600, 700]) AS target) JOIN cells c USING (axes) GROUP BY ALL"""


@query("strata_occupancy", _occupancy_sql())
def strata_occupancy(spark, d):
    return G.strata_occupancy(fx.scenes(spark, d), AXES, (500, 600, 700))


@query(
    "crosstab",
    """SELECT p_brand, 100.0 * count(*) FILTER (p_type = 'ECONOMY') / count(*) AS "ECONOMY",
      100.0 * count(*) FILTER (p_type = 'PROMO') / count(*) AS "PROMO",
      100.0 * count(*) FILTER (p_type = 'SMALL') / count(*) AS "SMALL" FROM part
      WHERE p_type IN ('ECONOMY', 'PROMO', 'SMALL') GROUP BY p_brand""",
)
def crosstab(spark, d):
    kinds = ["ECONOMY", "PROMO", "SMALL"]
    t = fx.table(spark, d, "part").where(F.col("p_type").isin(*kinds))
    return G.crosstab(t, "p_brand", "p_type", kinds, share=True)


@query(
    "diagonal_agreement",
    """SELECT count(*) AS pairs, round(avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END), 6) AS agreement FROM labels""",
)
def diagonal_agreement(spark, d):
    return rounded(G.diagonal_agreement(fx.table(spark, d, "labels"), "quality", "toxic"))


@query(
    "binned_shares",
    f"""WITH {fx.CATALOGUE_A}, p AS (SELECT * FROM catalogue_a WHERE flux > 0)
    SELECT flag, count(*) AS n, round(100 * avg(CASE WHEN flux < 1000 THEN 1 ELSE 0 END), 6) AS weak,
      round(100 * avg(CASE WHEN flux < 100 THEN 1 ELSE 0 END), 6) AS "0-100",
      round(100 * avg(CASE WHEN flux >= 100 AND flux < 300 THEN 1 ELSE 0 END), 6) AS "100-300",
      round(100 * avg(CASE WHEN flux >= 300 AND flux < 1000 THEN 1 ELSE 0 END), 6) AS "300-1000",
      round(100 * avg(CASE WHEN flux >= 1000 AND flux < 3000 THEN 1 ELSE 0 END), 6) AS "1000-3000",
      round(100 * avg(CASE WHEN flux >= 3000 THEN 1 ELSE 0 END), 6) AS "3000+",
      round(quantile_cont(flux, 0.1), 6) AS p10, round(quantile_cont(flux, 0.25), 6) AS p25,
      round(quantile_cont(flux, 0.5), 6) AS p50, round(quantile_cont(flux, 0.75), 6) AS p75,
      round(quantile_cont(flux, 0.9), 6) AS p90 FROM p GROUP BY flag""",
)
def binned_shares(spark, d):
    return rounded(G.binned_shares(fx.catalogue_a(spark, d), "flag", "flux"))


@query(
    "topn_with_other",
    """WITH c AS (SELECT o_orderstatus AS population, n_name AS country, count(*) AS n FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
     top AS (SELECT country FROM c WHERE population = 'F' ORDER BY n DESC, country LIMIT 5),
     r AS (SELECT population, CASE WHEN country IN (SELECT country FROM top) THEN country ELSE 'Other' END AS country, sum(n) :: BIGINT AS n FROM c GROUP BY ALL)
    SELECT population, country, n, round(100 * n / sum(n) OVER (PARTITION BY population), 6) AS share FROM r""",
)
def topn_with_other(spark, d):
    t = (
        fx.table(spark, d, "orders")
        .join(fx.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(fx.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("o_orderstatus").alias("population"), F.col("n_name").alias("country"))
    )
    return rounded(G.topn_with_other(t, "population", "country", "F", 5))


@query(
    "funnel_counts",
    f"""WITH {fx.CATALOGUE_A} SELECT 0 AS step, 'all' AS level, count(*) AS plumes, count(DISTINCT granule) AS granules FROM catalogue_a
    UNION ALL SELECT 1, 'quantified', count(*), count(DISTINCT granule) FROM catalogue_a WHERE flux > 0
    UNION ALL SELECT 2, 'strong', count(*), count(DISTINCT granule) FROM catalogue_a WHERE flux >= 9000""",
)
def funnel_counts(spark, d):
    a = fx.catalogue_a(spark, d).select("granule", "flux")
    levels = {"all": a, "quantified": a.where("flux > 0"), "strong": a.where("flux >= 9000")}
    return G.funnel_counts(levels, "granule")


@query(
    "mean_sd_over_seeds",
    """SELECT l_returnflag, l_linenumber, round(avg(l_discount), 4) AS mean, round(stddev_samp(l_discount), 4) AS sd FROM lineitem GROUP BY ALL""",
)
def mean_sd_over_seeds(spark, d):
    return G.mean_sd(fx.table(spark, d, "lineitem"), ["l_returnflag", "l_linenumber"], "l_discount")


@query(
    "group_quantiles",
    """SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.9), 6) AS q90 FROM events GROUP BY 1""",
)
def group_quantiles(spark, d):
    t = fx.table(spark, d, "events")
    marks = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q90": 0.9}
    return rounded(G.spread.summary(t, ["event_type"], [F.count("*").alias("n")], "value", marks))


@query(
    "ecdf",
    """SELECT DISTINCT event_type, value, round(cume_dist() OVER (PARTITION BY event_type ORDER BY value), 8) AS fraction FROM events""",
)
def ecdf(spark, d):
    return rounded(G.ecdf(fx.table(spark, d, "events"), ["event_type"], "value"), 8)


@query(
    "scene_min_flag_share",
    f"""WITH {fx.CATALOGUE_A}, m AS (SELECT year(tile_day) AS year, tile, min(flux) AS m FROM catalogue_a GROUP BY ALL)
    SELECT year, round(avg(CASE WHEN m < 1000 THEN 1.0 WHEN m IS NOT NULL THEN 0.0 END), 6) AS share, count(m) AS scenes FROM m GROUP BY year""",
)
def scene_min_flag_share(spark, d):
    a = fx.catalogue_a(spark, d).select(F.year("tile_day").cast("bigint").alias("year"), "tile", "flux")
    return rounded(G.scene_min_flag_share(a, "year", "tile", "flux", 1000.0))


@query(
    "circular_stats",
    f"""WITH {fx.PLUMES_B}, {fx.WIND}, g AS (SELECT granule, avg(sin(radians(direction))) AS s, avg(cos(radians(direction))) AS c FROM wind GROUP BY 1)
    SELECT granule, round(sqrt(s*s + c*c), 6) AS resultant, round((degrees(atan2(s, c)) + 360) % 360, 4) AS mean_direction,
      round(degrees(sqrt(-2 * ln(sqrt(s*s + c*c)))), 4) AS circular_sd FROM g""",
)
def circular_stats(spark, d):
    g = G.circular_stats(fx.wind(spark, d), ["granule"], "direction")
    return g.select(
        "granule",
        F.round("resultant", 6).alias("resultant"),
        F.round("mean_direction", 4).alias("mean_direction"),
        F.round("circular_sd", 4).alias("circular_sd"),
    )


FILLED = """filled AS (SELECT l_suppkey AS scene, l_linenumber AS band, l_quantity, CASE WHEN l_discount = 0 THEN -9999.0 WHEN l_discount = 0.01 THEN -9995.0
  WHEN l_discount = 0.02 THEN 'NaN' :: DOUBLE ELSE l_extendedprice END AS value FROM lineitem)"""


def filled(spark, d):
    disc = F.col("l_discount")
    value = (
        F.when(disc == 0, -9999.0)
        .when(disc == 0.01, -9995.0)
        .when(disc == 0.02, float("nan"))
        .otherwise(F.col("l_extendedprice"))
    )
    return fx.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("scene"), F.col("l_linenumber").alias("band"), "l_quantity", value.alias("value")
    )


@query(
    "nodata_percent",
    f"""WITH {FILLED} SELECT scene, round(100 * avg(CASE WHEN isnan(value) OR value <= -9990 THEN 1 ELSE 0 END), 6) AS nodata_pct FROM filled GROUP BY scene""",
)
def nodata_percent(spark, d):
    return rounded(G.nodata_percent(filled(spark, d), "scene", "value"))


@query(
    "nodata_summary",
    f"""WITH {FILLED}, p AS (SELECT scene, band, 100 * avg(CASE WHEN isnan(value) OR value <= -9990 THEN 1 ELSE 0 END) - 22 AS p FROM filled GROUP BY ALL)
    SELECT count(*) AS granules, count(*) FILTER (p <= 0) AS le_0, count(*) FILTER (p <= 5) AS le_5, count(*) FILTER (p <= 25) AS le_25 FROM p""",
)
def nodata_summary(spark, d):
    cell = filled(spark, d).withColumn("cell", F.struct("scene", "band"))
    pct = G.nodata_percent(cell, "cell", "value").withColumn("nodata_pct", F.col("nodata_pct") - 22)
    return G.nodata_summary(pct, "nodata_pct")


@query(
    "cube_min_max",
    f"""WITH {FILLED} SELECT scene, min(value) FILTER (NOT isnan(value) AND value > -9990) AS min,
      max(value) FILTER (NOT isnan(value) AND value > -9990) AS max FROM filled GROUP BY scene""",
)
def cube_min_max(spark, d):
    return G.valid_min_max(filled(spark, d), ["scene"], "value")


@query(
    "obs_means",
    f"""WITH {FILLED}, m AS (SELECT scene, avg(value) FILTER (band = 1 AND NOT isnan(value) AND value > -9990) AS path,
      avg(value) FILTER (band = 2 AND NOT isnan(value) AND value > -9990) / 2000 AS sza, avg(value) FILTER (band = 3 AND NOT isnan(value) AND value > -9990) / 3000 AS vza FROM filled GROUP BY scene)
    SELECT scene, round(path, 4) AS path, round(sza, 6) AS sza, round(vza, 6) AS vza,
      round(1 / cos(radians(sza)) + 1 / cos(radians(vza)), 6) AS amf FROM m""",
)
def obs_means(spark, d):
    from plumeline.functions.angles import air_mass_factor

    m = G.band_means(filled(spark, d), "scene", "band", "value", {1: "path", 2: "sza", 3: "vza"})
    m = m.select("scene", "path", (F.col("sza") / 2000).alias("sza"), (F.col("vza") / 3000).alias("vza"))
    return m.select(
        "scene",
        F.round("path", 4).alias("path"),
        F.round("sza", 6).alias("sza"),
        F.round("vza", 6).alias("vza"),
        F.round(air_mass_factor(F.col("sza"), F.col("vza")), 6).alias("amf"),
    )


@query(
    "scene_bbox",
    f"""WITH {fx.POINTS} SELECT country, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM points GROUP BY country""",
)
def scene_bbox(spark, d):
    return G.scene_bbox(fx.points(spark, d), ["country"], "lon", "lat")


@query(
    "wind_scene_mean",
    f"""WITH {fx.PLUMES_B}, {fx.WIND}, c AS (SELECT granule, -speed * sin(radians(direction)) AS u, -speed * cos(radians(direction)) AS v FROM wind)
    SELECT granule, round(avg(u), 6) AS wind_u, round(avg(v), 6) AS wind_v, round(avg(sqrt(u*u + v*v)), 6) AS wind_speed FROM c GROUP BY granule""",
)
def wind_scene_mean(spark, d):
    from plumeline.functions.angles import wind_u, wind_v

    s, a = F.col("speed"), F.col("direction")
    return rounded(G.wind_scene_mean(fx.wind(spark, d), "granule", wind_u(s, a), wind_v(s, a)))


@query(
    "mask_coverage",
    """SELECT l_suppkey, round(100 * avg(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END), 6) AS coverage_a,
      round(100 * avg(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END), 6) AS coverage_b,
      round(100 * avg(CASE WHEN l_returnflag = 'A' OR l_linestatus = 'O' THEN 1 ELSE 0 END), 6) AS coverage_union FROM lineitem GROUP BY 1""",
)
def mask_coverage(spark, d):
    t = fx.table(spark, d, "lineitem")
    return rounded(G.mask_coverage(t, "l_suppkey", F.col("l_returnflag") == "A", F.col("l_linestatus") == "O"))


@query(
    "pixels_per_code",
    f"""WITH {fx.MASKS} SELECT scene, side, plume, count(*) AS pixels FROM masks GROUP BY ALL""",
)
def pixels_per_code(spark, d):
    return fx.masks(spark, d).groupBy("scene", "side", "plume").agg(F.count("*").alias("pixels"))


@query(
    "bbox_per_instance",
    f"""WITH {fx.MASKS} SELECT scene, plume, min(row) AS row0, min(col) AS col0, max(row) AS row1, max(col) AS col1, count(*) AS pixels
      FROM masks WHERE side = 'a' GROUP BY scene, plume""",
)
def bbox_per_instance(spark, d):
    """Through the bit encoding: one bit per plume and pixel, decoded before the boxes are taken."""
    bits = (
        fx.masks(spark, d)
        .where("side = 'a'")
        .groupBy("scene", "row", "col")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(plume - 1 as int))")).alias("mask"))
    )
    long = bits.select("scene", "row", "col", F.explode(G.bits_set(F.col("mask"))).alias("plume"))
    return G.bbox_per_instance(long, ["scene", "plume"])


@query(
    "band_stats",
    """WITH v AS (SELECT p_brand AS sample, p_size % 4 AS band, CASE WHEN p_size % 10 > 0 THEN p_retailprice END AS x FROM part)
    SELECT sample, band, coalesce(min(x), 0) AS min, coalesce(max(x), 0) AS max, coalesce(round(avg(x), 6), 0) AS mean, coalesce(round(stddev_pop(x), 6), 0) AS sd,
      round(100 * count(x) / count(*), 6) AS valid, coalesce(round(quantile_cont(x, 0.25), 6), 0) AS p25, coalesce(round(quantile_cont(x, 0.5), 6), 0) AS p50,
      coalesce(round(quantile_cont(x, 0.75), 6), 0) AS p75, coalesce(round(quantile_cont(x, 0.95), 6), 0) AS p95 FROM v GROUP BY ALL""",
)
def band_stats(spark, d):
    t = fx.table(spark, d, "part").select(
        F.col("p_brand").alias("sample"),
        (F.col("p_size") % 4).alias("band"),
        F.when(F.col("p_size") % 10 > 0, F.col("p_retailprice")).otherwise(0.0).alias("x"),
    )
    return rounded(G.band_stats(t, ["sample", "band"], "x"))


@query(
    "histogram_percentiles",
    """WITH e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
     b AS (SELECT event_type, lo, hi, least(99, floor((value - lo) / ((hi - lo) / 100))) AS b, count(*) AS n FROM events JOIN e USING (event_type) GROUP BY ALL),
     c AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY b) AS c, sum(n) OVER (PARTITION BY event_type) AS t FROM b)
    SELECT event_type, round(min(CASE WHEN c >= 0.25 * t THEN lo + (b + 0.5) * (hi - lo) / 100 END), 6) AS p25,
      round(min(CASE WHEN c >= 0.5 * t THEN lo + (b + 0.5) * (hi - lo) / 100 END), 6) AS p50,
      round(min(CASE WHEN c >= 0.95 * t THEN lo + (b + 0.5) * (hi - lo) / 100 END), 6) AS p95 FROM c GROUP BY 1""",
)
def histogram_percentiles(spark, d):
    t = fx.table(spark, d, "events").select("event_type", "value")
    return rounded(G.histogram_percentiles(t, ["event_type"], "value", {"p25": 0.25, "p50": 0.5, "p95": 0.95}))


@query(
    "cohort_extent",
    f"""WITH {fx.POINTS}, o AS (SELECT p.*, o_orderdate AS t FROM points p JOIN orders ON o_custkey = id)
    SELECT country, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north, min(t) AS first_time, max(t) AS last_time, count(*) AS n
    FROM o GROUP BY GROUPING SETS ((country), ())""",
)
def cohort_extent(spark, d):
    o = fx.table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("t"))
    return G.cohort_extent(fx.points(spark, d).join(o, "id"), ["country"], "lon", "lat", "t")


@query(
    "facet_counts",
    f"""WITH {FACETS}, b AS (SELECT *, (sensor <> 'imaging' OR system IN ('1-URGENT', '2-HIGH')) AS f_sys,
        (sensor <> 'imaging' OR match IS NULL OR match = 'pair') AS f_match,
        sensor IN ('imaging', 's2') AND CAST(substr(date, 1, 4) AS INT) BETWEEN 1996 AND 1999 AND coalesce(flux, 0) >= 500 AS base FROM facets)
    SELECT 'system' AS facet, system AS value, count(*) FILTER (base AND f_match) AS n FROM b GROUP BY system
    UNION ALL SELECT 'match', match, count(*) FILTER (base AND f_sys) FROM b WHERE match IS NOT NULL GROUP BY match""",
)
def facet_counts(spark, d):
    t = facets(spark, d)
    conds = {f: C.faceted_filter(t, **FACET_ARGS, skip=f) for f in ("system", "match")}
    return G.facet_counts(t, conds)


@query(
    "stacked_points",
    """WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS source, c_nationkey, c_nationkey % 5 AS lat FROM customer)
    SELECT coalesce(source, c_nationkey || '/' || lat) AS stack, count(DISTINCT c_custkey) AS n, min(c_custkey) AS first_id FROM p GROUP BY 1""",
)
def stacked_points(spark, d):
    p = fx.table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("source"),
        "c_nationkey",
        (F.col("c_nationkey") % 5).alias("lat"),
    )
    return G.stacked_points(p, F.col("source"), "c_nationkey", "lat", "c_custkey")


@query(
    "distinct_first",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def distinct_first(spark, d):
    t = fx.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return G.first_per_key(t, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "event_vs_plume_counts",
    """WITH e AS (SELECT user_id AS k, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS plumes FROM events GROUP BY 1)
    SELECT sum(events) :: BIGINT AS events, sum(plumes) :: BIGINT AS plumes, count(*) FILTER (plumes < 13) AS tiles_without FROM e""",
)
def event_vs_plume_counts(spark, d):
    e = (
        fx.table(spark, d, "events")
        .groupBy("user_id")
        .agg(F.count("*").alias("e"), F.count_if(F.col("event_type") == "purchase").alias("p"))
    )
    return e.agg(
        F.sum("e").alias("events"), F.sum("p").alias("plumes"), F.count_if(F.col("p") < 13).alias("tiles_without")
    )


@query(
    "flag_mask_contingency",
    """WITH t AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS has FROM lineitem GROUP BY 1)
    SELECT o_orderstatus AS flag, has, count(*) AS n FROM t JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def flag_mask_contingency(spark, d):
    has = F.max(F.when(F.col("l_returnflag") == "A", 1).otherwise(0))
    t = fx.table(spark, d, "lineitem").groupBy("l_orderkey").agg(has.alias("has"))
    o = fx.table(spark, d, "orders")
    return (
        t.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_orderstatus").alias("flag"), "has")
        .agg(F.count("*").alias("n"))
    )


@query(
    "revisit_stats",
    """SELECT l_suppkey AS location, count(DISTINCT CAST(l_shipdate AS DATE)) AS dates, min(CAST(l_shipdate AS DATE)) AS first_day,
       max(CAST(l_shipdate AS DATE)) AS last_day FROM lineitem GROUP BY 1 HAVING count(DISTINCT CAST(l_shipdate AS DATE)) > 1""",
)
def revisit_stats(spark, d):
    t = fx.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("location"), F.to_date("l_shipdate").alias("day"))
    return G.revisit_stats(t, "location", "day")


@query(
    "coverage_report",
    """SELECT count(*) AS keys, count(*) FILTER (a) AS with_a, count(*) FILTER (b) AS with_b, count(*) FILTER (a AND b) AS with_both,
       count(*) FILTER (NOT a) * 1.8 :: DOUBLE AS missing_cost FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS a,
       c_custkey IN (SELECT user_id FROM events) AS b FROM customer)""",
)
def coverage_report(spark, d):
    have_a = fx.table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("a")).distinct()
    have_b = fx.table(spark, d, "events").select(F.col("user_id").alias("c_custkey"), F.lit(True).alias("b")).distinct()
    keys = fx.table(spark, d, "customer").select("c_custkey").join(have_a, "c_custkey", "left").join(have_b, "c_custkey", "left")
    no = F.lit(False)
    return G.coverage_report(keys, F.coalesce("a", no), F.coalesce("b", no), 1.8)


@query(
    "split_site_report",
    f"""WITH {fx.CATALOGUE_A}, t AS (SELECT tile, source AS site, flag AS split, min(flux) AS lo, max(flux) AS hi FROM catalogue_a GROUP BY ALL)
    SELECT site, split, count(*) AS scenes, count(*) FILTER (lo < 1000) AS weak_scenes, min(lo) AS flux_min, max(hi) AS flux_max FROM t GROUP BY ALL""",
)
def split_site_report(spark, d):
    t = (
        fx.catalogue_a(spark, d, by_tile=True)
        .groupBy("tile", F.col("source").alias("site"), F.col("flag").alias("split"))
        .agg(F.min("flux").alias("lo"), F.max("flux").alias("hi"))
    )
    return t.groupBy("site", "split").agg(
        F.count("*").alias("scenes"),
        F.count_if(F.col("lo") < 1000).alias("weak_scenes"),
        F.min("lo").alias("flux_min"),
        F.max("hi").alias("flux_max"),
    )


@query(
    "median_matrix",
    """SELECT l_linenumber AS i, CAST(l_quantity % 5 AS INTEGER) AS j, round(quantile_cont(CASE WHEN l_tax > 0 THEN l_discount / l_tax END, 0.5), 6) AS median
       FROM lineitem GROUP BY ALL""",
)
def median_matrix(spark, d):
    t = fx.table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("i"),
        (F.col("l_quantity") % 5).cast("int").alias("j"),
        F.try_divide("l_discount", "l_tax").alias("x"),
    )
    return rounded(G.spread.percentiles(t, ["i", "j"], "x", {"median": 0.5}))


@query(
    "reason_diagnosis",
    f"""WITH {fx.TARGETS}, g AS (SELECT site, count(*) AS candidates, count(*) FILTER (cloud <= 0.02 AND difference <= 0.3) AS ok_strict,
      count(*) FILTER (cloud <= 0.5 AND difference <= 0.3) AS ok_relaxed, count(*) FILTER (difference <= 0.3) AS c FROM candidates GROUP BY site)
    SELECT site, candidates, ok_strict, ok_relaxed, CASE WHEN ok_strict >= 3 THEN printf('ok strict (%d)', ok_strict)
      WHEN ok_relaxed >= 3 THEN printf('ok relaxed (%d, %d strict)', ok_relaxed, ok_strict)
      WHEN ok_relaxed = 0 AND c = 0 THEN printf('methane in all %d', candidates)
      WHEN ok_relaxed = 0 THEN printf('cloud in all %d', candidates) ELSE printf('only %d of 3', ok_relaxed) END AS reason FROM g""",
)
def reason_diagnosis(spark, d):
    return G.reason_diagnosis(fx.candidates(spark, d), "site", "cloud", "difference", methane_max=0.3)
