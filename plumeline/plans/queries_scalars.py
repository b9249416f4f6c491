"""Projections, filters, text, date and angle operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.functions import angles as A
from plumeline.functions import text as X
from plumeline.operators import clean as C
from plumeline.operators import spread
from plumeline.plans import fixtures as fx
from plumeline.plans.registry import query

# --- filters and projections ------------------------------------------------------------------


@query(
    "extract_granule_key",
    """SELECT page_id, lower(regexp_extract(url, '/([a-z]{2}/[0-9]+)', 1)) AS granule_ts FROM pages
       WHERE regexp_extract(url, '/([a-z]{2}/[0-9]+)', 1) <> ''""",
)
def extract_granule_key(spark, d):
    key = X.extract_key(F.col("url"), "/([a-z]{2}/[0-9]+)")
    return (
        fx.table(spark, d, "pages").select("page_id", key.alias("granule_ts")).where("granule_ts is not null")
    )


@query(
    "filter_sensor_gas",
    """SELECT p_type, count(*) AS n, sum(p_size) :: BIGINT AS size FROM part
       WHERE contains(p_name, 'ring') AND p_brand = 'Brand#2' GROUP BY p_type""",
)
def filter_sensor_gas(spark, d):
    return (
        fx.table(spark, d, "part")
        .where(F.col("p_name").contains("ring") & (F.col("p_brand") == "Brand#2"))
        .groupBy("p_type")
        .agg(F.count("*").alias("n"), F.sum("p_size").alias("size"))
    )


@query(
    "drop_incomplete_groups",
    f"""WITH {fx.CATALOGUE_A}
    SELECT tile, count(*) AS n, round(sum(flux), 3) AS flux FROM catalogue_a
    WHERE tile NOT IN (SELECT tile FROM catalogue_a WHERE flux IS NULL OR flux = 0) GROUP BY tile""",
)
def drop_incomplete_groups(spark, d):
    a = fx.catalogue_a(spark, d).select("tile", "flux")
    bad = F.col("flux").isNull() | (F.col("flux") == 0)
    kept = C.drop_incomplete_groups(a, "tile", bad)
    return kept.groupBy("tile").agg(F.count("*").alias("n"), F.round(F.sum("flux"), 3).alias("flux"))


@query(
    "clean_only",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN
       (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING avg(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) = 0)""",
)
def clean_only(spark, d):
    nodata = (
        fx.table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.avg(F.when(F.col("l_discount") == 0, 1).otherwise(0)).alias("nodata_pct"))
    )
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return C.keep_keys(orders, nodata.where("nodata_pct = 0"), "o_orderkey")


@query(
    "conditional_column",
    f"""WITH {fx.CATALOGUE_A}, g AS (
      SELECT tile, count(*) FILTER (flux > 0 AND flux < 1000) AS n_weak,
             count(*) FILTER (flux >= 1000) AS n_strong FROM catalogue_a GROUP BY tile)
    SELECT tile, n_weak, n_strong, CASE WHEN n_weak > 0 THEN 'has_weak' WHEN n_strong > 0
      THEN 'strong_only' ELSE 'free' END AS flux_bin FROM g""",
)
def conditional_column(spark, d):
    weak = (F.col("flux") > 0) & (F.col("flux") < A.WEAK_KG_H)
    g = (
        fx.catalogue_a(spark, d)
        .groupBy("tile")
        .agg(F.count_if(weak).alias("n_weak"), F.count_if(F.col("flux") >= A.WEAK_KG_H).alias("n_strong"))
    )
    label = F.when(F.col("n_weak") > 0, "has_weak").when(F.col("n_strong") > 0, "strong_only").otherwise("free")
    return g.withColumn("flux_bin", label)


@query(
    "map_values",
    """SELECT c_custkey, n_name AS country, CASE WHEN n_name = 'NATION_3' THEN 'Fixed'
         WHEN r_name IN ('ASIA', 'EUROPE') THEN r_name ELSE 'Other' END AS region
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def map_values(spark, d):
    nation = fx.table(spark, d, "nation")
    region = fx.table(spark, d, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))
    dim = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )
    override = nation.where("n_name = 'NATION_3'").select(F.col("n_name").alias("country"), F.lit("Fixed").alias("region"))
    rows = (
        fx.table(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("country"))
    )
    return C.recode_by_table(rows, dim, "country", "region", "Other", override)


@query(
    "sector_from_code",
    """WITH c AS (SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN ' 1B1a' WHEN 1 THEN '1B2' WHEN 2 THEN '1A3'
       WHEN 3 THEN '6C ' WHEN 4 THEN '4B' WHEN 5 THEN '9X' END AS code FROM part)
    SELECT p_partkey, CASE WHEN trim(coalesce(code, '')) = '' THEN 'Unknown'
      WHEN trim(code) LIKE '1B1%' THEN 'Coal' WHEN trim(code) LIKE '1B2%' THEN 'Oil and Gas'
      WHEN trim(code) LIKE '1A%' THEN 'Energy' WHEN trim(code) LIKE '6%' THEN 'Waste'
      WHEN trim(code) LIKE '4B%' THEN 'Livestock' ELSE 'Other' END AS sector FROM c""",
)
def sector_from_code(spark, d):
    slot = F.col("p_size") % 7
    code = F.element_at(F.array(*[F.lit(x) for x in (" 1B1a", "1B2", "1A3", "6C ", "4B", "9X", None)]), slot + 1)
    return fx.table(spark, d, "part").select("p_partkey", X.sector_from_code(code).alias("sector"))


@query(
    "collapse_sector",
    """SELECT CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'SMALL') THEN p_type ELSE 'Other' END AS sector,
       count(*) AS n FROM part GROUP BY 1""",
)
def collapse_sector(spark, d):
    kind = X.collapse(F.col("p_type"), ("ECONOMY", "PROMO", "SMALL"))
    return fx.table(spark, d, "part").groupBy(kind.alias("sector")).agg(F.count("*").alias("n"))


@query(
    "coalesce_renamed_column",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus END AS name FROM orders""",
)
def coalesce_renamed_column(spark, d):
    t = fx.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("new_name"),
        F.col("o_orderstatus").alias("old_name"),
    )
    return t.select("o_orderkey", C.first_existing(t, ["new_name", "newer_name", "old_name"]).alias("name"))


@query("rename_drop_columns", "SELECT s_suppkey AS id, s_acctbal AS flux FROM supplier")
def rename_drop_columns(spark, d):
    t = fx.table(spark, d, "supplier").withColumnRenamed("s_name", "internal:name")
    return C.migrate_columns(t, {"s_suppkey": "id", "s_acctbal": "flux"}, ["s_nationkey"])


@query(
    "round_columns",
    """SELECT event_id, round_even(value / 7, 3) AS wind, round_even(value / 7.1, 1) AS path, event_type FROM events""",
)
def round_columns(spark, d):
    t = fx.table(spark, d, "events").select(
        "event_id", (F.col("value") / 7).alias("wind"), (F.col("value") / 7.1).alias("path"), "event_type"
    )
    return C.round_columns(t, {"wind": 3, "path": 1})


@query(
    "null_policy",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS flux,
       CASE WHEN c_acctbal >= 0 THEN c_nationkey ELSE 0 END AS n,
       CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE 'Unknown' END AS sector FROM customer""",
)
def null_policy(spark, d):
    good = F.col("c_acctbal") >= 0
    t = fx.table(spark, d, "customer").select(
        "c_custkey",
        F.when(good, F.col("c_acctbal")).otherwise(F.lit(float("nan"))).alias("flux"),
        F.when(good, F.col("c_nationkey")).alias("n"),
        F.when(good, F.col("c_mktsegment")).alias("sector"),
    )
    return C.null_policy(t, counts=["n"], texts={"sector": "Unknown"})


@query(
    "cast_to_published_types",
    """SELECT CAST(page_id AS INTEGER) AS id, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS num,
       CAST(NULL AS DOUBLE) AS extra, url FROM pages""",
)
def cast_to_published_types(spark, d):
    t = fx.table(spark, d, "pages").select(
        F.col("page_id").alias("id"), F.regexp_extract("url", "/([0-9]+)", 1).alias("num"), "url"
    )
    spec = T.StructType().add("id", "integer").add("num", "long").add("extra", "double").add("url", "string")
    return C.cast_to(t, spec)


@query(
    "criteria_flags",
    """WITH s AS (SELECT l_suppkey AS snap, max(l_extendedprice) AS peak, min(l_extendedprice) AS entry,
        regr_slope(l_extendedprice, l_quantity) - 2000 AS slope, min(l_extendedprice) AS edge,
        avg(l_extendedprice) AS inner_min, max(l_discount) * 9000 AS side,
        CASE WHEN min(l_tax) = 0 THEN 0.001 END AS share, max(l_quantity) AS width FROM lineitem GROUP BY 1),
     f AS (SELECT snap, slope < 0 AND edge < inner_min AS fades, entry < 0.02 * peak AS upwind_ok,
       side < 0.02 * peak AS sides_ok, coalesce(share < 0.002, false) AS foreign_ok, width <= 60 AS width_ok FROM s)
    SELECT *, fades AND upwind_ok AND sides_ok AND foreign_ok AND width_ok AS passes FROM f""",
)
def criteria_flags(spark, d):
    price = F.col("l_extendedprice")
    s = (
        fx.table(spark, d, "lineitem")
        .groupBy(F.col("l_suppkey").alias("snap"))
        .agg(
            F.max(price).alias("peak"),
            F.min(price).alias("edge"),
            (F.regr_slope(price, F.col("l_quantity")) - 2000).alias("slope"),
            F.avg(price).alias("inner_min"),
            (F.max("l_discount") * 9000).alias("side"),
            F.when(F.min("l_tax") == 0, 0.001).alias("share"),
            F.max("l_quantity").alias("width"),
        )
    )
    c = F.col
    out = C.criteria_flags(
        s, c("slope"), c("edge"), c("inner_min"), c("edge"), c("peak"), c("side"), c("share"), c("width")
    )
    return out.drop("peak", "edge", "slope", "inner_min", "side", "share", "width")


@query(
    "sensor_preset",
    """WITH p AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'LC08' WHEN 1 THEN 'LC09' WHEN 2 THEN 'S2B'
        WHEN 3 THEN 'S2D' ELSE 'XX' END AS platform FROM orders)
    SELECT o_orderkey, platform, CASE WHEN platform LIKE 'LC%' THEN 'landsat' WHEN platform LIKE 'S2%' THEN 's2' END AS family,
      CASE WHEN platform LIKE 'LC%' THEN platform WHEN platform LIKE 'S2%' THEN 'S2' END AS label,
      CASE WHEN platform = 'LC08' THEN '2013-03-18' WHEN platform = 'LC09' THEN '2021-10-31' WHEN platform LIKE 'S2%' THEN '2015-06-27' END AS earliest,
      CASE WHEN platform LIKE 'LC%' THEN 11 WHEN platform LIKE 'S2%' THEN 13 END AS bands FROM p""",
)
def sensor_preset(spark, d):
    slot = (F.col("o_orderkey") % 5).cast("int")
    names = F.array(*[F.lit(x) for x in ("LC08", "LC09", "S2B", "S2D", "XX")])
    t = fx.table(spark, d, "orders").select("o_orderkey", F.element_at(names, slot + 1).alias("platform"))
    return C.sensor_preset(t, "platform")


@query(
    "catalog_sql_query",
    """SELECT o_orderkey AS id, o_totalprice AS "ch4:flux" FROM orders
       WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
)
def catalog_sql_query(spark, d):
    t = fx.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("ch4:flux"),
        F.col("o_orderpriority").alias("site:class"),
    )
    return C.catalog_sql(
        t,
        "SELECT id, `ch4:flux` FROM level0 WHERE `site:class` = '1-URGENT' AND `ch4:flux` > 100000 "
        "ORDER BY `ch4:flux` DESC, id LIMIT 5",
    )


FACETS = """facets AS (
  SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'imaging' WHEN 'O' THEN 's2' ELSE 'l89' END AS sensor,
    o_orderpriority AS system, CASE WHEN o_orderkey % 3 = 0 THEN 'pair' WHEN o_orderkey % 3 = 1 THEN 'orphan' END AS match,
    CAST(o_custkey % 20 AS VARCHAR) AS country, strftime(o_orderdate, '%Y-%m-%d') AS date,
    CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice / 100 END AS flux FROM orders)"""


def facets(spark, d):
    k = F.col("o_orderkey")
    return fx.table(spark, d, "orders").select(
        k.alias("id"),
        X.recode(F.col("o_orderstatus"), {"F": "imaging", "O": "s2"}, "l89").alias("sensor"),
        F.col("o_orderpriority").alias("system"),
        F.when(k % 3 == 0, "pair").when(k % 3 == 1, "orphan").alias("match"),
        (F.col("o_custkey") % 20).cast("string").alias("country"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(k % 7 > 0, F.col("o_totalprice") / 100).alias("flux"),
    )


FACET_ARGS = dict(
    sensors=["imaging", "s2"], systems=["1-URGENT", "2-HIGH"], matches=["pair"], years=(1996, 1999), min_flux=500.0
)


@query(
    "faceted_filter",
    f"""WITH {FACETS} SELECT id, sensor, date, flux FROM facets WHERE sensor IN ('imaging', 's2')
      AND (sensor <> 'imaging' OR system IN ('1-URGENT', '2-HIGH'))
      AND (sensor <> 'imaging' OR match IS NULL OR match = 'pair')
      AND CAST(substr(date, 1, 4) AS INT) BETWEEN 1996 AND 1999 AND coalesce(flux, 0) >= 500""",
)
def faceted_filter(spark, d):
    t = facets(spark, d)
    return t.where(C.faceted_filter(t, **FACET_ARGS)).select("id", "sensor", "date", "flux")


@query(
    "exclude_ids",
    """SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def exclude_ids(spark, d):
    stale = fx.table(spark, d, "labels").where("toxic = 1").select("doc_id")
    return C.drop_keys(fx.table(spark, d, "documents").select("doc_id", "source"), stale, "doc_id")


@query(
    "drop_constant_target_rows",
    """SELECT o_orderkey FROM orders WHERE o_orderkey IN
       (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING max(l_quantity) > min(l_quantity))""",
)
def drop_constant_target_rows(spark, d):
    flat = (
        fx.table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg((F.max("l_quantity") > F.min("l_quantity")).alias("varies"))
    )
    return fx.table(spark, d, "orders").select("o_orderkey").join(flat.where("varies"), "o_orderkey", "left_semi")


@query(
    "require_all_slots",
    """SELECT o_custkey, date1, date2, date3 FROM (SELECT o_custkey,
       min(o_orderdate) FILTER (o_orderstatus = 'F') AS date1, min(o_orderdate) FILTER (o_orderstatus = 'O') AS date2,
       min(o_orderdate) FILTER (o_orderstatus = 'P' AND o_totalprice > 300000) AS date3 FROM orders GROUP BY 1)
       WHERE date1 IS NOT NULL AND date2 IS NOT NULL AND date3 IS NOT NULL""",
)
def require_all_slots(spark, d):
    day = F.col("o_orderdate")
    status = F.col("o_orderstatus")
    t = (
        fx.table(spark, d, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min(F.when(status == "F", day)).alias("date1"),
            F.min(F.when(status == "O", day)).alias("date2"),
            F.min(F.when((status == "P") & (F.col("o_totalprice") > 300000), day)).alias("date3"),
        )
    )
    return C.require_slots(t, ["date1", "date2", "date3"])


# --- text -------------------------------------------------------------------------------------


@query(
    "regex_extract_fields",
    r"""SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme,
        regexp_extract(url, '://([^/]+)', 1) AS host, regexp_extract(url, '/([a-z]{2})/', 1) AS lang,
        TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS INTEGER) AS number FROM pages""",
)
def regex_extract_fields(spark, d):
    url = F.col("url")
    return fx.table(spark, d, "pages").select(
        "page_id",
        F.regexp_extract(url, "^(https?)://", 1).alias("scheme"),
        F.regexp_extract(url, "://([^/]+)", 1).alias("host"),
        F.regexp_extract(url, "/([a-z]{2})/", 1).alias("lang"),
        F.regexp_extract(url, "/([0-9]+)", 1).try_cast("int").alias("number"),
    )


DATE_TEXT = """CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, 'T%Y%m%d_x')
  WHEN 1 THEN strftime(o_orderdate, 'd %Y-%m-%dT00') ELSE 'none' END"""


def _date_text():
    k = F.col("o_orderkey")
    return (
        F.when(k % 3 == 0, F.concat(F.lit("T"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_x")))
        .when(k % 3 == 1, F.concat(F.lit("d "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00")))
        .otherwise("none")
    )


@query(
    "parse_loose_date",
    f"""SELECT o_orderkey, {DATE_TEXT} AS text, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""",
)
def parse_loose_date(spark, d):
    return fx.table(spark, d, "orders").select(
        "o_orderkey", _date_text().alias("text"), X.loose_date(_date_text()).alias("day")
    )


@query(
    "plume_date",
    """SELECT event_id, CASE WHEN event_id % 4 < 3 THEN CAST(ts AS DATE) END AS day FROM events""",
)
def plume_date(spark, d):
    e = F.col("event_id") % 4
    text = (
        F.when(e == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(e == 1, F.date_format("ts", "yyyy/MM/dd"))
        .when(e == 2, F.date_format("ts", "dd.MM.yyyy HH:mm"))
        .otherwise("NaT")
    )
    stamp = X.mixed_timestamp(text, ["yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "dd.MM.yyyy HH:mm"])
    return fx.table(spark, d, "events").select("event_id", F.to_date(stamp).alias("day"))


@query(
    "slugify",
    r"""SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM pages""",
)
def slugify(spark, d):
    return fx.table(spark, d, "pages").select("page_id", X.slugify(F.col("url")).alias("slug"))


@query(
    "format_uid",
    """SELECT p_partkey, printf('%s_w%04.1f_s%03d', CASE WHEN p_size % 2 = 0 THEN 'a' ELSE 'p' END || (p_size % 9 + 1),
       p_size / 2.0, p_size) AS uid FROM part""",
)
def format_uid(spark, d):
    size = F.col("p_size")
    emitter = F.concat(F.when(size % 2 == 0, "a").otherwise("p"), (size % 9 + 1).cast("string"))
    return fx.table(spark, d, "part").select("p_partkey", X.plume_uid(emitter, size / F.lit(2.0), size).alias("uid"))


@query(
    "parse_number_list",
    """SELECT c_custkey, [CAST(c_acctbal AS DOUBLE), CAST(c_custkey AS DOUBLE), 0.5] AS numbers, 3 AS n FROM customer""",
)
def parse_number_list(spark, d):
    text = F.format_string("[ %.2f  %d\n 5e-1 ]", F.col("c_acctbal"), F.col("c_custkey"))
    nums = X.number_list(text)
    return fx.table(spark, d, "customer").select("c_custkey", nums.alias("numbers"), F.size(nums).alias("n"))


@query(
    "format_wkt_multipoint",
    """SELECT country, CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 8 AS INT) AS part, CASE WHEN count(*) FILTER (flux >= 0) = 0 THEN 'MULTIPOINT EMPTY' ELSE 'MULTIPOINT (' ||
       string_agg(printf('(%.2f %.2f)', lon, lat), ', ' ORDER BY lon, lat) FILTER (flux >= 0) || ')' END AS points
       FROM (WITH """ + fx.POINTS + """ SELECT * FROM points) GROUP BY ALL""",
)
def format_wkt_multipoint(spark, d):
    lon = F.when(F.col("flux") >= 0, F.col("lon"))
    pts = F.array_sort(F.collect_list(F.struct(lon.alias("lon"), F.col("lat"))))
    # Countries grow with the table: each comes in eight numbered texts.
    rows = spread.with_parts(fx.points(spark, d), "id", 8)
    return rows.groupBy("country", "part").agg(pts.alias("p")).select("country", "part", X.multipoint(F.col("p"), 2).alias("points"))


@query(
    "json_to_map_list",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS n,
       CASE WHEN event_id % 5 > 0 THEN CAST(regexp_extract(props, ': ([0-9]+)', 1) AS DOUBLE) END AS k FROM events""",
)
def json_to_map_list(spark, d):
    text = F.when(F.col("event_id") % 5 == 0, "{broken").otherwise(F.col("props"))
    m = X.json_map(text)
    return fx.table(spark, d, "events").select("event_id", F.size(m).alias("n"), F.try_element_at(m, F.lit("k")).alias("k"))


@query(
    "classify_by_pattern",
    r"""SELECT page_id, CASE WHEN regexp_matches(url, '^https?://m\.') THEN 'mobile' WHEN regexp_matches(url, '^https?://blog\.')
        THEN 'blog' WHEN regexp_matches(url, '[0-9]+\.html') THEN 'file' ELSE 'plain' END AS family FROM pages""",
)
def classify_by_pattern(spark, d):
    ladder = ((r"^https?://m\.", "mobile"), (r"^https?://blog\.", "blog"), (r"[0-9]+\.html", "file"))
    return fx.table(spark, d, "pages").select("page_id", X.classify(F.col("url"), ladder, "plain").alias("family"))


@query(
    "split_path",
    """SELECT page_id, split_part(url, '/', 3) AS top, split_part(url, '/', -1) AS leaf FROM pages""",
)
def split_path(spark, d):
    parts = F.split("url", "/")
    return fx.table(spark, d, "pages").select(
        "page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("top"), F.element_at(parts, -1).alias("leaf")
    )


@query("strip_suffix", "SELECT p_partkey, trim(substr(p_type, 1, 3) || '_', '_') AS platform FROM part")
def strip_suffix(spark, d):
    return fx.table(spark, d, "part").select(
        "p_partkey", F.btrim(F.concat(F.substring("p_type", 1, 3), F.lit("_")), F.lit("_")).alias("platform")
    )


# --- angles and other numbers ------------------------------------------------------------------


@query(
    "wind_components",
    f"""WITH {fx.PLUMES_B}, {fx.WIND}, c AS (SELECT plume_id, -speed * sin(radians(direction)) AS u,
        -speed * cos(radians(direction)) AS v FROM wind WHERE speed > 0.01)
    SELECT plume_id, round(u, 6) AS u, round(v, 6) AS v,
      round((degrees(atan2(-u, -v)) + 360.000005) % 360, 3) AS wind_from, round((degrees(atan2(u, v)) + 360.000005) % 360, 3) AS wind_to FROM c""",
)
def wind_components(spark, d):
    w = fx.wind(spark, d).where("speed > 0.01")
    c = w.select(
        "plume_id",
        A.wind_u(F.col("speed"), F.col("direction")).alias("u"),
        A.wind_v(F.col("speed"), F.col("direction")).alias("v"),
    )
    nudge = lambda x: F.round((x + 0.000005) % 360, 3)
    return c.select(
        "plume_id",
        F.round("u", 6).alias("u"),
        F.round("v", 6).alias("v"),
        nudge(A.wind_from(F.col("u"), F.col("v"))).alias("wind_from"),
        nudge(A.wind_to(F.col("u"), F.col("v"))).alias("wind_to"),
    )


@query(
    "relative_azimuth",
    f"""WITH {fx.PLUMES_B}, {fx.WIND}, c AS (SELECT plume_id, CASE WHEN k % 10 > 0 THEN k * 2.5 + 0.3 END AS saa,
        -speed * sin(radians(direction)) AS u, -speed * cos(radians(direction)) AS v FROM wind)
    SELECT plume_id, CASE WHEN sqrt(u * u + v * v) >= 0.1 AND saa IS NOT NULL
      THEN round((degrees(atan2(u, v)) - saa + 720) % 360, 4) END AS raa,
      round((90 - saa - u + 7200) % 360, 4) AS raa_math FROM c""",
)
def relative_azimuth(spark, d):
    c = fx.wind(spark, d).select(
        "plume_id",
        F.when(F.col("k") % 10 > 0, F.col("k") * 2.5 + 0.3).alias("saa"),
        A.wind_u(F.col("speed"), F.col("direction")).alias("u"),
        A.wind_v(F.col("speed"), F.col("direction")).alias("v"),
    )
    return c.select(
        "plume_id",
        F.round(A.relative_azimuth(F.col("u"), F.col("v"), F.col("saa")), 4).alias("raa"),
        F.round(A.relative_azimuth_math(F.col("saa"), F.col("u")), 4).alias("raa_math"),
    )


@query(
    "circular_diff",
    """SELECT l_orderkey, count(*) AS n, round(max(least(((l_quantity * 9 - l_suppkey) % 360 + 360) % 360,
       360 - ((l_quantity * 9 - l_suppkey) % 360 + 360) % 360)), 6) AS diff,
       round(min(((l_quantity * 9 - l_suppkey + 180) % 360 + 360) % 360 - 180), 6) AS signed_diff FROM lineitem GROUP BY 1""",
)
def circular_diff(spark, d):
    a, b = F.col("l_quantity") * 9, F.col("l_suppkey").cast("double")
    return (
        fx.table(spark, d, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n"),
            F.round(F.max(A.circular_diff(a, b)), 6).alias("diff"),
            F.round(F.min(A.signed_circular_diff(a, b)), 6).alias("signed_diff"),
        )
    )


NEIGHBOURS = f"""WITH {fx.POINTS}, pair AS (SELECT a.id, a.lon AS lon1, a.lat AS lat1, b.lon AS lon2, b.lat AS lat2
  FROM points a JOIN points b ON b.id = a.id + 1)"""


def _neighbours(spark, d):
    p = fx.points(spark, d)
    return p.select("id", F.col("lon").alias("lon1"), F.col("lat").alias("lat1")).join(
        p.select((F.col("id") - 1).alias("id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")), "id"
    )


@query(
    "haversine_m",
    NEIGHBOURS
    + """ SELECT id, round(2 * 6371000 * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) *
      cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))), 3) AS metres FROM pair""",
)
def haversine_m(spark, d):
    cols = [F.col(c) for c in ("lon1", "lat1", "lon2", "lat2")]
    return _neighbours(spark, d).select("id", F.round(A.haversine_m(*cols), 3).alias("metres"))


@query(
    "flat_distance_km",
    NEIGHBOURS
    + """ SELECT id, round(sqrt(pow((lat1 - lat2) * 111.32, 2) +
      pow((lon1 - lon2) * 111.32 * cos(radians((lat1 + lat2) / 2)), 2)), 5) AS km FROM pair""",
)
def flat_distance_km(spark, d):
    cols = [F.col(c) for c in ("lon1", "lat1", "lon2", "lat2")]
    return _neighbours(spark, d).select("id", F.round(A.flat_distance_km(*cols), 5).alias("km"))


@query(
    "air_mass_factor",
    """SELECT p_partkey, round(1 / cos(radians(90 - (30 + p_size))) + 1 / cos(radians(p_size % 15)), 8) AS amf FROM part""",
)
def air_mass_factor(spark, d):
    size = F.col("p_size")
    amf = A.air_mass_factor(90 - (30 + size), size % 15)
    return fx.table(spark, d, "part").select("p_partkey", F.round(amf, 8).alias("amf"))


@query(
    "utm_zone",
    f"""WITH {fx.POINTS} SELECT id, CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + floor((lon + 180) / 6) + 1 AS INTEGER) AS epsg FROM points""",
)
def utm_zone(spark, d):
    return fx.points(spark, d).select("id", A.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


@query(
    "band_index",
    """SELECT p_partkey, CAST(round_even((400 + p_retailprice % 2000 - 381.0) / (2112.0 / 284), 0) AS INTEGER) + 1 AS band FROM part""",
)
def band_index(spark, d):
    nm = F.lit(400.0) + F.col("p_retailprice") % 2000
    return fx.table(spark, d, "part").select("p_partkey", A.band_index(nm).alias("band"))


@query(
    "radiance_to_reflectance",
    """SELECT l_orderkey, l_linenumber, round(greatest(least(pi() * l_quantity * 10 / (1550 * cos(radians(l_discount * 400))), 1.5), 0), 8) AS reflectance FROM lineitem""",
)
def radiance_to_reflectance(spark, d):
    r = A.reflectance(F.col("l_quantity"), F.lit(1550.0), F.col("l_discount") * 400, F.lit(1.0))
    return fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(r, 8).alias("reflectance"))


@query(
    "ime_to_rate",
    """SELECT l_suppkey, round(sum(l_extendedprice) * 360550.0 * 400 / 1e9 * 16.04 / 1000 * 3.5 / (max(l_quantity) * 20) * 3600, 3) AS rate
       FROM lineitem GROUP BY 1""",
)
def ime_to_rate(spark, d):
    rate = A.ime_rate_kg_h(A.ime_kg(F.sum("l_extendedprice")), F.lit(3.5), F.max("l_quantity") * 20)
    return fx.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(rate, 3).alias("rate"))


@query(
    "scale_to_rate",
    """SELECT l_orderkey, round(sum(l_quantity * (500 + l_linenumber * 100) / 3000.0), 5) AS ppb FROM lineitem GROUP BY 1""",
)
def scale_to_rate(spark, d):
    v = A.scale_to_rate(F.col("l_quantity"), 500 + F.col("l_linenumber") * 100)
    return fx.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum(v), 5).alias("ppb"))


@query(
    "anniversary",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - to_years(CAST(o_custkey % 3 AS INTEGER)) AS DATE) AS day FROM orders""",
)
def anniversary(spark, d):
    return fx.table(spark, d, "orders").select(
        "o_orderkey", A.anniversary(F.to_date("o_orderdate"), F.col("o_custkey") % 3).alias("day")
    )


@query(
    "log_area",
    """SELECT l_orderkey, round(avg(log10(l_extendedprice)), 8) AS log_flux, round(avg(log10(l_quantity)), 8) AS log_area FROM lineitem GROUP BY 1""",
)
def log_area(spark, d):
    return (
        fx.table(spark, d, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.round(F.avg(F.log10("l_extendedprice")), 8).alias("log_flux"),
            F.round(F.avg(F.log10("l_quantity")), 8).alias("log_area"),
        )
    )
