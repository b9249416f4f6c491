"""Metadata assembly and quality gates over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline import schemas
from plumeline.operators import aggs as G
from plumeline.operators import joins as J
from plumeline.operators import quality as Q
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.queries_joins import MATES, RANKED, ranked
from plumeline.plans.registry import query


@query(
    "build_level0",
    f"""WITH {fx.CATALOGUE_A}, {fx.PLUMES_B}, a AS (SELECT granule, count(DISTINCT source) AS n, count(*) FILTER (flux > 0 AND flux < 1000) AS w, count(*) FILTER (flux >= 1000) AS s, round(sum(flux) * 0.913777, 2) AS t, round(max(flux) * 0.913777, 2) AS m FROM catalogue_a GROUP BY 1),
      b AS (SELECT granule, count(*) AS n, sum(flux) * 0.913777 AS t, max(flux) * 0.913777 AS m FROM plumes_b GROUP BY 1)
    SELECT 's' || c_custkey AS id, 'FOLDER' AS type, coalesce(a.n, 0) AS "detection:n_a", coalesce(b.n, 0) AS "detection:n_b", coalesce(w, 0) AS "detection:n_a_weak", coalesce(s, 0) AS "detection:n_a_strong",
      a.t AS "detection:a_flux_total", a.m AS "detection:a_flux_max", round(b.t, 2) AS "detection:b_flux_total", round(b.m, 2) AS "detection:b_flux_max", 'C' || c_nationkey AS "site:country",
      CASE WHEN coalesce(w, 0) > 0 THEN 'has_weak' WHEN coalesce(s, 0) > 0 THEN 'strong_only' ELSE 'free' END AS "selection:flux_bin"
    FROM customer LEFT JOIN a ON a.granule = c_custkey LEFT JOIN b ON b.granule = c_custkey""",
)
def build_level0(spark, d):
    key = F.concat(F.lit("s"), F.col("granule")).alias("id")
    weak, strong = G.class_counts(F.col("flux"))
    a = fx.catalogue_a(spark, d).groupBy("granule").agg(
        F.count_distinct("source").alias("detection:n_a"),
        weak.alias("detection:n_a_weak"),
        strong.alias("detection:n_a_strong"),
        (F.sum("flux") * 0.913777).alias("detection:a_flux_total"),
        (F.max("flux") * 0.913777).alias("detection:a_flux_max"),
    )
    flux_bin = F.when(F.col("`detection:n_a_weak`") > 0, "has_weak").when(F.col("`detection:n_a_strong`") > 0, "strong_only")
    a = a.select(key, *[F.col(f"`{c}`") for c in a.columns[1:]], flux_bin.alias("selection:flux_bin"))
    b = fx.plumes_b(spark, d).groupBy("granule").agg(
        F.count("*").alias("detection:n_b"), (F.sum("flux") * 0.913777).alias("detection:b_flux_total"), (F.max("flux") * 0.913777).alias("detection:b_flux_max")
    )
    b = b.select(key, *[F.col(f"`{c}`") for c in b.columns[1:]])
    base = fx.table(spark, d, "customer").select(
        F.concat(F.lit("s"), F.col("c_custkey")).alias("id"), F.lit("FOLDER").alias("type"), F.concat(F.lit("C"), F.col("c_nationkey")).alias("site:country")
    )
    return Q.build_level0(base, [a, b]).na.fill("free", ["`selection:flux_bin`"])


@query(
    "declared_schema",
    """SELECT 66 - 2 AS declared, count(*) AS scenes FROM customer""",
)
def declared_schema(spark, d):
    schema = schemas.level0_schema()
    base = fx.table(spark, d, "customer").select(F.concat(F.lit("s"), F.col("c_custkey")).alias("id"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[1:]]
    full = schemas.canonical(base.select("id", *empty), schema)
    texts = [f for f in full.schema.fields if f.metadata.get("description")]
    return full.agg(F.lit(len(texts)).alias("declared"), F.count("id").alias("scenes"))


WINDS = f"""{fx.PLUMES_B}, {fx.WIND}, wt AS (SELECT 'a' AS catalog, granule, plume_id AS plume, sqrt(pow(flux / 10 - 3, 2) + pow(k / 10.0 - 4.03, 2)) AS speed, flux / 10 - 3 AS u, k / 10.0 - 4.03 AS v FROM plumes_b
    UNION ALL SELECT 'b', granule, plume_id, speed, -speed * sin(radians(direction)), -speed * cos(radians(direction)) FROM wind)"""


def winds(spark, d):
    w = fx.wind(spark, d).withColumnRenamed("plume_id", "plume")
    a = w.select("granule", "plume", (F.col("flux") / 10 - 3).alias("u"), (F.col("k") / F.lit(10.0) - 4.03).alias("v"))
    return Q.plume_wind_table(a, w.select("granule", "plume", "speed", "direction"))


@query("plume_wind_table", f"WITH {WINDS} SELECT catalog, granule, plume, round(speed, 6) AS speed, round(u, 6) AS u, round(v, 6) AS v FROM wt")
def plume_wind_table(spark, d):
    return rounded(winds(spark, d).drop("direction"))


@query(
    "per_plume_wind_json",
    f"""WITH {fx.PLUMES_B}, m AS (SELECT granule, kind, round(avg(k / 10.0 - 4.03), 3) AS v FROM plumes_b GROUP BY ALL) SELECT granule, 0 AS part, count(*) :: INTEGER AS n, min(v) AS v_min FROM m GROUP BY granule""",
)
def per_plume_wind_json(spark, d):
    b = fx.plumes_b(spark, d).select("granule", "kind", (F.col("flux") / 10 - 3).alias("u"), (F.col("k") / F.lit(10.0) - 4.03).alias("v"))
    j = Q.per_plume_wind_json(b, "granule", "kind")
    m = F.from_json("winds", "map<string,struct<u:double,v:double,speed:double>>")
    return j.select("granule", "part", F.size(m).alias("n"), F.array_min(F.transform(F.map_values(m), lambda w: w["v"])).alias("v_min"))


@query(
    "proposal_table",
    f"""WITH {RANKED}, r AS (SELECT id, max(date) FILTER (rank = 1) AS date1, max(date) FILTER (rank = 2) AS date2, max(date) FILTER (rank = 3) AS date3 FROM ranked GROUP BY id)
    SELECT c_custkey AS id, c_mktsegment, date1, date2, date3, cloud FROM customer JOIN r ON r.id = c_custkey LEFT JOIN (SELECT o_custkey AS id, min(o_totalprice) AS cloud FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) k ON k.id = c_custkey
    WHERE c_custkey IN (SELECT user_id FROM events)""",
)
def proposal_table(spark, d):
    refs = J.pivot_references(ranked(spark, d), "id", "rank", ["date"])
    samples = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    clouds = fx.table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_totalprice").alias("cloud"))
    points = fx.table(spark, d, "events").select(F.col("user_id").alias("id"))
    return Q.proposal_table(samples, refs, clouds, points)


@query(
    "fill_recovered_rows",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS flux, c_mktsegment AS kind FROM customer
       UNION ALL SELECT s_suppkey + 1000000, s_name, s_acctbal, NULL FROM supplier""",
)
def fill_recovered_rows(spark, d):
    published = fx.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("flux"), F.col("c_mktsegment").alias("kind")
    )
    fresh = fx.table(spark, d, "supplier").select((F.col("s_suppkey") + 1000000).cast("string").alias("code"), "s_name", "s_acctbal")
    return Q.fill_rows(published, fresh, {"id": "code", "name": "s_name", "flux": "s_acctbal"})


@query(
    "update_quality_columns",
    """SELECT o_orderkey AS id, coalesce(m, o_totalprice) AS cloud, o_orderstatus AS status FROM orders LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS m FROM lineitem WHERE l_tax = 0 GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def update_quality_columns(spark, d):
    base = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("cloud"), F.col("o_orderstatus").alias("status"))
    new = fx.table(spark, d, "lineitem").where("l_tax = 0").groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_extendedprice").alias("cloud"))
    return Q.overlay(base, new, "id", ["cloud"])


@query(
    "schema_order_check",
    """SELECT false AS ok, 'c_phone' AS missing, 'c_mktsegment' AS extra, 'c_mktsegment' AS first_wrong, (SELECT count(*) FROM customer) AS rows""",
)
def schema_order_check(spark, d):
    t = fx.table(spark, d, "customer")
    report = Q.schema_order_check(t, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_phone"])
    j = lambda c: F.array_join(c, ",").alias(c)
    return report.select("ok", j("missing"), j("extra"), "first_wrong", t.agg(F.count("*")).scalar().alias("rows"))


@query(
    "unique_id_check",
    """SELECT l_returnflag, sum(n) :: BIGINT AS rows, count(*) AS ids, count(*) FILTER (n > 1) AS repeated FROM (SELECT l_returnflag, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1""",
)
def unique_id_check(spark, d):
    return Q.unique_id_check(fx.table(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


@query(
    "range_checks",
    """WITH f AS (SELECT count(*) AS n, count(*) FILTER (NOT (l_discount BETWEEN 0 AND 0.08)) AS a, count(*) FILTER (l_returnflag NOT IN ('A', 'R')) AS b, count(*) FILTER (NOT l_quantity > 0) AS c FROM lineitem)
    SELECT 'discount' AS rule, a AS failures, n AS rows, a = 0 AS ok FROM f UNION ALL SELECT 'flag', b, n, b = 0 FROM f UNION ALL SELECT 'quantity', c, n, c = 0 FROM f""",
)
def range_checks(spark, d):
    rules = {
        "discount": F.col("l_discount").between(0, 0.08),
        "flag": F.col("l_returnflag").isin("A", "R"),
        "quantity": F.col("l_quantity") > 0,
    }
    return Q.range_checks(fx.table(spark, d, "lineitem"), rules)


@query(
    "recompute_compare",
    """WITH f AS (SELECT l_orderkey, sum(l_extendedprice) AS t FROM lineitem GROUP BY 1), dv AS (SELECT abs(o_totalprice - t) / greatest(abs(o_totalprice), 1e-12) AS d FROM f JOIN orders ON l_orderkey = o_orderkey)
    SELECT count(*) AS n, round(avg(CASE WHEN d > 0.1 THEN 1 ELSE 0 END), 6) AS above_10pct, round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.9), 6) AS p90 FROM dv""",
)
def recompute_compare(spark, d):
    stored = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("t"))
    fresh = fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("t"))
    return rounded(Q.recompute_compare(stored, fresh, "k", "t"))


@query(
    "layer_verification",
    """WITH l AS (SELECT l_orderkey AS scene, l_returnflag AS layer, CAST(min(l_linenumber) // 4 AS INTEGER) AS rows, max(l_discount) AS hi, min(l_tax) AS lo FROM lineitem GROUP BY ALL),
      c AS (SELECT scene, list(layer || ':range' ORDER BY layer) FILTER (hi > 0.09) AS p1, list(layer || ':zero' ORDER BY layer) FILTER (lo = 0) AS p2, count(DISTINCT rows) AS s, count(*) FILTER (layer = 'A') AS ha, count(*) FILTER (layer = 'N') AS hn, count(*) FILTER (layer = 'R') AS hr FROM l GROUP BY scene),
      p AS (SELECT scene, list_concat(list_concat(list_concat(CASE WHEN ha = 0 THEN ['A:missing'] ELSE [] END, CASE WHEN hn = 0 THEN ['N:missing'] ELSE [] END), CASE WHEN hr = 0 THEN ['R:missing'] ELSE [] END),
        list_concat(list_sort(list_concat(coalesce(p1, []), coalesce(p2, []))), CASE WHEN s > 1 THEN ['shapes differ'] ELSE [] END)) AS p FROM c)
    SELECT scene, len(p) = 0 AS ok, array_to_string(p, '; ') AS problems FROM p""",
)
def layer_verification(spark, d):
    layers = fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("scene"), F.col("l_returnflag").alias("layer")).agg(
        F.floor(F.min("l_linenumber") / 4).cast("int").alias("rows"), F.lit(1).alias("cols"), F.max("l_discount").alias("hi"), F.min("l_tax").alias("lo")
    )
    return Q.layer_verification(layers, ["A", "N", "R"], {"range": F.col("hi") <= 0.09, "zero": F.col("lo") > 0})


@query(
    "hash_diff_gate",
    """WITH b AS (SELECT doc_id, sha256(text) AS h FROM documents), a AS (SELECT doc_id, sha256(CASE WHEN doc_id % 50 = 3 THEN text || '.' ELSE text END) AS h FROM documents WHERE doc_id % 97 <> 5)
    SELECT doc_id, CASE WHEN a.h IS NOT DISTINCT FROM b.h THEN 'identical' WHEN doc_id % 100 = 3 THEN 'expected' ELSE 'unexpected' END AS change FROM b FULL JOIN a USING (doc_id)""",
)
def hash_diff_gate(spark, d):
    before = fx.table(spark, d, "documents").select("doc_id", "text")
    edited = F.when(F.col("doc_id") % 50 == 3, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    after = before.where("doc_id % 97 <> 5").withColumn("text", edited)
    return Q.hash_diff_gate(before, after, before.where("doc_id % 100 = 3"), "doc_id", "text")


@query(
    "id_set_equality",
    """WITH e AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), o AS (SELECT o_orderkey AS k FROM orders) SELECT (SELECT count(*) FROM o WHERE k NOT IN (SELECT k FROM e)) AS only_a, (SELECT count(*) FROM e WHERE k NOT IN (SELECT k FROM o)) AS only_b, false AS equal""",
)
def id_set_equality(spark, d):
    a = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    b = fx.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    return Q.id_set_equality(a, b, "k")


@query(
    "manifest_diff",
    """WITH l AS (SELECT url AS path, min(length(html)) AS s FROM pages GROUP BY 1), r AS (SELECT url AS path, min(length(html)) + CASE WHEN min(page_id) % 9 = 0 THEN 1 ELSE 0 END AS s FROM pages WHERE page_id % 11 <> 4 GROUP BY 1)
    SELECT path, l.s AS local_size, r.s AS remote_size, CASE WHEN r.s IS NULL THEN 'missing' WHEN l.s IS NULL THEN 'extra' ELSE 'size' END AS state FROM l FULL JOIN r USING (path) WHERE l.s IS DISTINCT FROM r.s""",
)
def manifest_diff(spark, d):
    p = fx.table(spark, d, "pages").select(F.col("url").alias("path"), F.length("html").cast("bigint").alias("n"), "page_id")
    local = p.groupBy("path").agg(F.min("n").alias("size"))
    bump = F.when(F.min("page_id") % 9 == 0, 1).otherwise(0)
    remote = p.where("page_id % 11 <> 4").groupBy("path").agg((F.min("n") + bump).alias("size"))
    return Q.manifest_diff(local, remote)


@query(
    "table_equality",
    """WITH b AS (SELECT c_custkey AS k, c_acctbal + CASE WHEN c_custkey % 10 = 1 THEN 0.5 ELSE 0 END AS v, CASE WHEN c_custkey % 40 = 2 THEN 'X' ELSE c_mktsegment END AS t FROM customer)
    SELECT 'c_acctbal' AS column, count(*) FILTER (c_acctbal <> v) AS differing, round(max(abs(c_acctbal - v)), 9) AS largest_gap FROM customer JOIN b ON k = c_custkey
    UNION ALL SELECT 'c_mktsegment', count(*) FILTER (c_mktsegment <> t), NULL FROM customer JOIN b ON k = c_custkey""",
)
def table_equality(spark, d):
    a = fx.table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    b = a.withColumn("c_acctbal", F.col("c_acctbal") + F.when(k % 10 == 1, 0.5).otherwise(0.0)).withColumn(
        "c_mktsegment", F.when(k % 40 == 2, "X").otherwise(F.col("c_mktsegment"))
    )
    return rounded(Q.table_equality(a, b, "c_custkey"), 9)


@query(
    "leaf_completeness",
    """WITH l AS (SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) FILTER (turn <= 3) AS f FROM conversations GROUP BY 1) SELECT conv_id, n AS leaves, f AS found FROM l WHERE n <> 4 OR f <> 'user,assistant,user,assistant'""",
)
def leaf_completeness(spark, d):
    c = fx.table(spark, d, "conversations").select("conv_id", "role", (F.col("turn") + 1).alias("turn"))
    return Q.leaf_completeness(c, "conv_id", "role", "turn", ["user", "assistant", "user", "assistant"])


@query(
    "plume_index",
    f"""WITH {MATES}, m AS (SELECT scene, 'a' AS side, p AS plume, 'b' AS mate_side, q AS mate FROM pr UNION ALL SELECT scene, 'b', q, 'a', p FROM pr), bt AS (SELECT *, plume + CASE WHEN side = 'b' THEN 7 ELSE 0 END AS bit FROM pl WHERE (scene + plume) % 9 > 0)
    SELECT pl.scene, pl.side, pl.plume, x.bit, CASE WHEN m.mate IS NOT NULL THEN 'pair' WHEN pl.plume % 2 = 0 THEN 'orphan' END AS match, y.bit AS mate_bit, CASE WHEN x.bit IS NULL THEN 'no bit' WHEN m.mate IS NOT NULL AND y.bit IS NULL THEN 'mate without bit' END AS problem
    FROM pl LEFT JOIN m USING (scene, side, plume) LEFT JOIN bt x ON x.scene = pl.scene AND x.side = pl.side AND x.plume = pl.plume LEFT JOIN bt y ON y.scene = pl.scene AND y.side = m.mate_side AND y.plume = m.mate""",
)
def plume_index(spark, d):
    from plumeline.plans.registry import QUERIES

    masks = fx.masks(spark, d)
    plumes = masks.select("scene", "side", "plume", (F.col("col") * 0.01).alias("lon"), (F.col("row") * 0.01).alias("lat"), F.lit(1.0).alias("flux"))
    bits = masks.select("scene", "side", "plume").distinct().where("(scene + plume) % 9 > 0")
    bits = bits.withColumn("bit", F.col("plume") + F.when(F.col("side") == "b", 7).otherwise(0))
    out = Q.plume_index(plumes, bits, QUERIES["pair_mate_join"](spark, d))
    return out.select("scene", "side", "plume", "bit", "match", "mate_bit", "problem")
