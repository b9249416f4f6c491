"""Scans and sinks: the driver tables written to the shared scratch folder and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from plumeline import schemas
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.registry import query
from plumeline.session import scratch_path
from plumeline.sources import scans, sinks


@query("scan_csv_catalog", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def scan_csv_catalog(spark, d):
    path = scratch_path(spark, "catalog-csv")
    sinks.write_csv(fx.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return scans.csv_catalog(spark, path, "c_custkey bigint, c_name string, c_acctbal double").where("c_acctbal > 0")


@query("scan_parquet_catalog", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def scan_parquet_catalog(spark, d):
    return scans.parquet_catalog(spark, f"{d}/orders.parquet", ["o_orderkey", "o_totalprice"]).where("o_totalprice > 400000")


@query("scan_geojson_features", f"WITH {fx.POINTS} SELECT id, kind, flux, lon, lat FROM points")
def scan_geojson_features(spark, d):
    path = scratch_path(spark, "features")
    sinks.write_geojson(fx.points(spark, d), path, "lon", "lat", ["id", "kind", "flux"])
    f = scans.geojson_features(spark, path, "struct<id:bigint,kind:string,flux:double>", "array<double>")
    return f.select("id", "kind", "flux", F.get("coordinates", F.lit(0)).alias("lon"), F.get("coordinates", F.lit(1)).alias("lat"))


@query(
    "latest_snapshot",
    """SELECT l_orderkey, l_partkey, CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem WHERE CAST(l_shipdate AS DATE) = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_returnflag = 'A')""",
)
def latest_snapshot(spark, d):
    t = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("snapshot_date"), F.when(F.col("l_returnflag") == "A", 1).alias("checked")
    )
    return scans.latest_snapshot(t, require="checked").drop("checked")


@query("file_index", """SELECT n_name AS key, 0 AS root FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_name, 1 FROM nation WHERE n_nationkey % 2 = 1""")
def file_index(spark, d):
    """One folder per nation under two roots; the first root wins where both have the key."""
    first, second = scratch_path(spark, "root-a"), scratch_path(spark, "root-b")
    rows = fx.table(spark, d, "customer").join(fx.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    keyed = rows.select("n_nationkey", F.col("n_name").alias("key"), "c_custkey")
    keyed.where("n_nationkey % 2 = 0").write.partitionBy("key").parquet(first)
    keyed.write.partitionBy("key").parquet(second)
    index = scans.file_index(spark, [first, second], "*.parquet", "key=([A-Z_0-9]+)", whole_path=True)
    return index.select(F.upper("key").alias("key"), "root")


@query("manifest_scan", "SELECT split_part(url, '/', 3) AS folder, split_part(url, '/', -1) AS name, count(*) AS files FROM pages GROUP BY ALL")
def manifest_scan(spark, d):
    path = scratch_path(spark, "manifest")
    fx.table(spark, d, "pages").select(F.regexp_replace("url", "^https?://", "").alias("value")).write.text(path)
    return scans.manifest_counts(spark.read.text(path))


@query(
    "project_records",
    f"""WITH {fx.POINTS} SELECT id, kind, round(lon + 0.5, 6) AS lon, round(lat + 0.25, 6) AS lat FROM points WHERE flux >= 0""",
)
def project_records(spark, d):
    p = fx.points(spark, d)
    box = F.array(F.col("lon"), F.col("lat"), F.col("lon") + 1, F.col("lat") + 0.5)
    gas = F.when(F.col("flux") >= 0, "CH4").otherwise("CO2")
    record = F.to_json(F.struct("id", F.struct("kind", gas.alias("gas")).alias("properties"), box.alias("bounds")))
    raw = p.select(record.alias("record"))
    schema = "struct<id:bigint,properties:struct<kind:string,gas:string>,bounds:array<double>>"
    out = scans.project_records(raw, "record", schema, {"id": "id", "kind": "properties.kind", "gas": "properties.gas"}, "bounds")
    return rounded(out.where("gas = 'CH4'").drop("gas"), 6)


@query("read_level0", "SELECT c_custkey AS id, 'C' || c_nationkey AS country, c_acctbal AS flux FROM customer")
def read_level0(spark, d):
    path = scratch_path(spark, "level0")
    t = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("C"), "c_nationkey").alias("country"), F.col("c_acctbal").alias("flux"))
    t.write.partitionBy("country").parquet(path)
    return scans.read_level0(spark, path, ["id", "country", "flux"])


@query(
    "flatten_levels",
    """SELECT c_custkey AS id, c_name, max(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT", max(o_orderkey) FILTER (o_orderpriority = '5-LOW') AS "5-LOW" FROM customer LEFT JOIN (SELECT o_custkey, o_orderpriority, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) ON o_custkey = c_custkey GROUP BY ALL""",
)
def flatten_levels(spark, d):
    level0 = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    level1 = fx.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("leaf")).agg(F.max("o_orderkey").alias("path"))
    return scans.flatten_levels(level0, level1, "id", "leaf", "path", ["1-URGENT", "5-LOW"])


@query(
    "leaf_index",
    """WITH l AS (SELECT o_custkey AS id, o_orderpriority AS leaf, min(o_orderkey) AS o FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY ALL)
    SELECT id, count(*) :: INTEGER AS n, min(o) FILTER (leaf = '2-HIGH') AS offset FROM l GROUP BY id HAVING count(*) = 3""",
)
def leaf_index(spark, d):
    level1 = fx.table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("leaf"), F.col("o_orderkey").alias("offset"), F.col("o_totalprice").alias("size")
    )
    ix = scans.leaf_index(level1, "id", ["1-URGENT", "2-HIGH", "5-LOW"])
    return ix.select("id", F.size("leaves").alias("n"), F.element_at("leaves", "2-HIGH")["offset"].alias("offset"))


def _tiles(spark, d, tile=4):
    px = fx.pixels(spark, d).select("scene", "row", "col", "band", "value")
    return sinks.pixels_to_tiles(px, "radiance", -9999.0, tile)


def _written(spark, d, tile=4):
    return sinks.write_tiles(_tiles(spark, d, tile), scratch_path(spark, "layers"), "float32", -9999.0, "shifted spectra")


@query(
    "read_raster_layer",
    f"WITH {fx.PIXELS} SELECT scene, band, row, col, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 5) AS value FROM pixels WHERE band IN (3, 7, 11) AND row BETWEEN 2 AND 6 AND col BETWEEN 1 AND 8",
)
def read_raster_layer(spark, d):
    tiles, _ = _written(spark, d)
    px = scans.raster_layer(tiles, "radiance", bands=[3, 7, 11], window=(2, 1, 5, 8), nodata=-9999.0, tile=4)
    return px.withColumn("value", F.round(F.col("value").cast("double"), 5))


@query(
    "read_cube_blocks",
    f"WITH {fx.PIXELS} SELECT scene, CAST(band // 16 AS INTEGER) AS block, count(*) AS pixels, round(CAST(min(CAST(value AS FLOAT)) AS DOUBLE), 5) AS low, round(CAST(max(CAST(value AS FLOAT)) AS DOUBLE), 5) AS high FROM pixels GROUP BY ALL",
)
def read_cube_blocks(spark, d):
    tiles, _ = _written(spark, d)
    px = scans.raster_layer(tiles, "radiance", nodata=-9999.0, tile=4)
    return px.groupBy("scene", F.floor(F.col("band") / 16).cast("int").alias("block")).agg(
        F.count("*").alias("pixels"), F.round(F.min("value").cast("double"), 5).alias("low"), F.round(F.max("value").cast("double"), 5).alias("high")
    )


@query(
    "load_swir_window",
    f"WITH {fx.PIXELS} SELECT scene, row, col, band, round(value, 6) AS value FROM pixels WHERE 1000 + band * 25.0 BETWEEN 2122 AND 2488",
)
def load_swir_window(spark, d):
    px = fx.pixels(spark, d).select("scene", "row", "col", "band", "value")
    bands = px.select("band").distinct().withColumn("wavelength", 1000 + F.col("band") * 25.0)
    return rounded(scans.band_window(px, bands, 2122.0, 2488.0))


@query(
    "pixel_geolocation",
    f"""WITH {fx.SPECTRA}, g AS (SELECT scene, row * 2 AS orow, col AS ocol, CASE WHEN row % 3 = 0 THEN 0 ELSE 10 - col END AS gx, row + 1 AS gy FROM spectra)
    SELECT g.scene, orow, ocol, round(s.spectrum[1] :: DOUBLE, 6) AS value FROM g JOIN spectra s ON s.scene = g.scene AND s.row = gy - 1 AND s.col = gx - 1 WHERE gx > 0""",
)
def pixel_geolocation(spark, d):
    s = fx.spectra(spark, d)
    glt = s.select(
        "scene", (F.col("row") * 2).alias("orow"), F.col("col").alias("ocol"),
        F.when(F.col("row") % 3 == 0, 0).otherwise(10 - F.col("col")).alias("glt_x"), (F.col("row") + 1).alias("glt_y"),
    )
    px = s.select("scene", "row", "col", F.get("spectrum", F.lit(0)).cast("double").alias("value"))
    return rounded(scans.ortho_image(glt, px))


@query(
    "optional_layer_read",
    f"WITH {fx.SPECTRA} SELECT 'radiance' AS layer, scene, 64 * count(DISTINCT (row // 4, col // 4)) AS tiles FROM spectra GROUP BY scene",
)
def optional_layer_read(spark, d):
    tiles = _tiles(spark, d)
    return scans.optional_layers(tiles, ["mf", "radiance", "rmf"]).groupBy("layer", "scene").agg(F.count("*").alias("tiles"))


@query("write_parquet_table", "SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1")
def write_parquet_table(spark, d):
    g = fx.table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return sinks.write_table(g, scratch_path(spark, "step"))


@query(
    "append_dated_snapshot",
    """SELECT c_custkey, c_acctbal, 'a' AS source, DATE '2024-05-01' AS snapshot_date FROM customer UNION ALL SELECT c_custkey, c_acctbal, 'a', DATE '2024-05-02' FROM customer WHERE c_acctbal > 0""",
)
def append_dated_snapshot(spark, d):
    path = scratch_path(spark, "snapshots")
    c = fx.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    day = dt.date(2024, 5, 1)
    sinks.ensure_snapshot(spark, path, "a", lambda: c, day)
    # The same day again leaves the snapshot alone.
    sinks.ensure_snapshot(spark, path, "a", lambda: c.limit(0), day)
    return sinks.ensure_snapshot(spark, path, "a", lambda: c.where("c_acctbal > 0"), dt.date(2024, 5, 2))


@query("write_canonical_columns", """SELECT 's' || c_custkey AS id, c_acctbal AS "detection:a_flux_max", c_mktsegment AS "site:country", c_nationkey AS extra FROM customer""")
def write_canonical_columns(spark, d):
    t = fx.table(spark, d, "customer").select(
        F.col("c_nationkey").alias("extra"), F.col("c_mktsegment").alias("site:country"), F.col("c_acctbal").alias("detection:a_flux_max"),
        F.concat(F.lit("s"), "c_custkey").alias("id"),
    )
    return sinks.write_table(schemas.canonical(t, schemas.level0_schema()), scratch_path(spark, "canonical"))


@query("write_partitioned_collection", """SELECT c_mktsegment AS part, count(*) AS samples, count(*) AS indexed FROM customer GROUP BY 1""")
def write_partitioned_collection(spark, d):
    c = fx.table(spark, d, "customer").withColumnRenamed("c_mktsegment", "site:country")
    parts, index = sinks.write_collection(c, scratch_path(spark, "collection"), "site:country", ["c_custkey"])
    a = parts.groupBy(F.col("_part").alias("part")).agg(F.count("*").alias("samples"))
    return a.join(index.groupBy(F.col("_part").alias("part")).agg(F.count("*").alias("indexed")), "part")


@query("resumable_step", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'first' ELSE 'second' END AS run, o_totalprice * 2 AS doubled FROM orders""")
def resumable_step(spark, d):
    path = scratch_path(spark, "resume")
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    work = lambda name: lambda t: t.select("o_orderkey", F.lit(name).alias("run"), (F.col("o_totalprice") * 2).alias("doubled"))
    sinks.resumable_step(o.where("o_orderkey % 3 = 0"), path, "o_orderkey", work("first"))
    return sinks.resumable_step(o, path, "o_orderkey", work("second"))


@query("write_csv_report", "SELECT p_type AS kind, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY 1")
def write_csv_report(spark, d):
    path = scratch_path(spark, "report")
    g = fx.table(spark, d, "part").groupBy(F.col("p_type").alias("kind")).agg(F.count("*").alias("n"), F.round(F.avg("p_retailprice"), 4).alias("mean"))
    sinks.write_csv(g, path)
    return scans.csv_catalog(spark, path, "kind string, n bigint, mean double")


@query("write_geojson", f"WITH {fx.POINTS} SELECT 'Feature' AS type, id, round(lon, 6) AS lon FROM points")
def write_geojson(spark, d):
    path = scratch_path(spark, "geojson")
    sinks.write_geojson(fx.points(spark, d), path, "lon", "lat", ["id"])
    rows = spark.read.text(path)
    return rows.select(
        F.get_json_object("value", "$.type").alias("type"),
        F.get_json_object("value", "$.properties.id").cast("bigint").alias("id"),
        F.round(F.get_json_object("value", "$.geometry.coordinates[0]").cast("double"), 6).alias("lon"),
    )


@query(
    "write_matrix_json",
    """WITH m AS (SELECT l_returnflag AS g, l_linenumber - 1 AS i, CAST(l_quantity AS INT) % 7 AS j, max(l_quantity) AS v FROM lineitem WHERE l_linenumber <> CAST(l_quantity AS INT) % 7 + 1 GROUP BY ALL),
      f AS (SELECT g, i, j, v FROM (SELECT DISTINCT g FROM m) CROSS JOIN (SELECT unnest(range(7)) AS i) CROSS JOIN (SELECT unnest(range(7)) AS j) LEFT JOIN m USING (g, i, j)),
      r AS (SELECT g, i, '[' || string_agg(coalesce(CAST(v AS VARCHAR), 'null'), ',' ORDER BY j) || ']' AS row FROM f GROUP BY ALL)
    SELECT g, '[' || string_agg(row, ',' ORDER BY i) || ']' AS matrix FROM r GROUP BY g""",
)
def write_matrix_json(spark, d):
    m = fx.table(spark, d, "lineitem").where("l_linenumber <> cast(l_quantity as int) % 7 + 1").groupBy(
        F.col("l_returnflag").alias("g"), (F.col("l_linenumber") - 1).alias("i"), (F.col("l_quantity").cast("int") % 7).alias("j")
    ).agg(F.max("l_quantity").alias("v"))
    return sinks.matrix_json(m, "g", "i", "j", "v", 7)


@query(
    "write_tile_layer",
    f"""WITH {fx.SPECTRA} SELECT 'radiance' AS layer, 'float32' AS dtype, -9999.0 :: DOUBLE AS nodata, 'shifted spectra' AS description, (SELECT sum(n) :: BIGINT FROM (SELECT 64 * count(DISTINCT (row // 4, col // 4)) AS n FROM spectra GROUP BY scene)) AS tiles""",
)
def write_tile_layer(spark, d):
    tiles, layers = _written(spark, d)
    return layers.join(tiles.groupBy("layer").agg(F.count("*").alias("tiles")), "layer")
