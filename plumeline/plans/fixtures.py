"""The driver tables seen as catalogues, pixels, masks and volumes, in Spark and in SQL.

Each view exists twice: a function returning a DataFrame, and a SQL text used as a common table
expression in the check queries. The mapping is described in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.operators.spread import parts_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- catalogue A: one row per plume, granule = customer, source = supplier ------------------

FLUX_A = (
    "CASE WHEN l_discount = 0 AND l_tax = 0 THEN NULL ELSE round(l_extendedprice / 10, 3) END"
)

PLUMES_A = f"""
plumes_a AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id_plume,
         o_custkey AS granule, l_suppkey AS source, {FLUX_A} AS flux,
         CAST(l_shipdate AS DATE) AS day, n_name AS country, r_name AS region,
         l_returnflag AS flag, l_linenumber AS line, l_quantity AS qty
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def plumes_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id_plume"),
            F.col("o_custkey").alias("granule"),
            F.col("l_suppkey").alias("source"),
            F.expr(FLUX_A).alias("flux"),
            F.to_date("l_shipdate").alias("day"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linenumber").alias("line"),
            F.col("l_quantity").alias("qty"),
        )
    )


def line_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions for the rows of ``lineitem``, whose number its files' footers hold."""
    return parts_of(spark, table(spark, sf_dir, "lineitem").count())


def catalogue_a(spark: SparkSession, sf_dir: str, by_tile: bool = False) -> DataFrame:
    """Catalogue A without the country dimensions: two tables, one join.

    With ``by_tile``, a tile's rows are in one of partitions whose number grows with the table, so that
    what a task holds to group them by tile does not.
    """
    lines, tiles = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if by_tile:
        # A packed file of orders looks small enough to be broadcast long after its hash table is not.
        lines, tiles = lines.repartition(line_parts(spark, sf_dir), "l_orderkey"), tiles.hint("merge")
    return (
        lines.join(tiles, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id_plume"),
            F.col("o_custkey").alias("granule"),
            F.col("l_suppkey").alias("source"),
            F.expr(FLUX_A).alias("flux"),
            F.to_date("l_shipdate").alias("day"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linenumber").alias("line"),
            F.col("l_quantity").alias("qty"),
            F.col("o_orderkey").alias("tile"),
            F.to_date("o_orderdate").alias("tile_day"),
        )
    )


CATALOGUE_A = f"""
catalogue_a AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id_plume,
         o_custkey AS granule, l_suppkey AS source, {FLUX_A} AS flux,
         CAST(l_shipdate AS DATE) AS day, l_returnflag AS flag, l_linenumber AS line,
         l_quantity AS qty, o_orderkey AS tile, CAST(o_orderdate AS DATE) AS tile_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# --- catalogue B: events, granule = user ------------------------------------------------------

PLUMES_B = """
plumes_b AS (
  SELECT event_id AS plume_id, user_id AS granule, value AS flux, event_type AS kind,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) AS k, ts
  FROM events)"""


def plumes_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("plume_id"),
        F.col("user_id").alias("granule"),
        F.col("value").alias("flux"),
        F.col("event_type").alias("kind"),
        F.from_json("props", "k int").getField("k").alias("k"),
        "ts",
    )


# --- wind of an event: direction from k, speed from value -----------------------------------

WIND = """
wind AS (
  SELECT plume_id, granule, kind, ts, flux, k, flux / 25 AS speed, k * 3.6 AS direction
  FROM plumes_b)"""


def wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plumes_b(spark, sf_dir).select(
        "plume_id",
        "granule",
        "kind",
        "ts",
        "flux",
        "k",
        (F.col("flux") / 25).alias("speed"),
        (F.col("k") * F.lit(3.6)).alias("direction"),
    )


# --- points: parts and suppliers placed on the globe ----------------------------------------

POINTS = """
points AS (
  SELECT c_custkey AS id, c_nationkey AS country, c_mktsegment AS kind,
         (c_custkey * 37 % 3600) / 10.0 - 180 AS lon, (c_custkey * 91 % 1600) / 10.0 - 80 AS lat,
         c_acctbal AS flux
  FROM customer)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("country"),
        F.col("c_mktsegment").alias("kind"),
        ((F.col("c_custkey") * 37 % 3600) / F.lit(10.0) - 180).alias("lon"),
        ((F.col("c_custkey") * 91 % 1600) / F.lit(10.0) - 80).alias("lat"),
        F.col("c_acctbal").alias("flux"),
    )


# --- pixels: embeddings as spectra on a grid of ten columns ---------------------------------

SPECTRA = """
spectra AS (
  SELECT CAST(vec_id % 5 AS INT) AS scene, CAST((vec_id // 5) // 10 AS INT) AS row,
         CAST((vec_id // 5) % 10 AS INT) AS col, label,
         CASE WHEN label >= 7 THEN 1 ELSE 0 END AS mask, embedding AS spectrum
  FROM embeddings)"""

PIXELS = (
    SPECTRA
    + """,
pixels AS (
  SELECT scene, row, col, label, mask, CAST(i - 1 AS INTEGER) AS band, CAST(spectrum[i] AS DOUBLE) + 1 AS value
  FROM spectra, range(1, 65) t(i))"""
)


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.floor(F.col("vec_id") / 5)
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 5).cast("int").alias("scene"),
        F.floor(cell / 10).cast("int").alias("row"),
        (cell % 10).cast("int").alias("col"),
        "label",
        F.when(F.col("label") >= 7, 1).otherwise(0).alias("mask"),
        F.col("embedding").alias("spectrum"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form; values shifted by one so that band ratios stay positive."""
    return spectra(spark, sf_dir).select(
        "scene", "row", "col", "label", "mask", F.posexplode("spectrum").alias("band", "v")
    ).select(
        "scene", "row", "col", "label", "mask", "band", (F.col("v").cast("double") + 1).alias("value")
    )


# --- masks: parts and quantities as pixels of two catalogues ----------------------------------

MASKS = """
masks AS (
  SELECT DISTINCT l_suppkey AS scene, CASE WHEN l_returnflag = 'A' THEN 'a' ELSE 'b' END AS side,
         l_linenumber AS plume, CAST(l_partkey % 12 AS INT) AS row,
         CAST(l_quantity AS INT) % 12 AS col
  FROM lineitem WHERE l_returnflag IN ('A', 'R'))"""


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag").isin("A", "R"))
        .select(
            F.col("l_suppkey").alias("scene"),
            F.when(F.col("l_returnflag") == "A", "a").otherwise("b").alias("side"),
            F.col("l_linenumber").alias("plume"),
            (F.col("l_partkey") % 12).cast("int").alias("row"),
            (F.col("l_quantity").cast("int") % 12).alias("col"),
        )
        .repartition(line_parts(spark, sf_dir), "scene", "side", "plume", "row", "col")
        .distinct()
    )


# --- volumes: voxels (level, row, col) from line items ---------------------------------------

VOXELS = """
voxels AS (
  SELECT l_suppkey % 10 AS volume, l_linenumber AS level, CAST(l_quantity AS INT) AS row,
         CAST(l_partkey % 40 AS INT) AS col, sum(l_extendedprice) / 1000 AS ppb
  FROM lineitem GROUP BY ALL)"""


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_suppkey") % 10).alias("volume"),
            F.col("l_linenumber").alias("level"),
            F.col("l_quantity").cast("int").alias("row"),
            (F.col("l_partkey") % 40).cast("int").alias("col"),
        )
        .agg((F.sum("l_extendedprice") / 1000).alias("ppb"))
    )


# --- reference candidates: pairs of orders of one customer ------------------------------------

TARGETS = """
targets AS (
  SELECT o_orderkey AS target, o_custkey AS site, CAST(o_orderdate AS DATE) AS day,
         o_orderpriority AS platform
  FROM orders WHERE o_orderstatus = 'F'),
candidates AS (
  SELECT o_orderkey AS candidate, o_custkey AS site, CAST(o_orderdate AS DATE) AS day,
         o_totalprice / 500000 AS cloud, o_totalprice % 1000 / 1000 AS difference,
         o_orderpriority AS platform
  FROM orders WHERE o_orderstatus <> 'F')"""


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_orderkey").alias("target"),
            F.col("o_custkey").alias("site"),
            F.to_date("o_orderdate").alias("day"),
            F.col("o_orderpriority").alias("platform"),
        )
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") != "F")
        .select(
            F.col("o_orderkey").alias("candidate"),
            F.col("o_custkey").alias("site"),
            F.to_date("o_orderdate").alias("day"),
            (F.col("o_totalprice") / 500000).alias("cloud"),
            (F.col("o_totalprice") % 1000 / 1000).alias("difference"),
            F.col("o_orderpriority").alias("platform"),
        )
    )


# --- scores: documents with a class label ------------------------------------------------------

SCORES = """
scores AS (
  SELECT d.doc_id AS id, d.source AS site, d.lang AS sensor, ln(1 + d.n_chars) AS score,
         d.n_chars AS size, l.quality AS y, l.toxic AS y2
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "source", "lang", "n_chars")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(
            F.col("doc_id").alias("id"),
            F.col("source").alias("site"),
            F.col("lang").alias("sensor"),
            F.ln(1 + F.col("n_chars")).alias("score"),
            F.col("n_chars").alias("size"),
            F.col("quality").alias("y"),
            F.col("toxic").alias("y2"),
        )
    )




# --- scenes: one row per order with its plume counts and the four selection axes ---------------

SCENES = f"""
{CATALOGUE_A.strip()},
scenes AS (
  SELECT tile AS scene, year(any_value(o_orderdate)) AS year, any_value(r_name) AS region,
         any_value(n_name) AS country, any_value(o_orderpriority) AS sector, count(*) AS n_plumes,
         count(*) FILTER (flux > 0 AND flux < 1000) AS n_weak,
         count(*) FILTER (flux >= 1000) AS n_strong, count(DISTINCT a.source) AS n_sources,
         max(flux) AS flux_max,
         CASE WHEN count(*) FILTER (flux > 0 AND flux < 1000) > 0 THEN 'has_weak' ELSE 'strong_only' END AS flux_bin
  FROM catalogue_a a JOIN orders ON tile = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY tile)"""


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    weak = (F.col("flux") > 0) & (F.col("flux") < 1000)
    plumes = (
        catalogue_a(spark, sf_dir)
        .groupBy("tile")
        .agg(
            F.count(F.lit(1)).alias("n_plumes"),
            F.count_if(weak).alias("n_weak"),
            F.count_if(F.col("flux") >= 1000).alias("n_strong"),
            F.count_distinct("source").alias("n_sources"),
            F.max("flux").alias("flux_max"),
        )
    )
    return (
        plumes.join(table(spark, sf_dir, "orders"), F.col("tile") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("tile").alias("scene"),
            F.year("o_orderdate").alias("year"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.col("o_orderpriority").alias("sector"),
            "n_plumes",
            "n_weak",
            "n_strong",
            "n_sources",
            "flux_max",
            F.when(F.col("n_weak") > 0, "has_weak").otherwise("strong_only").alias("flux_bin"),
        )
    )
