"""Writing step outputs, snapshots, collections, reports, feature files and tiles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.sources.scans import TILE


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a step's output and hand back the written table, which the next step reads."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def ensure_snapshot(
    spark: SparkSession, path: str, source: str, make: Callable[[], DataFrame], day: dt.date | None = None
) -> DataFrame:
    """Dated snapshot of a source: made once per day, never overwritten."""
    day = day or dt.date.today()
    leaf = f"{path}/source={source}/snapshot_date={day.isoformat()}"
    if not exists(spark, leaf):
        make().write.mode("errorifexists").parquet(leaf)
    return spark.read.parquet(path)


def write_collection(df: DataFrame, path: str, by: str, index: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Collection split by a column, with one index table over all parts."""
    spark = df.sparkSession
    safe = df.withColumn("_part", F.coalesce(F.col(f"`{by}`"), F.lit("unknown")))
    safe.write.mode("overwrite").partitionBy("_part").parquet(f"{path}/parts")
    safe.select(*[F.col(f"`{c}`") for c in index], "_part").write.mode("overwrite").parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/parts"), spark.read.parquet(f"{path}/index")


def resumable_step(todo: DataFrame, path: str, key: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Do only the keys not yet in the output, append them, return the whole output."""
    spark = todo.sparkSession
    if exists(spark, path):
        todo = todo.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    work(todo).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_geojson(df: DataFrame, path: str, lon: str, lat: str, properties: Sequence[str]) -> None:
    """One point feature per line; readers skip wrappers, so parts need none."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def matrix_json(df: DataFrame, group: str, i: str, j: str, value: str, n: int) -> DataFrame:
    """One JSON matrix per group with null where a pair has no value; n*n cells per group."""
    cell = F.when(~F.isnan(F.col(value)), F.col(value))
    rows = df.groupBy(group, i).agg(F.map_from_entries(F.collect_list(F.struct(F.col(j).alias("k"), cell.alias("v")))).alias("_m"))
    spread = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.try_element_at("_m", k.cast(df.schema[j].dataType)))
    lines = rows.select(group, i, spread.alias("_row"))
    whole = lines.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct(F.col(i).alias("k"), F.col("_row").alias("v")))).alias("_r"))
    blank = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.lit(None).cast("double"))
    full = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda k: F.coalesce(F.try_element_at("_r", k.cast(df.schema[i].dataType)), blank),
    )
    return whole.select(group, F.to_json(full).alias("matrix"))


def pixels_to_tiles(df: DataFrame, layer: str, nodata: float, tile: int = TILE) -> DataFrame:
    """Tile rows of a layer; absent pixels hold the nodata value. A tile has tile*tile cells."""
    place = (F.col("row") % tile * tile + F.col("col") % tile).cast("int")
    g = df.groupBy(
        "scene",
        F.lit(layer).alias("layer"),
        "band",
        F.floor(F.col("row") / tile).cast("int").alias("tile_row"),
        F.floor(F.col("col") / tile).cast("int").alias("tile_col"),
    ).agg(F.map_from_entries(F.collect_list(F.struct(place.alias("k"), F.col("value").cast("float").alias("v")))).alias("_m"))
    cells = F.transform(
        F.sequence(F.lit(0), F.lit(tile * tile - 1)), lambda k: F.coalesce(F.try_element_at("_m", k), F.lit(nodata).cast("float"))
    )
    return g.select("scene", "layer", "band", "tile_row", "tile_col", cells.alias("values"))


def write_tiles(tiles: DataFrame, path: str, dtype: str, nodata: float, description: str) -> tuple[DataFrame, DataFrame]:
    """Append tiles, and the layer's type, nodata and text to the layer table beside them."""
    spark = tiles.sparkSession
    tiles.repartitionByRange("scene", "layer", "band").sortWithinPartitions("scene", "layer", "band", "tile_row", "tile_col").write.mode(
        "append"
    ).partitionBy("layer").parquet(f"{path}/tiles")
    about = tiles.select("layer").distinct().select(
        "layer", F.lit(dtype).alias("dtype"), F.lit(nodata).alias("nodata"), F.lit(description).alias("description")
    )
    about.write.mode("append").parquet(f"{path}/layers")
    return spark.read.parquet(f"{path}/tiles"), spark.read.parquet(f"{path}/layers")
