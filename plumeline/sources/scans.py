"""Reading catalogues, manifests, feature files, snapshots and tiled layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.functions.text import TIMESTAMP_KEY, extract_key

TILE = 128


def csv_catalog(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A catalogue with a header row and declared types; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def parquet_catalog(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns])


FEATURE = "struct<type:string,geometry:struct<type:string,coordinates:{coords}>,properties:{props}>"


def geojson_features(
    spark: SparkSession, path: str, properties: str, coordinates: str = "array<array<array<double>>>", per_line: bool = True
) -> DataFrame:
    """One row per feature with its properties and coordinates.

    A file with one feature per line is read by all tasks at once; wrapper lines and trailing commas
    are skipped. A file written as a single document is parsed whole, one document per task.
    """
    kind = FEATURE.format(coords=coordinates, props=properties)
    if per_line:
        line = F.regexp_replace(F.trim("value"), ",$", "")
        rows = spark.read.text(path).select(F.from_json(line, kind).alias("f")).where("f.type = 'Feature'")
    else:
        whole = spark.read.schema(f"features array<{kind}>").option("multiLine", True).json(path)
        rows = whole.select(F.explode("features").alias("f"))
    return rows.select("f.properties.*", F.col("f.geometry.coordinates").alias("coordinates"))


def latest_snapshot(df: DataFrame, day: str = "snapshot_date", require: str | None = None) -> DataFrame:
    """Rows of the newest snapshot, or of the newest one in which a column has values."""
    have = df if require is None else df.where(F.col(require).isNotNull())
    return df.where(F.col(day) == have.agg(F.max(day)).scalar())


def file_index(
    spark: SparkSession, roots: Sequence[str], glob: str, pattern: str = TIMESTAMP_KEY, whole_path: bool = False
) -> DataFrame:
    """Key and path of every file under several roots; the first root that has a key wins.

    Only names are read. The key comes from the file name, or from the whole path.
    """
    name = F.col("path") if whole_path else F.element_at(F.split("path", "/"), -1)
    out = None
    for priority, root in enumerate(roots):
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
        )
        part = files.select(extract_key(name, pattern).alias("key"), "path", F.lit(priority).alias("root"))
        out = part if out is None else out.unionByName(part)
    found = out.where("key is not null")
    return found.groupBy("key").agg(F.min(F.struct("root", "path")).alias("b")).select("key", "b.path", "b.root")


def manifest_counts(lines: DataFrame) -> DataFrame:
    """Files per top folder and file name of a text manifest, one path per line."""
    parts = F.split("value", "/")
    return lines.groupBy(F.get(parts, F.lit(0)).alias("folder"), F.element_at(parts, -1).alias("name")).agg(F.count(F.lit(1)).alias("files"))


def project_records(df: DataFrame, record: str, schema: str, keep: Mapping[str, str], bounds: str | None = None) -> DataFrame:
    """Named fields of nested JSON records, with the centre of a [west, south, east, north] box."""
    parsed = df.withColumn("_r", F.from_json(record, schema))
    out = [F.col(f"_r.{path}").alias(name) for name, path in keep.items()]
    if bounds is not None:
        b = F.col(f"_r.{bounds}")
        out += [((b[0] + b[2]) / 2).alias("lon"), ((b[1] + b[3]) / 2).alias("lat")]
    return parsed.select(*out)


def read_level0(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scene tables of all partitions of a collection, stacked."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df if columns is None else df.select(*[F.col(f"`{c}`") for c in columns])


def flatten_levels(level0: DataFrame, level1: DataFrame, key: str, leaf: str, value: str, leaves: Sequence[str]) -> DataFrame:
    """Samples with one column per leaf holding its address."""
    picks = [F.first(F.when(F.col(leaf) == name, F.col(value)), ignorenulls=True).alias(name) for name in leaves]
    return level0.join(level1.groupBy(key).agg(*picks), key, "left")


def leaf_index(level1: DataFrame, key: str, required: Sequence[str]) -> DataFrame:
    """Map of leaf to (offset, size) for samples that own every required leaf.

    A sample has a handful of leaves; others of the same sample are left out before gathering.
    """
    rows = level1.where(F.col("leaf").isin(*required)).groupBy(key, "leaf").agg(F.min(F.struct("offset", "size")).alias("at"))
    entries = F.array_sort(F.collect_list(F.struct("leaf", "at")))
    g = rows.groupBy(key).agg(F.map_from_entries(entries).alias("leaves"))
    return g.where(F.size("leaves") == len(required))


def raster_layer(
    tiles: DataFrame,
    layer: str,
    bands: Sequence[int] | None = None,
    window: tuple[int, int, int, int] | None = None,
    nodata: float | None = None,
    tile: int = TILE,
) -> DataFrame:
    """Pixels of a layer from its tiles: bands and a (row, col, height, width) window cut first.

    Tiles outside the window are skipped by their row and column number before they are unpacked.
    """
    df = tiles.where(F.col("layer") == layer)
    if bands is not None:
        df = df.where(F.col("band").isin(*bands))
    if window is not None:
        r, c, h, w = window
        df = df.where(F.col("tile_row").between(r // tile, (r + h - 1) // tile) & F.col("tile_col").between(c // tile, (c + w - 1) // tile))
    px = df.select("scene", "band", "tile_row", "tile_col", F.posexplode("values").alias("_i", "_v"))
    value = F.col("_v") if nodata is None else F.when(F.col("_v") != nodata, F.col("_v"))
    px = px.select(
        "scene",
        "band",
        (F.col("tile_row") * tile + F.floor(F.col("_i") / tile)).cast("int").alias("row"),
        (F.col("tile_col") * tile + F.col("_i") % tile).cast("int").alias("col"),
        value.alias("value"),
    ).where("value is not null")
    if window is not None:
        r, c, h, w = window
        px = px.where(F.col("row").between(r, r + h - 1) & F.col("col").between(c, c + w - 1))
    return px


def band_window(df: DataFrame, bands: DataFrame, low: float, high: float) -> DataFrame:
    """Rows of the bands whose wavelength lies in a window; ``bands`` is the sensor's band table."""
    keep = bands.where(F.col("wavelength").between(low, high)).select("band")
    return df.join(keep, "band", "left_semi")


def ortho_image(glt: DataFrame, pixels: DataFrame) -> DataFrame:
    """Ortho grid (scene, orow, ocol, glt_x, glt_y) filled from the sensor pixels it points to; 0 is none."""
    ask = glt.where("glt_x > 0 and glt_y > 0").select(
        "scene", "orow", "ocol", (F.col("glt_y") - 1).alias("row"), (F.col("glt_x") - 1).alias("col")
    )
    return ask.join(pixels, ["scene", "row", "col"]).drop("row", "col")


def optional_layers(tiles: DataFrame, names: Sequence[str]) -> DataFrame:
    """Tiles of whichever of the layers exist."""
    return tiles.where(F.col("layer").isin(*names))


