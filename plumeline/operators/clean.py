"""Filters, recodes, rounding and null rules on whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Platform presets (family, label, first day, number of bands).
SENSOR_PRESETS = (
    ("LC08", "landsat", "LC08", "2013-03-18", 11),
    ("LC09", "landsat", "LC09", "2021-10-31", 11),
    ("S2A", "s2", "S2", "2015-06-27", 13),
    ("S2B", "s2", "S2", "2015-06-27", 13),
    ("S2C", "s2", "S2", "2015-06-27", 13),
)

# Fixed value: largest share of mass outside the plume a snapshot may have.
FOREIGN_MASS_LIMIT = 0.002


def drop_incomplete_groups(df: DataFrame, key: str, bad: Column) -> DataFrame:
    """Drop every group that holds at least one bad row."""
    return df.join(df.where(bad).select(key).distinct(), key, "left_anti")


def keep_keys(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def recode_by_table(
    df: DataFrame, table: DataFrame, key: str, value: str, default: str, override: DataFrame | None = None
) -> DataFrame:
    """Left join a (key, value) dimension; misses take the default, an override table wins."""
    out = df.join(table.select(key, F.col(value).alias("_v")), key, "left")
    new = F.coalesce(F.col("_v"), F.lit(default))
    if override is not None:
        out = out.join(override.select(key, F.col(value).alias("_o")), key, "left")
        new = F.coalesce(F.col("_o"), new)
    return out.withColumn(value, new).drop("_v", "_o")


def first_existing(df: DataFrame, names: Sequence[str]) -> Column:
    """Coalesce over those of the names the table has."""
    present = [F.col(f"`{n}`") for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None)


def migrate_columns(
    df: DataFrame, renames: Mapping[str, str], drops: Iterable[str], drop_prefix: str = "internal:"
) -> DataFrame:
    """Rename, drop a list, drop every column under a prefix."""
    gone = set(drops) | {c for c in df.columns if c.startswith(drop_prefix)}
    kept = [c for c in df.columns if c not in gone]
    return df.select(*[F.col(f"`{c}`").alias(renames.get(c, c)) for c in kept])


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Half-even rounding of the named columns in one projection."""
    return df.select(
        *[F.bround(F.col(f"`{c}`"), digits[c]).alias(c) if c in digits else F.col(f"`{c}`") for c in df.columns]
    )


def null_policy(df: DataFrame, counts: Sequence[str] = (), texts: Mapping[str, str] | None = None) -> DataFrame:
    """NaN becomes null, missing counts 0, missing texts their default."""
    texts = texts or {}
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        if field.name in counts:
            c = F.coalesce(c, F.lit(0).cast(field.dataType))
        if field.name in texts:
            c = F.coalesce(c, F.lit(texts[field.name]))
        out.append(c.alias(field.name))
    return df.select(*out)


def cast_to(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """The columns of a schema, in its order and types; absent ones are null."""
    out = []
    for field in schema.fields:
        if field.name not in df.columns:
            c = F.lit(None).cast(field.dataType)
        elif strict:
            c = F.col(f"`{field.name}`").cast(field.dataType)
        else:
            c = F.col(f"`{field.name}`").try_cast(field.dataType)
        out.append(c.alias(field.name))
    return df.select(*out)


def criteria_flags(
    df: DataFrame,
    slope: Column,
    edge: Column,
    interior_min: Column,
    entry: Column,
    peak: Column,
    side_max: Column,
    foreign_share: Column,
    edge_width: Column,
    entry_share: float = 0.02,
    side_share: float = 0.02,
    width_limit: float = 60.0,
) -> DataFrame:
    """Five pass flags of a snapshot and their conjunction; a null share does not pass."""
    flags = {
        "fades": (slope < 0) & (edge < interior_min),
        "upwind_ok": entry < entry_share * peak,
        "sides_ok": side_max < side_share * peak,
        "foreign_ok": foreign_share < FOREIGN_MASS_LIMIT,
        "width_ok": edge_width <= width_limit,
    }
    flags = {n: F.coalesce(c, F.lit(False)) for n, c in flags.items()}
    every = F.lit(True)
    for c in flags.values():
        every = every & c
    return df.select("*", *[c.alias(n) for n, c in flags.items()], every.alias("passes"))


def sensor_preset(df: DataFrame, platform: str) -> DataFrame:
    """Family, label, first day and band count of a platform; any S2 name uses the S2A preset."""
    table = df.sparkSession.createDataFrame(
        SENSOR_PRESETS, "_p string, family string, label string, earliest string, bands int"
    )
    known = [p[0] for p in SENSOR_PRESETS]
    key = F.when(F.col(platform).isin(*known), F.col(platform)).when(
        F.col(platform).startswith("S2"), F.lit("S2A")
    )
    return (
        df.withColumn("_k", key)
        .join(F.broadcast(table), F.col("_k") == F.col("_p"), "left")
        .drop("_k", "_p")
    )


def catalog_sql(df: DataFrame, statement: str, name: str = "level0") -> DataFrame:
    """Run SQL on a table under a view name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(statement)


def faceted_filter(
    df: DataFrame,
    sensors: Sequence[str] = (),
    systems: Sequence[str] = (),
    matches: Sequence[str] = (),
    country: str | None = None,
    years: tuple[int, int] | None = None,
    min_flux: float = 0.0,
    imaging: str = "imaging",
    skip: str | None = None,
) -> Column:
    """One predicate from the set facets; ``skip`` leaves one facet out.

    System and match lists apply to the imaging sensor only, and a null match passes.
    """
    cond = F.lit(True)
    other = F.col("sensor") != imaging
    if sensors and skip != "sensor":
        cond = cond & F.col("sensor").isin(*sensors)
    if systems and skip != "system":
        cond = cond & (other | F.col("system").isin(*systems))
    if matches and skip != "match":
        cond = cond & (other | F.col("match").isNull() | F.col("match").isin(*matches))
    if country and skip != "country":
        cond = cond & (F.col("country") == country)
    if years and skip != "year":
        cond = cond & F.substring("date", 1, 4).try_cast("int").between(*years)
    if min_flux and skip != "flux":
        cond = cond & (F.coalesce(F.col("flux"), F.lit(0.0)) >= min_flux)
    return cond


def require_slots(df: DataFrame, slots: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for s in slots:
        cond = cond & F.col(s).isNotNull()
    return df.where(cond)
