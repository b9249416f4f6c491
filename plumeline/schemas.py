"""Declared tables: namespaces, columns, types, texts and order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

D, L, S, B = T.DoubleType(), T.LongType(), T.StringType(), T.BooleanType()


# Columns of the scene table in their published order; {a} and {b} are the catalogues.
LEVEL0_COLUMNS = [
    ("id", S, "key of the scene"),
    ("type", S, "leaf or folder"),
    ("detection:n_{a}", L, "plumes of {a}"),
    ("detection:n_{b}", L, "plumes of {b}"),
    ("detection:coverage_{a}", D, "% of the scene masked by {a}"),
    ("detection:coverage_{b}", D, "% of the scene masked by {b}"),
    ("detection:coverage_union", D, "% of the scene masked by any"),
    ("detection:{a}_ids", S, "ids in {a}, a JSON array"),
    ("detection:{b}_ids", S, "ids in {b}, a JSON array"),
    ("detection:{a}_flux", S, "kg/h by id in {a}, JSON"),
    ("detection:{b}_flux", S, "kg/h by id in {b}, JSON"),
    ("detection:sectors", S, "plumes by sector and catalogue, JSON"),
    ("detection:sector_list", S, "sectors that occur, a JSON array"),
    ("detection:sector", S, "most frequent sector"),
    ("detection:n_{a}_weak", L, "plumes of {a} below 1 t/h"),
    ("detection:n_{a}_strong", L, "plumes of {a} of 1 t/h and more"),
    ("detection:n_{b}_noflux", L, "plumes of {b} with unknown flux"),
    ("detection:n_{b}_dup_pairs", L, "pairs in {b} that overlap"),
    ("detection:{b}_dup_groups", S, "groups in {b} that overlap, JSON"),
    ("detection:{a}_flux_total", D, "kg/h, sum over {a}"),
    ("detection:{a}_flux_max", D, "kg/h, maximum over {a}"),
    ("detection:{b}_flux_total", D, "kg/h, sum over {b}"),
    ("detection:{b}_flux_max", D, "kg/h, maximum over {b}"),
    ("detection:{a}_cod", S, "codes in the mask by id in {a}, JSON"),
    ("detection:{b}_cod", S, "codes in the mask by id in {b}, JSON"),
    ("match:pairs", S, "ids of both catalogues that were paired, JSON"),
    ("match:orphans", S, "ids left without a partner, JSON"),
    ("match:n_pairs", L, "number of pairs"),
    ("match:n_perfect", L, "number of pairs free of duplicates"),
    ("match:n_orph_{a}", L, "number of {a} without a partner"),
    ("match:n_orph_{b}", L, "number of {b} without a partner"),
    ("sensor:shape_rows", L, "height in pixels"),
    ("sensor:shape_cols", L, "width in pixels"),
    ("target:sza", D, "sun, degrees from zenith"),
    ("target:vza", D, "sensor, degrees from zenith"),
    ("target:saa", D, "sun, degrees from north"),
    ("target:vaa", D, "sensor, degrees from north"),
    ("target:raa", D, "degrees between wind and sun"),
    ("sensor:amf", D, "air mass down and up"),
    ("sensor:phase", D, "degrees between sun and sensor"),
    ("sensor:path_length", D, "metres from sensor to ground"),
    ("sensor:earth_sun_distance", D, "in astronomical units"),
    ("meteo:wind_u", D, "m/s to the east"),
    ("meteo:wind_v", D, "m/s to the north"),
    ("meteo:wind_speed", D, "m/s"),
    ("meteo:{a}_wind", S, "wind by id as {a} states it, JSON"),
    ("meteo:{b}_wind", S, "wind by id as {b} states it, JSON"),
    ("emit:flight_line", S, "name of the overpass"),
    ("emit:time_start", S, "first moment of the scene"),
    ("emit:time_end", S, "last moment of the scene"),
    ("radiance:min", D, "minimum over all bands"),
    ("radiance:max", D, "maximum over all bands"),
    ("radiance:elev_min_m", D, "metres, minimum of the ground"),
    ("radiance:elev_max_m", D, "metres, maximum of the ground"),
    ("site:country", S, "where most of the scene lies"),
    ("spatial:bbox_west", D, "smallest longitude"),
    ("spatial:bbox_south", D, "smallest latitude"),
    ("spatial:bbox_east", D, "largest longitude"),
    ("spatial:bbox_north", D, "largest latitude"),
    ("spatial:{a}_points", S, "positions in {a}, well-known text"),
    ("spatial:{b}_points", S, "positions in {b}, well-known text"),
    ("selection:split", S, "part of the collection"),
    ("selection:is_free", B, "checked to hold no plume"),
    ("selection:flux_bin", S, "class of flux"),
]


# Decimals of the scene table's columns, by namespace and name.
LEVEL0_DIGITS = {
    1: ("sensor:path_length",),
    2: ("detection:{a}_flux_total", "detection:{a}_flux_max", "detection:{b}_flux_total", "detection:{b}_flux_max"),
    3: (
        "target:sza", "target:vza", "target:saa", "target:vaa", "target:raa", "sensor:amf", "sensor:phase",
        "meteo:wind_u", "meteo:wind_v", "meteo:wind_speed", "radiance:elev_min_m", "radiance:elev_max_m",
        "detection:coverage_{a}", "detection:coverage_{b}", "detection:coverage_union",
    ),
    4: ("radiance:min", "radiance:max"),
    5: ("sensor:earth_sun_distance",),
    6: ("spatial:bbox_west", "spatial:bbox_south", "spatial:bbox_east", "spatial:bbox_north"),
}


def level0_digits(a: str = "a", b: str = "b") -> dict[str, int]:
    return {c.format(a=a, b=b): n for n, cols in LEVEL0_DIGITS.items() for c in cols}


def level0_schema(a: str = "a", b: str = "b") -> T.StructType:
    """The scene table for two catalogues; texts go into the field metadata."""
    named = [(name.format(a=a, b=b), kind, text.format(a=a, b=b)) for name, kind, text in LEVEL0_COLUMNS]
    return T.StructType([T.StructField(name, kind, True, {"description": text}) for name, kind, text in named])


def canonical(df: DataFrame, schema: T.StructType, extras: bool = True) -> DataFrame:
    """Declared columns in their order and type, absent ones skipped, extras last."""
    known = [f for f in schema.fields if f.name in df.columns]
    out = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata) for f in known]
    if extras:
        out += [F.col(f"`{c}`") for c in df.columns if c not in schema.names]
    return df.select(*out)


def describe(schema: T.StructType) -> list[tuple[str, str, str]]:
    return [(f.name, f.dataType.simpleString(), f.metadata.get("description", "")) for f in schema.fields]
