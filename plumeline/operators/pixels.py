"""Rasters as tables: masks, windows, resampling, painting and band statistics.

A pixel table has scene, row and col (and band, value); a mask is the set of its pixels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumeline.functions.angles import NODATA, circular_diff
from plumeline.functions.draws import draw
from plumeline.operators import spread
from plumeline.operators.aggs import is_fill
from plumeline.operators.ranks import finite
from plumeline.session import settled

# Fixed values.
DILATION = 5
WINDOW_MARGIN = 10
CONTAINED = 0.9
MIN_PLUME_PIXELS = 5
MIN_BACKGROUND_PIXELS = 20
MIN_SD = 1e-9
MIN_LEAF_BYTES = 30_000

#: Side of the tiles in which regions are found, the bits of a long; pixels of the tiles that one step holds.
TILE, TILE_STEP = 64, 1_000_000

#: Codes of a scene's mask fit into a byte.
MAX_CODES = 255


def mask_nodata(value: Column) -> Column:
    """Fill codes and non-finite values become the declared nodata value."""
    return F.when(is_fill(value), F.lit(NODATA)).otherwise(value)


def decode_bit(mask: Column, bit: int) -> Column:
    """Whether a plume's bit (1 to 64) is set in a pixel's mask."""
    if not 1 <= bit <= 64:
        raise ValueError("bit must lie between 1 and 64")
    return F.getbit(mask, F.lit(bit - 1)) == 1


def mask_union_dilate(masks: Sequence[DataFrame], shape: DataFrame, radius: int = DILATION) -> DataFrame:
    """Union of masks grown by a square box, clipped to the scene (scene, height, width).

    The box is separable: along columns first, then along rows. On a line the pixels no further apart
    than two radii become one run, and each pixel of a grown run is made once; no pixel is copied per
    offset. A window holds one line of a scene.
    """
    out = masks[0].select("scene", "row", "col")
    for m in masks[1:]:
        out = out.unionByName(m.select("scene", "row", "col"))
    out = out.distinct()
    for axis, other, limit in (("col", "row", "width"), ("row", "col", "height")):
        line = Window.partitionBy("scene", other).orderBy(axis)
        opens = F.coalesce(F.col(axis) - F.lag(axis).over(line) > 2 * radius + 1, F.lit(True)).cast("int")
        runs = out.withColumn("_new", opens).withColumn("_run", F.sum("_new").over(line)).groupBy("scene", other, "_run")
        runs = runs.agg(F.min(axis).alias("_lo"), F.max(axis).alias("_hi")).join(shape.select("scene", F.col(limit).alias("_n")), "scene")
        low, high = F.greatest(F.col("_lo") - radius, F.lit(0)), F.least(F.col("_hi") + radius, F.col("_n") - 1)
        out = runs.where(low <= high).select("scene", other, F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias(axis))
    return out.select("scene", "row", "col")


def tile_grid(shape: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Non-overlapping square windows that fit each scene."""
    sized = shape.withColumn("size", F.explode(F.array(*[F.lit(s) for s in sizes])))
    sized = sized.where((F.col("height") >= F.col("size")) & (F.col("width") >= F.col("size")))
    steps = lambda n: F.explode(F.expr(f"sequence(0, {n} - size, size)"))
    return sized.select("scene", "size", steps("height").alias("row_off"), "width").select(
        "scene", "size", "row_off", steps("width").alias("col_off")
    )


def tile_fractions(pixels: DataFrame, shape: DataFrame, sizes: Sequence[int], flags: dict[str, Column]) -> DataFrame:
    """Share of flagged pixels per fitting window, found by integer division of the pixel's place."""
    sized = pixels.join(shape, "scene").withColumn("size", F.explode(F.array(*[F.lit(s) for s in sizes])))
    corner = lambda c: (F.floor(F.col(c) / F.col("size")) * F.col("size")).cast("int")
    placed = sized.withColumn("row_off", corner("row")).withColumn("col_off", corner("col"))
    fits = (F.col("row_off") + F.col("size") <= F.col("height")) & (F.col("col_off") + F.col("size") <= F.col("width"))
    return placed.where(fits).groupBy("scene", "size", "row_off", "col_off").agg(
        *[F.bround(F.avg(F.when(c, 1.0).otherwise(0.0)), 4).alias(n) for n, c in flags.items()]
    )


def injectable_tiles(pixels: DataFrame, shape: DataFrame, sizes: Sequence[int], flags: dict[str, Column]) -> DataFrame:
    """Windows with their fractions; valid where every fraction is zero."""
    ok = F.lit(True)
    for n in flags:
        ok = ok & (F.col(n) == 0)
    return tile_fractions(pixels, shape, sizes, flags).withColumn("valid", ok)


def window_struct(size: str = "size") -> Column:
    return F.struct(
        F.col("col_off"), F.col("row_off"), F.col(size).alias("width"), F.col(size).alias("height")
    )


def tile_windows_column(scenes: DataFrame, tiles: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Valid windows per scene and size as a list with its length; empty lists where there are none.

    A scene has as many windows as its height and width divided by the size allow.
    """
    aggs = []
    for s in sizes:
        item = F.when(F.col("valid") & (F.col("size") == s), window_struct())
        listed = F.array_sort(F.collect_list(item))
        aggs += [listed.alias(f"windows_{s}")]
    lists = tiles.groupBy("scene").agg(*aggs)
    out = scenes.select("scene").join(lists, "scene", "left")
    kind = lists.schema[f"windows_{sizes[0]}"].dataType
    empty = F.array().cast(kind)
    for s in sizes:
        out = out.withColumn(f"windows_{s}", F.coalesce(f"windows_{s}", empty))
        out = out.withColumn(f"n_windows_{s}", F.size(f"windows_{s}"))
    return out


def aligned_plume_windows(boxes: DataFrame, shape: DataFrame, size: int, margin: int = WINDOW_MARGIN) -> DataFrame:
    """Grid windows that hold a plume's box with a margin on every side.

    On a grid of step ``size`` at most one window per axis can hold the first row of the box, so
    the window is computed instead of searched.
    """
    b = boxes.join(shape, "scene")
    low = lambda lo: (F.floor((F.col(lo) - margin) / size) * size).cast("int")
    b = b.withColumn("row_off", low("row0")).withColumn("col_off", low("col0")).withColumn("size", F.lit(size))
    holds = (
        (F.col("row0") >= margin)
        & (F.col("col0") >= margin)
        & (F.col("row_off") + size - 1 >= F.col("row1") + margin)
        & (F.col("col_off") + size - 1 >= F.col("col1") + margin)
        & (F.col("row_off") + size <= F.col("height"))
        & (F.col("col_off") + size <= F.col("width"))
    )
    return b.where(holds).select(*boxes.columns, "size", "row_off", "col_off")


def fraction_in_window(pixels: DataFrame, windows: DataFrame, flag: Column, cell: int = 64) -> DataFrame:
    """Mean of a flag over arbitrary windows (scene, window, row_off, col_off, height, width)."""
    span = lambda lo, n: F.explode(F.expr(f"sequence(floor({lo} / {cell}), floor(({lo} + {n} - 1) / {cell}))"))
    w = windows.withColumn("_cr", span("row_off", "height")).withColumn("_cc", span("col_off", "width"))
    p = pixels.withColumn("_flag", F.when(flag, 1.0).otherwise(0.0))
    p = p.select("scene", "row", "col", "_flag", F.floor(F.col("row") / cell).alias("_cr"), F.floor(F.col("col") / cell).alias("_cc"))
    inside = (
        (F.col("row") >= F.col("row_off"))
        & (F.col("row") < F.col("row_off") + F.col("height"))
        & (F.col("col") >= F.col("col_off"))
        & (F.col("col") < F.col("col_off") + F.col("width"))
    )
    return w.join(p, ["scene", "_cr", "_cc"]).where(inside).groupBy("scene", "window").agg(F.avg("_flag").alias("fraction"))


def random_patch_pick(tiles: DataFrame, seed: int, n: int = 1) -> DataFrame:
    """Random valid windows by a seeded digest of their place."""
    d = draw(F.col("scene"), F.col("size"), F.col("row_off"), F.col("col_off"), seed)
    return tiles.where("valid").orderBy(d, "scene", "size", "row_off", "col_off").limit(n)


def chip_crop(mask: DataFrame, shape: DataFrame, pad: int) -> DataFrame:
    """Bounding box of a mask widened by a pad and held inside the scene."""
    box = mask.groupBy("scene").agg(
        F.min("row").alias("_a"), F.max("row").alias("_b"), F.min("col").alias("_c"), F.max("col").alias("_d")
    )
    return box.join(shape, "scene").select(
        "scene",
        F.greatest(F.col("_a") - pad, F.lit(0)).alias("row0"),
        F.least(F.col("_b") + pad + 1, F.col("height")).alias("row1"),
        F.greatest(F.col("_c") - pad, F.lit(0)).alias("col0"),
        F.least(F.col("_d") + pad + 1, F.col("width")).alias("col1"),
    )


def paint_by_area(owned: DataFrame, codes: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """One code per pixel: the smallest plume wins, a declared overlap zone wins over both owners.

    ``owned`` has scene, plume, row, col; ``codes`` scene, plume, code; ``zones`` scene, plume_a,
    plume_b, code for pairs whose shared pixels get a code of their own.
    """
    area = owned.groupBy("scene", "plume").agg(F.count(F.lit(1)).alias("area"))
    sized = owned.join(area, ["scene", "plume"]).join(codes, ["scene", "plume"])
    base = sized.groupBy("scene", "row", "col").agg(F.min_by("code", F.struct("area", -F.col("code"))).alias("code"))
    if zones is None:
        return base
    a = owned.select("scene", "row", "col", F.col("plume").alias("plume_a"))
    b = owned.select("scene", "row", "col", F.col("plume").alias("plume_b"))
    shared = (
        a.join(zones.withColumnRenamed("code", "_zone"), ["scene", "plume_a"])
        .join(b, ["scene", "plume_b", "row", "col"])
        .groupBy("scene", "row", "col")
        .agg(F.max("_zone").alias("_zone"))
    )
    return base.join(shared, ["scene", "row", "col"], "left").select(
        "scene", "row", "col", F.coalesce("_zone", "code").alias("code")
    )


def instance_codes(
    plumes_a: DataFrame, plumes_b: DataFrame, matched: DataFrame, inner_a: DataFrame, inner_b: DataFrame
) -> DataFrame:
    """Codes per scene: clean pairs, other pairs, orphans of each side, then overlap zones.

    ``inner_a`` and ``inner_b`` list overlaps inside one side (scene, plume_a, plume_b, in_a, in_b).
    A plume in one of them is not clean, unless it is the one inside the other. A contained plume
    adds its code to the outer one; other overlaps get a zone code. Codes are bytes: a scene that needs
    more than 255 of them fails the job with its name. Until then it is numbered by a window.
    """

    def unclean(inner):
        both = F.greatest("in_a", "in_b") >= CONTAINED
        outer = F.when(F.col("in_a") >= F.col("in_b"), F.col("plume_b")).otherwise(F.col("plume_a"))
        names = F.when(both, F.array(outer)).otherwise(F.array("plume_a", "plume_b"))
        return inner.select("scene", F.explode(names).alias("plume")).distinct().withColumn("_bad", F.lit(True))

    bad_a = unclean(inner_a).withColumnRenamed("plume", "plume_a").withColumnRenamed("_bad", "_ba")
    bad_b = unclean(inner_b).withColumnRenamed("plume", "plume_b").withColumnRenamed("_bad", "_bb")
    pairs = matched.select("scene", "plume_a", "plume_b").join(bad_a, ["scene", "plume_a"], "left").join(bad_b, ["scene", "plume_b"], "left")
    kind = F.when(F.col("_ba").isNull() & F.col("_bb").isNull(), 0).otherwise(1)
    rows = pairs.select("scene", kind.alias("kind"), "plume_a", "plume_b")
    only_a = plumes_a.select("scene", F.col("plume").alias("plume_a")).join(matched.select("scene", "plume_a"), ["scene", "plume_a"], "left_anti")
    only_b = plumes_b.select("scene", F.col("plume").alias("plume_b")).join(matched.select("scene", "plume_b"), ["scene", "plume_b"], "left_anti")
    none = F.lit(None)
    zone = lambda inner, k: inner.where(F.greatest("in_a", "in_b") < CONTAINED).select("scene", F.lit(k).alias("kind"), "plume_a", "plume_b")
    every = (
        rows.unionByName(only_a.select("scene", F.lit(2).alias("kind"), "plume_a", none.cast(rows.schema["plume_b"].dataType).alias("plume_b")))
        .unionByName(only_b.select("scene", F.lit(3).alias("kind"), none.cast(rows.schema["plume_a"].dataType).alias("plume_a"), "plume_b"))
        .unionByName(zone(inner_a, 4))
        .unionByName(zone(inner_b, 5))
    )
    w = Window.partitionBy("scene").orderBy("kind", "plume_a", "plume_b")
    code = F.row_number().over(w)
    full = F.raise_error(F.concat(F.lit("more than 255 codes in scene "), F.col("scene").cast("string")))
    return every.withColumn("code", F.when(code <= MAX_CODES, code).otherwise(full.cast("int")))


def alpha_to_mask(df: DataFrame, alpha_band: int = 4, opaque: float = 255.0) -> DataFrame:
    """Pixels whose alpha band is opaque; scenes without an alpha band give none."""
    return df.where((F.col("band") == alpha_band) & (F.col("value") == opaque)).select("scene", "row", "col")


def code_iou(a: DataFrame, b: DataFrame, wanted: DataFrame, parts: int | None = None) -> DataFrame:
    """Intersection, union and IoU of two code lists per pair.

    ``a`` and ``b`` are masks (scene, row, col, code); ``wanted`` has scene, pair, side, code. A pixel's
    sides are gathered once, in so many ``parts`` by pair (without them, as the session has it).
    """
    pick = lambda m, s: m.join(wanted.where(F.col("side") == s).drop("side"), ["scene", "code"]).select("scene", "pair", "row", "col")
    sides = pick(a, "a").withColumn("_s", F.lit(1)).unionByName(pick(b, "b").withColumn("_s", F.lit(2)))
    if parts is not None:
        sides = sides.repartition(parts, "scene", "pair")
    cells = sides.groupBy("scene", "pair", "row", "col").agg(F.bit_or("_s").alias("_s"))
    g = cells.groupBy("scene", "pair").agg(
        F.count_if(F.col("_s") == 3).alias("inter"),
        F.count(F.lit(1)).alias("union"),
        F.count_if(F.col("_s").isin(1, 3)).alias("area_a"),
        F.count_if(F.col("_s").isin(2, 3)).alias("area_b"),
    )
    return g.withColumn("iou", F.col("inter") / F.col("union"))


def ghost_sources(sources: DataFrame, mask: DataFrame) -> DataFrame:
    """Codes stamped in the source band that the mask band does not have."""
    return sources.select("scene", "code").distinct().join(mask.select("scene", "code").distinct(), ["scene", "code"], "left_anti")


def plume_bearing(plume: DataFrame, source: DataFrame, min_pixels: int = 30) -> DataFrame:
    """Bearing from the source to the plume's centre against the wind heading at the source.

    ``plume`` has scene, lon, lat per pixel; ``source`` has scene, lon, lat, u, v.
    """
    centre = plume.groupBy("scene").agg(F.avg("lon").alias("_x"), F.avg("lat").alias("_y"), F.count(F.lit(1)).alias("_n"))
    j = source.join(centre.where(F.col("_n") >= min_pixels), "scene")
    east = (F.col("_x") - F.col("lon")) * F.cos(F.radians("lat"))
    north = F.col("_y") - F.col("lat")
    j = j.where(F.hypot(east, north) >= 1e-4)
    bearing = F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))
    heading = F.pmod(F.degrees(F.atan2("u", "v")), F.lit(360.0))
    return j.select("scene", bearing.alias("plume_bearing"), heading.alias("wind_bearing"), circular_diff(bearing, heading).alias("difference"))


def rotate_wind_to_sensor(grid: DataFrame) -> DataFrame:
    """Wind of each scene along its column and row axes from the mean position gradients.

    Gradients come from neighbours found by an equi-join one row or one column further.
    """
    nxt = lambda axis, x, y: grid.select(
        "scene",
        "row" if axis == "col" else (F.col("row") - 1).alias("row"),
        "col" if axis == "row" else (F.col("col") - 1).alias("col"),
        F.col("lon").alias(x),
        F.col("lat").alias(y),
    )
    step = grid.join(nxt("col", "_xc", "_yc"), ["scene", "row", "col"], "left").join(
        nxt("row", "_xr", "_yr"), ["scene", "row", "col"], "left"
    )
    g = step.groupBy("scene").agg(
        F.avg("lat").alias("_lat"),
        F.avg(F.col("_xc") - F.col("lon")).alias("_cx"),
        F.avg(F.col("_yc") - F.col("lat")).alias("_cn"),
        F.avg(F.col("_xr") - F.col("lon")).alias("_rx"),
        F.avg(F.col("_yr") - F.col("lat")).alias("_rn"),
        F.avg("u").alias("_u"),
        F.avg("v").alias("_v"),
    )
    squeeze = F.cos(F.radians("_lat"))
    ce, re = F.col("_cx") * squeeze, F.col("_rx") * squeeze
    cl, rl = F.hypot(ce, F.col("_cn")), F.hypot(re, F.col("_rn"))
    return g.select(
        "scene",
        ((F.col("_u") * ce + F.col("_v") * F.col("_cn")) / cl).alias("along_col"),
        ((F.col("_u") * re + F.col("_v") * F.col("_rn")) / rl).alias("along_row"),
        F.pmod(F.degrees(F.atan2(ce, F.col("_cn"))), F.lit(360.0)).alias("col_bearing"),
    )


def resample_mean(df: DataFrame, k: int, keys: Sequence[str] = ("scene", "band")) -> DataFrame:
    """Mean over k by k blocks."""
    return df.groupBy(
        *keys, F.floor(F.col("row") / k).cast("int").alias("row"), F.floor(F.col("col") / k).cast("int").alias("col")
    ).agg(F.avg("value").alias("value"))


def percentile_stretch(df: DataFrame, keys: Sequence[str], value: str, lo: float = 0.02, hi: float = 0.98) -> DataFrame:
    """Values clipped to two percentiles and scaled to 0..1; constant bands give 0."""
    marks = spread.percentiles(df, keys, value, {"_lo": lo, "_hi": hi})
    span = F.col("_hi") - F.col("_lo")
    unit = F.least(F.greatest((F.col(value) - F.col("_lo")) / span, F.lit(0.0)), F.lit(1.0))
    return df.join(marks, list(keys)).withColumn("stretched", F.when(span > 0, unit).otherwise(0.0)).drop("_lo", "_hi")


def gather_bilinear(points: DataFrame, grid: DataFrame, keys: Sequence[str], ident: Sequence[str], x: Column, y: Column, n_x: int, n_y: int) -> DataFrame:
    """Bilinear sample of a regular grid (keys, gx, gy, value) at fractional places, edges held.

    Every point asks for its four neighbours by key, so the grid is never broadcast or gathered.
    """
    cx = F.least(F.greatest(x, F.lit(0.0)), F.lit(float(n_x - 1)))
    cy = F.least(F.greatest(y, F.lit(0.0)), F.lit(float(n_y - 1)))
    base = points.select(*keys, *ident, cx.alias("_x"), cy.alias("_y"))
    corner = lambda dx, dy: F.struct(
        F.least(F.floor("_x") + dx, F.lit(n_x - 1)).cast("int").alias("gx"),
        F.least(F.floor("_y") + dy, F.lit(n_y - 1)).cast("int").alias("gy"),
        (
            (F.col("_x") - F.floor("_x") if dx else 1 - F.col("_x") + F.floor("_x"))
            * (F.col("_y") - F.floor("_y") if dy else 1 - F.col("_y") + F.floor("_y"))
        ).alias("w"),
    )
    asks = base.select(*keys, *ident, F.explode(F.array(*[corner(a, b) for a in (0, 1) for b in (0, 1)])).alias("c"))
    asks = asks.select(*keys, *ident, "c.gx", "c.gy", "c.w").where("w > 0")
    hit = asks.join(grid, [*keys, "gx", "gy"], "left")
    return hit.groupBy(*keys, *ident).agg(
        F.sum(F.col("w") * F.col("value")).alias("value"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("w")).otherwise(0.0)).alias("weight"),
        F.max_by("value", F.when(F.col("value").isNotNull(), F.col("w"))).alias("nearest"),
    )


def interp_nodes_to_pixels(points: DataFrame, grid: DataFrame, keys: Sequence[str], ident: Sequence[str], x: Column, y: Column, n_x: int, n_y: int) -> DataFrame:
    """Linear interpolation of regular nodes, the nearest known node where one is missing."""
    g = gather_bilinear(points, grid, keys, ident, x, y, n_x, n_y)
    whole = F.col("weight") > 1 - 1e-9
    return g.select(*keys, *ident, F.when(whole, F.col("value")).otherwise(F.col("nearest")).alias("value"))


def contrast(n_p: Column, mean_p: Column, n_b: Column, mean_b: Column, sd_b: Column) -> Column:
    """Absolute mean difference over the background's sd, null when either side is too small."""
    ok = (n_p >= MIN_PLUME_PIXELS) & (n_b >= MIN_BACKGROUND_PIXELS) & (sd_b >= MIN_SD)
    return F.when(ok, F.abs(mean_p - mean_b) / sd_b)


def _masked(value: Column, mask: Column, tag: str) -> list[Column]:
    p, b = F.when(mask, value), F.when(~mask, value)
    return [
        F.count(p).alias(f"np{tag}"),
        F.avg(p).alias(f"mp{tag}"),
        F.count(b).alias(f"nb{tag}"),
        F.avg(b).alias(f"mb{tag}"),
        F.stddev_pop(b).alias(f"sb{tag}"),
    ]


#: Numbers of pair matrices that a task holds at a time, for its samples and for one step of pixels.
PAIR_CELLS, STEP_CELLS = 8_000_000, 1_000_000


class _Moments:
    """Count, mean and squared deviations of each cell of a matrix, fed with stacks of matrices."""

    def __init__(self, n: int):
        self.n, self.mean, self.dev = np.zeros((n, n)), np.zeros((n, n)), np.zeros((n, n))

    def add(self, values: np.ndarray) -> None:
        ok = np.isfinite(values)
        n = ok.sum(axis=0)
        mean = np.where(ok, values, 0.0).sum(axis=0) / np.maximum(n, 1)
        dev = (np.where(ok, values - mean, 0.0) ** 2).sum(axis=0)
        both = np.maximum(self.n + n, 1)
        gap = mean - self.mean
        self.dev += dev + gap * gap * self.n * n / both
        self.mean += gap * n / both
        self.n += n


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    """Lists as rows of n numbers; what is missing is NaN."""
    out = np.full((len(column), n), np.nan)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.cast(column.drop_null().flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = at < n
    out[np.repeat(np.arange(len(column)), lengths)[inside], at[inside]] = flat[inside]
    return out


def band_ratio_pairs(df: DataFrame, sample: str, target: str, reference: str, mask: Column, n: int, min_mask: int = 10) -> DataFrame:
    """Plume contrast of every ordered band pair, raw difference and normalised quotient.

    The scene means that normalise the quotient are constant factors, which the contrast does not
    see, so one pass over the pixels gives both. A task keeps count, mean and deviations of all pairs of
    a sample as matrices, fed with blocks of pixels, and gives each pair once per sample; those parts
    are put together afterwards. Missing and non-finite ratios are left out.
    """
    rows = df.select(F.col(sample).alias("_s"), mask.alias("_m"), F.col(target).cast("array<double>").alias("_t"), F.col(reference).cast("array<double>").alias("_r")).where("_m is not null")
    kinds = {"d": ("p", "b"), "q": ("p", "b")}
    sides = [(k, s) for k in kinds for s in kinds[k]]
    numbers = [f"{c}{k}{s}" for k, s in sides for c in ("n", "t", "v", "w")]
    out = T.StructType([rows.schema["_s"], T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in ("_area", *numbers)]])
    schema = to_arrow_schema(out)
    i, j = (x.ravel() for x in np.nonzero(~np.eye(n, dtype=bool)))

    def part(name: pa.Scalar, area: int, held: dict) -> pa.RecordBatch:
        columns = [pa.array([name.as_py()], schema.types[0]).take(pa.array(np.zeros(len(i), np.int64))), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), float(area)))]
        for key in sides:
            m = held[key]
            columns += [pa.array(x[i, j]) for x in (m.n, m.n * m.mean, m.dev, m.n * m.mean * m.mean)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    room = max(1, PAIR_CELLS // (12 * n * n))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            code, flag = coded.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            t, r = _matrix(batch.column(2), n), _matrix(batch.column(3), n)
            for c in np.unique(code):
                name = coded.dictionary[int(c)]
                if name not in known:
                    if len(known) >= room:
                        yield from (part(k, *v) for k, v in known.items())
                        known = {}
                    known[name] = [0, {key: _Moments(n) for key in sides}]
                own = code == c
                known[name][0] += int(flag[own].sum())
                for side, which in (("p", own & flag), ("b", own & ~flag)):
                    at = np.flatnonzero(which)
                    for a in range(0, len(at), max(1, STEP_CELLS // (n * n))):
                        step = at[a : a + max(1, STEP_CELLS // (n * n))]
                        with np.errstate(all="ignore"):
                            low_t, low_r = (np.where(np.abs(x[step]) > 1e-9, x[step], np.nan)[:, None, :] for x in (t, r))
                            safe = np.isfinite(low_t) & np.isfinite(low_r)
                            q_t, q_r = (np.where(safe, x[step][:, :, None] / low, np.nan) for x, low in ((t, low_t), (r, low_r)))
                            known[name][1]["d", side].add(q_t - q_r)
                            known[name][1]["q", side].add(q_t / q_r)
        yield from (part(k, *v) for k, v in known.items())

    total = rows.mapInArrow(fold, out).groupBy("_s", "i", "j").agg(*[F.expr(f"sum({c}) as {c}") for c in ("_area", *numbers)])
    marks = []
    for k in kinds:
        mean = {s: f"try_divide(t{k}{s}, n{k}{s})" for s in kinds[k]}
        sd = f"sqrt(greatest(v{k}b + w{k}b - t{k}b * {mean['b']}, 0D) / n{k}b)"
        enough = f"n{k}p >= {MIN_PLUME_PIXELS} and n{k}b >= {MIN_BACKGROUND_PIXELS}"
        marks.append(f"case when {enough} then case when {sd} >= {MIN_SD} then abs({mean['p']} - {mean['b']}) / {sd} end end as {'raw' if k == 'd' else 'normalised'}")
    return total.where(f"_area >= {min_mask}").selectExpr("_s", "i", "j", *marks).withColumnRenamed("_s", sample)


def band_stat_contrast(df: DataFrame, keys: Sequence[str], value: Column, mask: Column) -> DataFrame:
    """Contrast, signed difference and means of plume and background per sample and band."""
    good = F.when(finite(value), value)
    stats = df.select(*keys, good.alias("_v"), mask.alias("_m")).groupBy(*keys).agg(*_masked(F.col("_v"), F.col("_m"), ""))
    snr = contrast(F.col("np"), F.col("mp"), F.col("nb"), F.col("mb"), F.col("sb"))
    return stats.select(
        *keys,
        snr.alias("snr"),
        (F.col("mp") - F.col("mb")).alias("difference"),
        F.col("np").alias("n_plume"),
        F.col("nb").alias("n_background"),
    ).where("snr is not null")


def random_placements(boxes: DataFrame, height: str, width: str, n: int, seed: int, central: float | None = None) -> DataFrame:
    """n seeded shifts per scene that keep the mask's box inside the patch.

    With ``central`` the centre of the shifted box also stays in a central box of that share.
    """

    def span(lo, hi, size):
        low, high = -F.col(lo), F.col(size) - 1 - F.col(hi)
        if central is not None:
            mid = (F.col(size) - 1) / F.lit(2.0) - (F.col(lo) + F.col(hi)) / F.lit(2.0)
            room = central * (F.col(size) - 1) / 2.0
            low = F.greatest(low, F.ceil(mid - room).cast("int"))
            high = F.least(high, F.floor(mid + room).cast("int"))
        return low, high

    r_lo, r_hi = span("row0", "row1", height)
    c_lo, c_hi = span("col0", "col1", width)
    k = boxes.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    pick = lambda lo, hi, tag: (lo + F.pmod(draw(F.col("scene"), F.col("k"), tag, seed), (hi - lo + 1).cast("bigint"))).cast("int")
    return k.where((r_hi >= r_lo) & (c_hi >= c_lo)).select(
        "scene", "k", pick(r_lo, r_hi, "r").alias("dy"), pick(c_lo, c_hi, "c").alias("dx")
    )


def random_mask_control(pixels: DataFrame, mask: DataFrame, shifts: DataFrame) -> DataFrame:
    """Contrast of shifted copies of the mask per band: median, smallest, largest.

    Only mask pixels meet the shifts; the background is what is left of the band's totals.
    """
    centre = pixels.groupBy("scene", "band").agg(F.avg("value").alias("_c"))
    x = pixels.join(centre, ["scene", "band"]).select("scene", "band", "row", "col", (F.col("value") - F.col("_c")).alias("_x"))
    totals = x.groupBy("scene", "band").agg(
        F.count("_x").alias("_n"), F.sum("_x").alias("_s"), F.sum(F.col("_x") * F.col("_x")).alias("_q")
    )
    moved = mask.join(shifts, "scene").select(
        "scene", "k", (F.col("row") + F.col("dy")).alias("row"), (F.col("col") + F.col("dx")).alias("col")
    )
    inside = x.join(moved, ["scene", "row", "col"]).groupBy("scene", "band", "k").agg(
        F.count("_x").alias("_np"), F.sum("_x").alias("_sp"), F.sum(F.col("_x") * F.col("_x")).alias("_qp")
    )
    c = F.col
    j = inside.join(totals, ["scene", "band"]).withColumn("_nb", c("_n") - c("_np"))
    mean_b = F.try_divide(c("_s") - c("_sp"), c("_nb"))
    var_b = F.try_divide(c("_q") - c("_qp"), c("_nb")) - mean_b * mean_b
    snr = contrast(c("_np"), c("_sp") / c("_np"), c("_nb"), mean_b, F.sqrt(F.greatest(var_b, F.lit(0.0))))
    done = j.select("scene", "band", snr.alias("_snr")).where("_snr is not null")
    return spread.summary(
        done,
        ["scene", "band"],
        [F.count("_snr").alias("n"), F.min("_snr").alias("lowest"), F.max("_snr").alias("highest")],
        "_snr",
        {"median": 0.5},
    )


def background_parts(rows: np.ndarray, height: np.ndarray, width: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, ...]:
    """Connected background regions of many tiles at once; pixels are neighbours along rows and columns.

    ``rows`` has a tile's rows as bits of the mask; ``outer`` tells of its top, bottom, left and right
    side whether the box ends there. Returns of each region its tile, pixels, whether it reaches the rim
    of the box, and whether it reaches another tile; and of each pixel beside another tile its tile, row,
    column and region.
    """
    area = height * width
    tile = np.repeat(np.arange(len(area)), area)
    at = np.arange(len(tile)) - np.repeat(np.cumsum(area) - area, area)
    wide = width[tile]
    row, col = at // wide, at % wide
    free = (rows[tile, row] >> col.astype(np.uint64)) & np.uint64(1) == 0
    # Runs along rows first, then the runs that meet along columns: each run goes to the lowest it meets.
    begins = free.copy()
    begins[1:] &= (col[1:] == 0) | ~free[:-1]
    run = np.cumsum(begins) - 1
    upper = np.flatnonzero(free & (row + 1 < height[tile]))
    upper = upper[free[upper + wide[upper]]]
    one, two = run[upper], run[upper + wide[upper]]
    low = np.arange(int(begins.sum()))
    while len(one):
        x, y = low[one], low[two]
        apart = x != y
        one, two, x, y = one[apart], two[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]
    lowest, region = np.unique(low, return_inverse=True)
    free = np.flatnonzero(free)
    tile, row, col, region = tile[free], row[free], col[free], region[run[free]]
    sides = np.stack([row == 0, row == height[tile] - 1, col == 0, col == width[tile] - 1], axis=1)
    rim, inner = (sides & outer[tile]).any(axis=1), (sides & ~outer[tile]).any(axis=1)
    n = len(lowest)
    has = lambda mark: np.bincount(region[mark], minlength=n) > 0
    owner = np.zeros(n, np.int64)
    owner[region] = tile
    return owner, np.bincount(region, minlength=n), has(rim), has(inner), tile[inner], row[inner], col[inner], region[inner]


def _tile_parts(height: pa.Array, width: pa.Array, outer: pa.Array, lines: pa.Array) -> pa.Array:
    """Per tile its closed regions, their pixels, its regions that reach another tile, and their pixels there."""
    high, wide = (pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (height, width))
    sides = (pc.fill_null(outer, 0).to_numpy(zero_copy_only=False)[:, None] >> np.arange(4)) & 1 == 1
    held = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False)
    rows = np.zeros((len(high), TILE), np.uint64)
    flat = lines.flatten()
    bits = flat.field("bits").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    rows[np.repeat(np.arange(len(high)), held), flat.field("row").to_numpy(zero_copy_only=False)] = bits
    found, first = [], 0
    ends = np.cumsum(high * wide) // TILE_STEP
    for a, b in ((x[0], x[-1] + 1) for x in np.split(np.arange(len(high)), np.flatnonzero(np.diff(ends)) + 1) if len(x)):
        tile, pixels, rim, inner, at, row, col, region = background_parts(rows[a:b], high[a:b], wide[a:b], sides[a:b])
        found.append((tile + a, pixels, rim, inner, np.arange(len(tile)) + first, at + a, row, col, region + first))
        first += len(tile)
    none = np.zeros(0, np.int64)
    tile, pixels, rim, inner, part, at, row, col, region = (np.concatenate(x) for x in zip((none, none, none > 0, none > 0, none, none, none, none, none), *found))
    closed = ~rim & ~inner
    holes = np.bincount(tile[closed], minlength=len(high))
    hole_pixels = np.bincount(tile[closed], pixels[closed], minlength=len(high)).astype(np.int64)

    def lists(owner: np.ndarray, **columns: np.ndarray) -> pa.Array:
        order = np.argsort(owner, kind="stable")
        offsets = np.searchsorted(owner[order], np.arange(len(high) + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(c[order]) for c in columns.values()], list(columns))
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    parts = lists(tile[inner], part=part[inner], pixels=pixels[inner], rim=rim[inner])
    edge = lists(at, row=row, col=col, part=region)
    return pa.StructArray.from_arrays([pa.array(holes), pa.array(hole_pixels), parts, edge], ["holes", "hole_pixels", "parts", "edge"])


def mask_holes(mask: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of enclosed background regions and their pixels inside each mask's box.

    Background pixels of the box, grown by one, are linked to their neighbours; regions that do not
    reach the rim are holes. A box is cut into tiles of fixed size, whose regions are found in one task
    each; only the regions that reach another tile are linked across the tiles, round by round.
    """
    from plumeline.operators.select import connected_components

    keys = list(keys)
    box = mask.groupBy(*keys).agg(*[(f(F.col(c).cast("long")) + d).alias(x) for x, f, c, d in (
        ("_r0", F.min, "row", -1), ("_r1", F.max, "row", 1), ("_c0", F.min, "col", -1), ("_c1", F.max, "col", 1)
    )])
    # A tile's row is one long; equal pixels count once.
    row, col = F.col("row") - F.col("_r0"), F.col("col") - F.col("_c0")
    tiled = mask.where("row is not null and col is not null").join(box, keys).select(
        *keys, F.expr(f"(row - _r0) div {TILE}").alias("_tr"), F.expr(f"(col - _c0) div {TILE}").alias("_tc"),
        (row % TILE).cast("int").alias("_row"), F.expr(f"shiftleft(1L, cast((col - _c0) % {TILE} as int))").alias("_bit"),
    )
    lines = tiled.groupBy(*keys, "_tr", "_tc", "_row").agg(F.bit_or("_bit").alias("_bits"))
    lines = lines.groupBy(*keys, "_tr", "_tc").agg(F.collect_list(F.struct(F.col("_row").alias("row"), F.col("_bits").alias("bits"))).alias("_lines"))
    # Tiles without a pixel of the mask are all background; a box without pixels has none.
    tiles = box.select("*", F.explode_outer(F.expr(f"sequence(0L, (_r1 - _r0) div {TILE})")).alias("_tr"))
    tiles = tiles.select("*", F.explode_outer(F.expr(f"sequence(0L, (_c1 - _c0) div {TILE})")).alias("_tc"))
    size = lambda lo, hi, t: F.when(F.col(t).isNotNull(), F.least(F.lit(TILE), F.col(hi) - F.col(lo) + 1 - F.col(t) * TILE)).cast("int")
    outer = F.expr(f"int(_tr = 0) + 2 * int(_tr = (_r1 - _r0) div {TILE}) + 4 * int(_tc = 0) + 8 * int(_tc = (_c1 - _c0) div {TILE})")
    kind = "struct<holes: bigint, hole_pixels: bigint, parts: array<struct<part: bigint, pixels: bigint, rim: boolean>>, edge: array<struct<row: bigint, col: bigint, part: bigint>>>"
    regions = F.arrow_udf(_tile_parts, kind)(size("_r0", "_r1", "_tr"), size("_c0", "_c1", "_tc"), outer, F.col("_lines"))
    found = settled(tiles.join(lines, [*keys, "_tr", "_tc"], "left").select(*keys, "_tr", "_tc", regions.alias("_found")).select(*keys, "_tr", "_tc", "_found.*"))

    # Masks without a key have no holes: their pixels meet none.
    whole = found.where(F.size("edge") > 0).where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    name = lambda part: F.to_json(F.struct(*keys, "_tr", "_tc", part.alias("_part"))).alias("_node")
    edge = whole.select(*keys, "_tr", "_tc", F.explode("edge").alias("_e"))
    edge = edge.select(*keys, (F.col("_tr") * TILE + F.col("_e.row")).alias("row"), (F.col("_tc") * TILE + F.col("_e.col")).alias("col"), name(F.col("_e.part")))
    near = lambda dr, dc: edge.select(*keys, (F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col"), F.col("_node").alias("dst"))
    links = edge.join(near(1, 0).unionByName(near(0, 1)), [*keys, "row", "col"]).select(F.col("_node").alias("src"), "dst").where("src <> dst")
    comp = connected_components(links).withColumnsRenamed({"node": "_node", "component": "_component"})
    parts = whole.select(*keys, "_tr", "_tc", F.explode("parts").alias("_p"))
    parts = parts.select(*keys, name(F.col("_p.part")), "_p.pixels", "_p.rim").join(comp, "_node", "left")
    crossing = parts.groupBy(*keys, F.coalesce("_component", "_node").alias("_component")).agg(F.bool_or("rim").alias("rim"), F.sum("pixels").alias("hole_pixels"))
    crossing = crossing.where("not rim").select(*keys, F.lit(1).cast("bigint").alias("holes"), "hole_pixels")
    every = found.select(*keys, "holes", "hole_pixels").unionByName(crossing)
    return every.groupBy(*keys).agg(F.sum("holes").alias("holes"), F.sum("hole_pixels").alias("hole_pixels"))


def all_null_ids(df: DataFrame, ident: Sequence[str], value: str) -> DataFrame:
    """Ids whose whole layer is nodata."""
    return df.groupBy(*ident).agg(F.bool_and(is_fill(F.col(value))).alias("_all")).where("_all").select(*ident)


def empty_leaf(low: Column, high: Column, valid: Column, size: Column) -> Column:
    """A leaf that is all zero over its whole area, or too small a file to hold data."""
    return ((low == 0) & (high == 0) & (valid >= 99)) | (size < MIN_LEAF_BYTES)


def coverage_fraction(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.when(finite(F.col(value)), 1.0).otherwise(0.0)).alias("coverage"))
