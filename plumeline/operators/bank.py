"""Simulated plume volumes as voxel tables: nodes, projection, thresholds and measures.

A voxel table has volume, level, row, col and ppb, zeros left out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.operators.ranks import MASS_BUDGET, ZERO_THRESHOLD, choose_spaced_trio, mass_budget_threshold

# Fixed values of the simulation grid and of the bank's geometry.
LEVEL_M = 20.0
REFERENCE_HEIGHT_M = 330.0
NODE_SHIFT_M = 60.0
MAX_ZENITH = 70.5
NOISE_PPB = 50.0
UPWIND_PIXELS = 5
SNAPSHOT_TARGETS = (75, 90, 105)
SNAPSHOT_GAP = 16
TRACER_AIR_MOL = 3.6055e5
EDGE_TOUCH = 0.02


@dataclass(frozen=True)
class Domain:
    """Horizontal grid of a volume and the columns its criteria look at."""

    ny: int = 90
    nx: int = 120
    nz: int = 49
    relax: int = 5
    window: int = 30
    interior_from: int = 40
    pixel_m: float = 20.0

    @property
    def entry(self) -> int:
        return self.relax

    @property
    def exit(self) -> int:
        return self.nx - 1 - self.relax

    @property
    def interior_to(self) -> int:
        return self.exit + 1 - self.window


def node_list(shift_m: float, height_m: float, max_zenith: float) -> list[dict]:
    """All (ring, sza, raa) nodes: neighbours move a plume by the same distance on the ground."""
    step = shift_m / height_m
    rings = math.ceil((math.tan(math.radians(max_zenith)) + step) / step)
    out = []
    for ring in range(rings):
        count = 1
        if ring:
            turn = math.degrees(2 * math.asin(min(1.0, 1 / (2 * ring))))
            count = max(1, round(360 / turn))
        zenith = math.degrees(math.atan(ring * step))
        out += [{"ring": ring, "sza": zenith, "raa": i * 360.0 / count} for i in range(count)]
    return out


def _node_array(shift_m: float, height_m: float, max_zenith: float) -> Column:
    """The nodes as one constant; the geometry fixes how many there are."""
    text = json.dumps(node_list(shift_m, height_m, max_zenith))
    return F.from_json(F.lit(text), "array<struct<ring:int,sza:double,raa:double>>")


def with_sun_nodes(
    df: DataFrame, shift_m: float = NODE_SHIFT_M, height_m: float = REFERENCE_HEIGHT_M, max_zenith: float = MAX_ZENITH
) -> DataFrame:
    """Every row once per sun position (855 with the defaults), generated in place."""
    nodes = _node_array(shift_m, height_m, max_zenith)
    return df.select("*", F.posexplode(nodes).alias("node", "_n")).select(*df.columns, "node", "_n.ring", "_n.sza", "_n.raa")


def sun_nodes(spark, **settings) -> DataFrame:
    """The node table itself."""
    return with_sun_nodes(spark.range(1).select(F.lit(0).alias("_0")), **settings).drop("_0")


def source_box_center(df: DataFrame, r0: str, r1: str, c0: str, c1: str) -> DataFrame:
    """Centre and size in pixels of a source rectangle."""
    a, b, c, d = (F.col(x) for x in (r0, r1, c0, c1))
    return df.select(
        "*",
        ((a + b) * 0.5).alias("center_row"),
        ((c + d) * 0.5).alias("center_col"),
        (b - a + 1).alias("height_px"),
        (d - c + 1).alias("width_px"),
    )


def volume_to_column(df: DataFrame, scale: Column | None = None) -> DataFrame:
    """Vertical sum of a volume, optionally scaled from tracer units."""
    v = F.col("ppb") if scale is None else F.col("ppb") * scale
    return df.groupBy("volume", "row", "col").agg(F.sum(v).alias("ppb"))


def _split(shift_x: Column, shift_y: Column, weight: Column) -> Column:
    """Four target offsets with bilinear weights for one shifted voxel."""
    ix, iy = F.floor(shift_x), F.floor(shift_y)
    fx, fy = shift_x - ix, shift_y - iy
    part = lambda dx, dy: F.struct(
        (ix + dx).cast("int").alias("dx"),
        (iy + dy).cast("int").alias("dy"),
        (weight * (fx if dx else 1 - fx) * (fy if dy else 1 - fy)).alias("w"),
    )
    return F.array(part(0, 0), part(1, 0), part(0, 1), part(1, 1))


def path_offsets(
    nodes: DataFrame, nz: int, vza: float = 0.0, vaa: float = 0.0, pixel_m: float = 20.0, level_m: float = LEVEL_M
) -> DataFrame:
    """Where a voxel of each level lands for each sun node, with its weight.

    One row per (node, level, dx, dy): nodes times levels times a handful of targets, whatever the
    number of volumes. Each level moves against the azimuth by its height times the tangent of the
    angle and is split over four pixels; sun and view paths are weighted by their air mass.
    """
    a_view = 1.0 / math.cos(math.radians(vza))
    base = nodes.select("node", "sza", "raa", F.explode(F.sequence(F.lit(0), F.lit(nz))).alias("level")).select(
        "node",
        "level",
        (F.col("level") * level_m / pixel_m * F.tan(F.radians("sza"))).alias("reach"),
        F.radians(F.col("raa") + 180.0).alias("turn"),
        (1 / F.cos(F.radians("sza"))).alias("a_sun"),
    )
    total = F.col("a_sun") + a_view
    sun = _split(F.col("reach") * F.cos("turn"), F.col("reach") * F.sin("turn"), F.col("a_sun") / total)
    if vza == 0.0:
        view = F.array(F.struct(F.lit(0).alias("dx"), F.lit(0).alias("dy"), (a_view / total).alias("w")))
    else:
        back = math.radians(vaa + 180.0)
        slant = F.col("level") * (level_m / pixel_m * math.tan(math.radians(vza)))
        view = _split(slant * math.cos(back), slant * math.sin(back), a_view / total)
    return (
        base.select("node", "level", F.explode(F.concat(sun, view)).alias("o"))
        .groupBy("node", "level", F.col("o.dx").alias("dx"), F.col("o.dy").alias("dy"))
        .agg(F.sum("o.w").alias("w"))
        .where("w <> 0")
    )


def project_volume(
    voxels: DataFrame, nodes: DataFrame, nz: int, vza: float = 0.0, vaa: float = 0.0, pixel_m: float = 20.0
) -> DataFrame:
    """Column maps of every volume at every sun node: mass-conserving slant sums.

    The offset table is bounded by the geometry and is broadcast; voxels never move until their
    shares have been added up per target pixel.
    """
    offsets = F.broadcast(path_offsets(nodes, nz, vza, vaa, pixel_m))
    return (
        voxels.where("ppb <> 0")
        .select("volume", F.col("level").cast("int").alias("level"), "row", "col", "ppb")
        .join(offsets, "level")
        .groupBy("volume", "node", (F.col("row") + F.col("dy")).alias("row"), (F.col("col") + F.col("dx")).alias("col"))
        .agg(F.sum(F.col("ppb") * F.col("w")).alias("ppb"))
    )


def threshold_and_crop(
    df: DataFrame, keys: Sequence[str], budget: float = MASS_BUDGET, cap: float = ZERO_THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """Maps with small values dropped, and per map the box, mass before and after, peak."""
    limit = mass_budget_threshold(df, keys, "ppb", budget, cap)
    joined = df.join(limit, list(keys))
    kept = F.col("ppb") >= F.col("threshold")
    stats = joined.groupBy(*keys, "threshold").agg(
        F.max("ppb").alias("peak"),
        F.sum(F.when(F.col("ppb") > 0, F.col("ppb"))).alias("mass_before"),
        F.sum(F.when(kept, F.col("ppb"))).alias("mass_after"),
        *[f(F.when(kept, F.col(c))).alias(n) for n, f, c in (("row0", F.min, "row"), ("row1", F.max, "row"), ("col0", F.min, "col"), ("col1", F.max, "col"))],
    )
    return joined.where(kept).drop("threshold"), stats


def snapshot_measures(voxels: DataFrame, sources: DataFrame, domain: Domain, noise: float = NOISE_PPB) -> DataFrame:
    """Peak, edges, fade-out slope, widths, mean height and foreign mass of a snapshot.

    ``sources`` has volume, center_col, width_px. Pixels missing from the voxel table count as zero.
    """
    d = domain
    column = volume_to_column(voxels)
    inner_row = F.col("row").between(d.relax, d.ny - 1 - d.relax)
    inner_col = F.col("col").between(d.relax, d.exit)
    low = lambda c: F.max(F.when(c, F.col("ppb")))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    strip_end = F.floor(F.col("center_col") - F.col("width_px") / 2 - UPWIND_PIXELS)
    per_col = column.groupBy("volume", "col").agg(
        F.max("ppb").alias("top"), F.count_if(inner_row & inner_col & (F.col("ppb") > noise)).alias("wide"),
        zero(F.sum(F.when(inner_row & inner_col, F.col("ppb")))).alias("mass"),
        zero(low(F.col("row") == d.relax)).alias("bottom"), zero(low(F.col("row") == d.ny - 1 - d.relax)).alias("upper"),
    )
    # One row per volume and column of the grid, so that empty columns take part.
    frame = sources.select("volume", "center_col", "width_px", F.explode(F.sequence(F.lit(0), F.lit(d.nx - 1))).alias("col"))
    p = frame.join(per_col, ["volume", "col"], "left").na.fill(0)
    at = lambda c, name: F.max(F.when(c, F.col(name)))
    log_top = F.ln(F.greatest(F.col("top"), F.lit(1e-3)))
    tail = F.col("col").between(d.interior_to, d.exit)
    stats = p.groupBy("volume", "center_col", "width_px").agg(
        F.max("top").alias("peak"),
        at(F.col("col") == d.entry, "top").alias("edge_upwind"),
        at(F.col("col") == d.exit, "top").alias("edge_downwind"),
        at(inner_col, "bottom").alias("edge_bottom"),
        at(inner_col, "upper").alias("edge_top"),
        F.min(F.when((F.col("col") >= d.interior_from) & (F.col("col") < d.interior_to), F.col("top"))).alias("interior_min"),
        F.regr_slope(F.when(tail, log_top), F.when(tail, F.col("col"))).alias("slope"),
        (F.max("wide") * d.pixel_m).alias("width_max_m"),
        (at(F.col("col") == d.exit, "wide") * d.pixel_m).alias("width_edge_m"),
        F.sum(F.when(inner_col & (F.col("col") <= strip_end), F.col("mass"))).alias("_u"),
        F.count_if(inner_col & (F.col("col") <= strip_end)).alias("_nu"),
        F.sum("mass").alias("_d"),
        F.count_if(inner_col).alias("_nd"),
    )
    per_level = voxels.where(inner_row & inner_col).groupBy("volume", "level").agg(F.greatest(F.sum("ppb"), F.lit(0.0)).alias("m"))
    height = per_level.groupBy("volume").agg((F.sum(F.col("level") * LEVEL_M * F.col("m")) / F.sum("m")).alias("mean_height_m"))
    foreign = F.try_divide(F.col("_u") / F.col("_nu") * F.col("_nd"), F.col("_d"))
    return (
        stats.withColumn("foreign_share", F.when(F.col("_nu") > 0, foreign))
        .drop("_u", "_nu", "_d", "_nd", "center_col", "width_px")
        .join(height, "volume", "left")
    )


def volume_metrics(voxels: DataFrame, sources: DataFrame, heights: DataFrame, domain: Domain, noise: float = NOISE_PPB) -> DataFrame:
    """Weighted moments and extent of the interior of a volume.

    ``sources`` has volume, center_row, center_col; ``heights`` volume, level, z. One pass of sums
    over the voxels, and one over columns and levels for the visible extent.
    """
    d = domain
    inside = F.col("row").between(d.relax, d.ny - 1 - d.relax) & F.col("col").between(d.relax, d.nx - 1 - d.relax)
    v = voxels.join(sources.select("volume", "center_row", "center_col"), "volume").join(heights, ["volume", "level"]).where(inside)
    m = F.greatest(F.col("ppb"), F.lit(0.0))
    x = (F.col("col") - F.col("center_col")) * d.pixel_m
    y = (F.col("row") - F.col("center_row")) * d.pixel_m
    place = F.struct(F.col("ppb"), -F.col("level"), -F.col("row"), -F.col("col"))
    sums = v.groupBy("volume").agg(
        F.sum(m).alias("_t"),
        *[F.sum(m * e).alias(f"_{n}1") for n, e in (("x", x), ("y", y), ("z", F.col("z")))],
        *[F.sum(m * e * e).alias(f"_{n}2") for n, e in (("x", x), ("y", y), ("z", F.col("z")))],
        F.sum("ppb").alias("ime_ppb_px"),
        F.max("ppb").alias("peak_voxel_ppb"),
        F.max_by("level", place).alias("peak_level"),
        F.max_by(x, place).alias("peak_downwind_m"),
        F.max_by(y, place).alias("peak_crosswind_m"),
        F.count_if(F.col("ppb") != 0).alias("_nonzero"),
    )
    mean = lambda n: F.col(f"_{n}1") / F.col("_t")
    sd = lambda n: F.sqrt(F.greatest(F.col(f"_{n}2") / F.col("_t") - mean(n) * mean(n), F.lit(0.0)))
    column = volume_to_column(voxels.where(inside)).where(F.col("ppb") > noise)
    length = column.groupBy("volume").agg(((F.max("col") - F.min("col")) * d.pixel_m).alias("length_m"))
    step = heights.groupBy("volume").agg(((F.max("z") - F.min("z")) / (F.count("z") - 1)).alias("_dz"))
    tall = (
        v.where(F.col("ppb") > noise).groupBy("volume").agg((F.max("z") - F.min("z")).alias("_h")).join(step, "volume")
        .select("volume", (F.col("_h") + F.col("_dz")).alias("height_m"))
    )
    cells = d.nz * (d.ny - 2 * d.relax) * (d.nx - 2 * d.relax)
    zero = F.lit(0.0)
    return sums.join(length, "volume", "left").join(tall, "volume", "left").select(
        "volume",
        mean("x").alias("center_downwind_m"),
        mean("y").alias("center_crosswind_m"),
        mean("z").alias("mean_height_m"),
        sd("x").alias("sigma_downwind_m"),
        sd("y").alias("sigma_crosswind_m"),
        sd("z").alias("sigma_vertical_m"),
        F.coalesce("length_m", zero).alias("length_m"),
        F.coalesce("height_m", zero).alias("height_m"),
        "ime_ppb_px",
        "peak_voxel_ppb",
        "peak_level",
        "peak_downwind_m",
        "peak_crosswind_m",
        (F.col("_t") / 1e9 * TRACER_AIR_MOL * d.pixel_m * d.pixel_m).alias("mass_total_mol"),
        (1 - F.col("_nonzero") / F.lit(float(cells))).alias("zeros_share"),
    )


# Largest share of the peak at the entry and at the sides, largest share of mass upwind of
# the source, largest width at the exit, and the share of the peak from which an edge counts as touched.
ENTRY_SHARE = 0.02
LATERAL_SHARE = 0.02
FOREIGN_SHARE = 0.002
EXIT_WIDTH_M = 60.0
TOUCHED_SHARE = 0.05


def volume_criteria(measures: DataFrame) -> DataFrame:
    """The measures of ``snapshot_measures`` with edge shares, five criteria and whether all of them hold.

    A plume fades out if it falls towards the exit and is lower there than anywhere in its interior.
    Without a strip upwind of the source nothing is known about foreign mass, and that criterion fails.
    """
    sides = ("upwind", "downwind", "top", "bottom")
    share = {s: F.try_divide(F.col(f"edge_{s}"), F.col("peak")) for s in sides}
    known = lambda c: F.coalesce(c, F.lit(False))
    criteria = {
        "fades_out": (F.col("slope") < 0) & (F.col("edge_downwind") < F.col("interior_min")),
        "entry_ok": F.col("edge_upwind") < ENTRY_SHARE * F.col("peak"),
        "lateral_ok": (F.col("edge_top") < LATERAL_SHARE * F.col("peak")) & (F.col("edge_bottom") < LATERAL_SHARE * F.col("peak")),
        "foreign_ok": (F.col("foreign_share") < FOREIGN_SHARE) & ~F.isnan("foreign_share"),
        "width_ok": F.col("width_edge_m") <= EXIT_WIDTH_M,
    }
    rows = measures.select(
        "*",
        *[s.alias(f"{n}_share") for n, s in share.items()],
        F.greatest(*share.values()).alias("edge_share"),
        known(F.greatest(*share.values()) > TOUCHED_SHARE).alias("touches_edge"),
        *[known(c).alias(n) for n, c in criteria.items()],
    )
    return rows.withColumn("passes", F.expr(" and ".join(criteria)))


def snapshot_selection(df: DataFrame, run: Sequence[str], snap: str, passes: Column) -> DataFrame:
    """At most three passing snapshots per run, well apart and near the target minutes."""
    return choose_spaced_trio(df.where(passes), run, snap, SNAPSHOT_TARGETS, SNAPSHOT_GAP)


def bank_row_table(stats: DataFrame, sources: DataFrame, nodes: DataFrame, domain: Domain) -> DataFrame:
    """One row per plume and sun node: id, size, source position and growth beyond the domain.

    ``stats`` comes from ``threshold_and_crop`` keyed by volume and node, in the frame without the
    relaxation band; ``sources`` has volume, uid, center_row, center_col.
    """
    d = domain
    j = stats.join(sources, "volume").join(F.broadcast(nodes), "node")
    c = F.col
    width, height = c("col1") - c("col0") + 1, c("row1") - c("row0") + 1
    src_col = c("center_col") - d.relax - c("col0")
    south = c("center_row") - d.relax - c("row0")
    src_row = height - 1 - south
    rnd = lambda e: F.bround(e).cast("int")
    return j.select(
        F.format_string("%s_sza%04.1f_raa%05.1f", "uid", "sza", "raa").alias("id"),
        "volume",
        "node",
        "sza",
        "raa",
        width.alias("width"),
        height.alias("height"),
        src_col.alias("source_col"),
        src_row.alias("source_row"),
        rnd(src_col - (c("center_col") - d.relax)).alias("grow_upwind_px"),
        rnd(width - 1 - src_col - (d.exit - c("center_col"))).alias("grow_downwind_px"),
        rnd(src_row - (d.ny - 1 - d.relax - c("center_row"))).alias("grow_top_px"),
        rnd(height - 1 - src_row - (c("center_row") - d.relax)).alias("grow_bottom_px"),
        "threshold",
        (c("threshold") / c("peak")).alias("threshold_share"),
        "peak",
        "mass_before",
        "mass_after",
    )


def snapshot_universe(emitters: DataFrame, regular: Sequence[int], used: DataFrame) -> DataFrame:
    """Regular snapshots of every emitter together with the exact ones used elsewhere."""
    every = emitters.select("*", F.explode(F.array(*[F.lit(s) for s in regular])).alias("snap"))
    return every.unionByName(used.select(*every.columns)).distinct()
