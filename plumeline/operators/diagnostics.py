"""Cross-catalogue reports: twins, orphans, pairs, winds, fluxes and representativeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.functions.angles import EARTH_RADIUS_M
from plumeline.operators import aggs, spread, stats
from plumeline.operators.select import components_within

# Fixed values.
TWIN_IOU = 0.5
TWIN_CONTAINMENT = 0.9
PATCH_SIZES = (64, 128, 256)
PATCH_SHARE = 0.25


def twin_pairs(overlaps: DataFrame, sources: DataFrame) -> DataFrame:
    """Overlapping plumes of one catalogue that belong to different sources, with a twin flag."""
    src = lambda s: sources.select("scene", F.col("plume").alias(f"plume_{s}"), F.col("source").alias(f"source_{s}"))
    j = overlaps.join(src("a"), ["scene", "plume_a"]).join(src("b"), ["scene", "plume_b"])
    return j.where("source_a <> source_b").withColumn("twin", F.col("iou") >= TWIN_IOU)


def twin_report(pairs: DataFrame) -> DataFrame:
    """Twin pairs, touching pairs and the largest IoU per scene."""
    return pairs.groupBy("scene").agg(
        F.count_if("twin").alias("twins"), F.count(F.lit(1)).alias("touching"), F.max("iou").alias("max_iou")
    )


def group_components_report(links: DataFrame, scene: str, a: str, b: str, members: bool = True) -> DataFrame:
    """Groups of linked members per scene: how many, the largest, and the list by size then name.

    Lists are for scenes of ordinary size; without them only counts are kept.
    """
    member = links.select(F.col(a).alias("member")).unionByName(links.select(F.col(b).alias("member"))).schema["member"].dataType
    ends = links.select(scene, F.col(a).cast(member).alias("src"), F.col(b).cast(member).alias("dst"))
    # Dealt by scene once: groups are counted and listed where their scene is.
    named = components_within(ends, scene).withColumnRenamed("node", "member").repartition(scene)
    if not members:
        sizes = named.groupBy(scene, "component").agg(F.count(F.lit(1)).alias("_k"))
        return sizes.groupBy(scene).agg(F.count(F.lit(1)).alias("groups"), F.max("_k").alias("largest"))
    texts = F.array_sort(F.collect_set(F.col("member").cast("string"))).alias("members")
    groups = named.groupBy(scene, "component").agg(F.count(F.lit(1)).alias("_k"), texts)
    # A scene's groups come from its plumes, at most 255 of them.
    lists = F.array_sort(F.collect_list(F.struct((-F.col("_k")).alias("k"), F.col("members")))).alias("_l")
    report = groups.groupBy(scene).agg(F.count(F.lit(1)).alias("groups"), F.max("_k").alias("largest"), lists)
    return report.select(scene, "groups", "largest", F.to_json(F.transform("_l", lambda g: g["members"])).alias("members"))


def orphan_kinds(orphans: DataFrame, matched: DataFrame, overlaps: DataFrame) -> DataFrame:
    """Orphans that are twins of a matched plume, overlap one partly, or stand alone.

    ``overlaps`` lists pairs inside the orphan's own catalogue in either order.
    """
    flip = overlaps.select(
        "scene", F.col("plume_b").alias("plume"), F.col("plume_a").alias("other"), "iou", F.col("in_b").alias("inside")
    )
    both = overlaps.select(
        "scene", F.col("plume_a").alias("plume"), F.col("plume_b").alias("other"), "iou", F.col("in_a").alias("inside")
    ).unionByName(flip)
    hit = both.join(matched.select("scene", F.col("plume").alias("other")), ["scene", "other"], "left_semi")
    best = hit.groupBy("scene", "plume").agg(F.max("iou").alias("best_iou"), F.max("inside").alias("best_inside"))
    out = orphans.select("scene", "plume").join(best, ["scene", "plume"], "left").na.fill(0.0, ["best_iou", "best_inside"])
    kind = (
        F.when((F.col("best_iou") >= TWIN_IOU) | (F.col("best_inside") >= TWIN_CONTAINMENT), "twin")
        .when(F.col("best_iou") > 0, "partial")
        .otherwise("genuine")
    )
    return out.withColumn("kind", kind)


def pairs_with_twin(pairs: DataFrame, twins: DataFrame) -> DataFrame:
    """Matched pairs per scene and how many of them have a partner that is one of two twins."""
    names = (
        twins.select("scene", F.col("plume_a").alias("plume_b"))
        .unionByName(twins.select("scene", "plume_b"))
        .distinct()
        .withColumn("_t", F.lit(1))
    )
    j = pairs.join(names, ["scene", "plume_b"], "left")
    return j.groupBy("scene").agg(F.count(F.lit(1)).alias("pairs"), F.count("_t").alias("with_twin")).where("with_twin > 0")


def pair_similarity(pairs: DataFrame, flux_a: DataFrame, flux_b: DataFrame) -> DataFrame:
    """Flux ratio beside area ratio, IoU and distance of every matched pair."""
    fa = flux_a.select("scene", F.col("plume").alias("plume_a"), F.col("flux").alias("flux_a"))
    fb = flux_b.select("scene", F.col("plume").alias("plume_b"), F.col("flux").alias("flux_b"))
    j = pairs.join(fa, ["scene", "plume_a"], "left").join(fb, ["scene", "plume_b"], "left")
    return j.select(
        "scene",
        "plume_a",
        "plume_b",
        "flux_a",
        "flux_b",
        F.try_divide("flux_b", "flux_a").alias("flux_ratio"),
        (F.col("area_b") / F.col("area_a")).alias("area_ratio"),
        "iou",
        "dist",
    )


def flux_vs_wind_ratio(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Flux ratio and wind ratio of pairs with both quantities positive on both sides."""
    left = a.select("scene", F.col("plume").alias("plume_a"), F.col("flux").alias("_fa"), F.col("wind").alias("_wa"))
    right = b.select("scene", F.col("plume").alias("plume_b"), F.col("flux").alias("_fb"), F.col("wind").alias("_wb"))
    j = pairs.select("scene", "plume_a", "plume_b").join(left, ["scene", "plume_a"]).join(right, ["scene", "plume_b"])
    good = (F.col("_fa") > 0) & (F.col("_fb") > 0) & (F.col("_wa") > 0) & (F.col("_wb") > 0)
    return j.where(good).select(
        "scene", "plume_a", "plume_b", (F.col("_fb") / F.col("_fa")).alias("flux_ratio"), (F.col("_wb") / F.col("_wa")).alias("wind_ratio")
    )


def wind_sampling_modes(field: DataFrame, plumes: DataFrame, points: DataFrame, published: DataFrame) -> DataFrame:
    """Wind speed at the source, over the plume and over the scene next to the published one.

    ``field`` has scene, row, col, speed; ``plumes`` scene, plume, row, col; ``points`` one pixel per
    plume; ``published`` scene, plume, theirs.
    """
    scene = field.groupBy("scene").agg(F.avg("speed").alias("scene_mean"))
    over = plumes.join(field, ["scene", "row", "col"]).groupBy("scene", "plume").agg(F.avg("speed").alias("over_plume"))
    at = points.join(field, ["scene", "row", "col"]).groupBy("scene", "plume").agg(F.first("speed").alias("at_point"))
    return published.where("theirs > 0").join(at, ["scene", "plume"], "left").join(over, ["scene", "plume"], "left").join(scene, "scene", "left")


def wind_intrascene_spread(df: DataFrame, scene: str, u: Column, v: Column) -> DataFrame:
    """Range of speed and circular spread of direction inside a scene."""
    speed = F.hypot(u, v)
    to = F.pmod(F.degrees(F.atan2(u, v)), F.lit(360.0))
    w = df.select(scene, speed.alias("_s"), to.alias("_d"))
    circ = aggs.circular_stats(w, [scene], "_d").select(scene, "circular_sd", "resultant")
    base = w.groupBy(scene).agg(
        F.min("_s").alias("speed_min"),
        F.max("_s").alias("speed_max"),
        F.try_divide(F.max("_s"), F.min("_s")).alias("speed_ratio"),
    )
    return base.join(circ, scene)


def ring_area_m2(ring: Column) -> Column:
    """Area of a lon/lat ring by the shoelace rule in equal-area cylinder coordinates."""
    n = F.size(ring)
    x = lambda p: F.radians(p["lon"]) * EARTH_RADIUS_M
    y = lambda p: F.sin(F.radians(p["lat"])) * EARTH_RADIUS_M

    def edge(acc, i):
        p, q = F.get(ring, i), F.get(ring, (i + 1) % n)
        return acc + x(p) * y(q) - x(q) * y(p)

    return F.abs(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), edge)) / 2


def flux_area_relation(df: DataFrame, flux: str, area_px: str, sizes: Sequence[int] = PATCH_SIZES) -> DataFrame:
    """Rank correlation of flux and area, and the share of plumes filling at most a quarter of a patch."""
    good = df.where((F.col(flux) > 0) & (F.col(area_px) > 0))
    logs = good.select(F.log10(flux).alias("_f"), F.log10(area_px).alias("_a"))
    rho = stats.spearman(logs, [], "_f", "_a").select("rho", F.lit(1).alias("_1"))
    fits = good.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg((F.col(area_px) <= s * s * PATCH_SHARE).cast("double")).alias(f"fits_{s}") for s in sizes],
    ).withColumn("_1", F.lit(1))
    return fits.join(rho, "_1").drop("_1")


def unquantified_profile(df: DataFrame, flux: str, area: str) -> DataFrame:
    """Plume size where the flux is known and where it is not."""
    kind = F.when(F.col(flux).isNull(), "without flux").otherwise("with flux")
    return spread.summary(df.withColumn("kind", kind), ["kind"], [F.count(F.lit(1)).alias("n")], area, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def stale_negatives(free: DataFrame, plumes: DataFrame, key: str, inserted: str, cutoff: Column) -> DataFrame:
    """Plume-free granules that gained a plume after the cutoff."""
    late = plumes.where(F.col(inserted) > cutoff).groupBy(key).agg(F.count(F.lit(1)).alias("late_plumes"), F.min(inserted).alias("first_late"))
    return free.select(key).join(late, key)


def isolate_attribution(df: DataFrame, institution: str, names: Mapping[str, str]) -> DataFrame:
    """How many rows name each institution."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(institution).contains(t)).alias(n) for n, t in names.items()])


def representativeness_report(df: DataFrame, population: str, dimensions: Mapping[str, Column]) -> DataFrame:
    """Rows and shares of every value of several dimensions in every population, in one pass."""
    items = F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("key")) for n, c in dimensions.items()])
    long = df.select(population, F.explode(items).alias("i")).select(population, "i.*").where("key is not null")
    counts = long.groupBy(population, "dimension", "key").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(population, "dimension").agg(F.sum("n").alias("_t"))
    return counts.join(totals, [population, "dimension"]).select(
        population, "dimension", "key", "n", (100 * F.col("n") / F.col("_t")).alias("share")
    )
