"""Aggregations: rollups, counts per class, strata, quantiles, circular statistics, extents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.functions.angles import FILL_LIMIT, WEAK_KG_H
from plumeline.operators import spread

# Left-closed flux bins in kg/h.
FLUX_EDGES = (0.0, 100.0, 300.0, 1000.0, 3000.0)
FLUX_LABELS = ("0-100", "100-300", "300-1000", "1000-3000", "3000+")


def granule_rollup(df: DataFrame, key: str, value: str, prefix: str, extra: Sequence[Column] = ()) -> DataFrame:
    """Count, maximum and exact median of a value per granule, with further aggregates."""
    return spread.summary(
        df.where(F.col(key).isNotNull()),
        [key],
        [F.count(F.lit(1)).alias(f"n_{prefix}"), F.max(value).alias(f"flux_max_{prefix}"), *extra],
        value,
        {f"flux_med_{prefix}": 0.5},
    )


def class_counts(flux: Column, weak: float = WEAK_KG_H) -> tuple[Column, Column]:
    """Aggregates counting weak (above 0, below the limit) and strong plumes."""
    return F.count_if((flux > 0) & (flux < weak)), F.count_if(flux >= weak)


def mode_agg(df: DataFrame, key: str, value: str, out: str, empty: str = "unknown") -> DataFrame:
    """Most frequent value per key; ties take the smallest, groups without one the default."""
    counts = df.groupBy(key, value).agg(F.count(value).alias("_n"))
    best = F.min_by(F.when(F.col("_n") > 0, F.col(value)), F.when(F.col("_n") > 0, F.struct(-F.col("_n"), F.col(value))))
    return counts.groupBy(key).agg(F.coalesce(best, F.lit(empty)).alias(out))


def dominant_category(df: DataFrame, key: str, category: str, weight: Column, first_seen: Column, out: str) -> DataFrame:
    """Category with the largest summed weight; ties go to the one seen first."""
    sums = df.groupBy(key, category).agg(F.sum(weight).alias("_w"), F.min(first_seen).alias("_f"))
    return sums.groupBy(key).agg(F.min_by(category, F.struct(-F.col("_w"), F.col("_f"))).alias(out))


def collect_json(df: DataFrame, key: str, name: str, value: str, out: str, parts: int = 1) -> DataFrame:
    """Sorted name-to-value object per key, and per ``part`` of its names, as JSON; see ``with_parts``."""
    rows = spread.with_parts(df, name, parts)
    entries = F.array_sort(F.collect_list(F.struct(F.col(name).cast("string").alias("k"), F.col(value).alias("v"))))
    return rows.groupBy(key, "part").agg(F.to_json(F.map_from_entries(entries)).alias(out))


def explode_map_values(df: DataFrame, text: str, value_type: str = "double") -> DataFrame:
    """One row per entry of a JSON object column."""
    return df.select(
        *[c for c in df.columns if c != text],
        F.explode(F.from_json(F.col(text), f"map<string,{value_type}>")).alias("name", "value"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value and its share of all non-null rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n"))
    return counts.select(column, "n", (F.col("n") / total.scalar()).alias("share"))


def strata_occupancy(df: DataFrame, axis_sets: Sequence[Sequence[str]], targets: Sequence[int]) -> DataFrame:
    """Cell statistics of several axis sets in one pass, and how far a hard quota would reach."""
    axes = list(dict.fromkeys(a for s in axis_sets for a in s))
    sets = [[F.col(a) for a in s] for s in axis_sets]
    bits = " ".join(f"WHEN {_grouping_code(axes, s)} THEN '{' x '.join(s)}'" for s in axis_sets)
    cells = (
        df.groupingSets(sets, *[F.col(a) for a in axes])
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*axes).alias("_g"))
        .select(F.expr(f"CASE _g {bits} END").alias("axes"), "n")
    )
    # Cells are counts of categories: as many rows as combinations of the axes.
    base = cells.groupBy("axes").agg(
        F.count(F.lit(1)).alias("cells"),
        F.min("n").alias("min_n"),
        F.percentile("n", 0.5).alias("median_n"),
        F.max("n").alias("max_n"),
    )
    wide = base.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
    quota = F.col("target") / F.col("cells")
    return (
        cells.join(wide, "axes")
        .groupBy("axes", "cells", "min_n", "median_n", "max_n", "target")
        .agg(
            F.count_if(F.col("n") >= quota).alias("fillable"),
            F.sum(F.least(F.col("n"), F.ceil(quota))).alias("reachable"),
        )
    )


def _grouping_code(axes: Sequence[str], used: Sequence[str]) -> int:
    code = 0
    for a in axes:
        code = code * 2 + (0 if a in used else 1)
    return code


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str], share: bool = False) -> DataFrame:
    """Two-way counts with zeros, or percentages of each row."""
    wide = df.groupBy(row).pivot(column, list(values)).count().na.fill(0)
    if not share:
        return wide
    total = sum((F.col(f"`{v}`") for v in values[1:]), F.col(f"`{values[0]}`"))
    return wide.select(row, *[(100 * F.col(f"`{v}`") / total).alias(v) for v in values])


def diagonal_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.sum("n").alias("pairs"),
        (F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)) / F.sum("n")).alias("agreement"),
    )


def flux_bin(flux: Column) -> Column:
    """Label of the left-closed bin of a flux."""
    out = None
    for edge, label in reversed(list(zip(FLUX_EDGES, FLUX_LABELS))):
        out = F.when(flux >= edge, label) if out is None else out.when(flux >= edge, label)
    return out


def binned_shares(df: DataFrame, population: str, flux: str) -> DataFrame:
    """Per population: rows, weak share, share per flux bin and p10 to p90 of positive fluxes."""
    positive = df.where(F.col(flux) > 0)
    shares = [
        (100 * F.count_if(flux_bin(F.col(flux)) == label) / F.count(F.lit(1))).alias(label) for label in FLUX_LABELS
    ]
    return spread.summary(
        positive,
        [population],
        [
            F.count(F.lit(1)).alias("n"),
            (100 * F.count_if(F.col(flux) < WEAK_KG_H) / F.count(F.lit(1))).alias("weak"),
            *shares,
        ],
        flux,
        {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9},
    )


def topn_with_other(df: DataFrame, population: str, column: str, reference: str, n: int) -> DataFrame:
    """Share of the reference population's n most frequent values in every population."""
    counts = df.where(F.col(column).isNotNull()).groupBy(population, column).agg(F.count(F.lit(1)).alias("_n"))
    top = (
        counts.where(F.col(population) == reference)
        .orderBy(F.desc("_n"), column)
        .limit(n)
        .select(F.col(column).alias("_top"))
    )
    named = counts.join(F.broadcast(top), F.col(column) == F.col("_top"), "left").select(
        population, F.coalesce("_top", F.lit("Other")).alias(column), "_n"
    )
    totals = counts.groupBy(population).agg(F.sum("_n").alias("_t"))
    return (
        named.groupBy(population, column)
        .agg(F.sum("_n").alias("n"))
        .join(totals, population)
        .select(population, column, "n", (100 * F.col("n") / F.col("_t")).alias("share"))
    )


def funnel_counts(levels: Mapping[str, DataFrame], granule: str) -> DataFrame:
    """Rows and granules left at each selection level."""
    out = None
    for i, (name, df) in enumerate(levels.items()):
        part = df.agg(
            F.lit(i).alias("step"),
            F.lit(name).alias("level"),
            F.count(F.lit(1)).alias("plumes"),
            F.count_distinct(granule).alias("granules"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def mean_sd(df: DataFrame, keys: Sequence[str], value: str, digits: int = 4) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.round(F.avg(value), digits).alias("mean"), F.round(F.stddev_samp(value), digits).alias("sd")
    )


def ecdf(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values with the cumulative fraction of rows at or below each."""
    placed = spread.ordered_totals(df, keys, value, {"n": F.count(F.lit(1))})
    return placed.select(*keys, value, ((F.col("n_before") + F.col("n")) / F.col("n_total")).alias("fraction"))


def scene_min_flag_share(df: DataFrame, group: str, scene: str, value: str, limit: float) -> DataFrame:
    """Share of scenes whose smallest value lies under a limit."""
    return (
        df.groupBy(group, scene)
        .agg(F.min(value).alias("_m"))
        .groupBy(group)
        .agg(F.avg((F.col("_m") < limit).cast("double")).alias("share"), F.count("_m").alias("scenes"))
    )


def circular_stats(df: DataFrame, keys: Sequence[str], degrees: str) -> DataFrame:
    """Resultant length, circular mean and circular standard deviation in degrees."""
    s, c = F.avg(F.sin(F.radians(degrees))), F.avg(F.cos(F.radians(degrees)))
    g = df.groupBy(*keys).agg(s.alias("_s"), c.alias("_c"))
    r = F.hypot("_s", "_c")
    return g.select(
        *keys,
        r.alias("resultant"),
        F.pmod(F.degrees(F.atan2("_s", "_c")), F.lit(360.0)).alias("mean_direction"),
        F.degrees(F.sqrt(-2 * F.ln(F.least(r, F.lit(1.0))))).alias("circular_sd"),
    )


def is_fill(value: Column) -> Column:
    """True for fill codes and values that are not finite."""
    infinite = F.abs(value.cast("double")) == float("inf")
    return value.isNull() | F.isnan(value) | infinite | (value <= FILL_LIMIT)


def nodata_percent(df: DataFrame, scene: str, value: str) -> DataFrame:
    bad = F.when(is_fill(F.col(value)), 1).otherwise(0)
    return df.groupBy(scene).agg((100 * F.avg(bad)).alias("nodata_pct"))


def nodata_summary(df: DataFrame, percent: str, limits: Sequence[float] = (0, 5, 25)) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("granules"), *[F.count_if(F.col(percent) <= x).alias(f"le_{x}") for x in limits]
    )


def valid_min_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    v = F.when(~is_fill(F.col(value)), F.col(value))
    return df.groupBy(*keys).agg(F.min(v).alias("min"), F.max(v).alias("max"))


def band_means(df: DataFrame, scene: str, band: str, value: str, names: Mapping[int, str]) -> DataFrame:
    """Mean of each named observation band, fill left out, one column per band."""
    means = [
        F.avg(F.when((F.col(band) == b) & ~is_fill(F.col(value)), F.col(value))).alias(n) for b, n in names.items()
    ]
    return df.where(F.col(band).isin(*names)).groupBy(scene).agg(*means)


def scene_bbox(df: DataFrame, keys: Sequence[str], lon: str, lat: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(lon).alias("west"), F.min(lat).alias("south"), F.max(lon).alias("east"), F.max(lat).alias("north")
    )


def wind_scene_mean(df: DataFrame, scene: str, u: Column, v: Column) -> DataFrame:
    return df.groupBy(scene).agg(
        F.avg(u).alias("wind_u"), F.avg(v).alias("wind_v"), F.avg(F.hypot(u, v)).alias("wind_speed")
    )


def mask_coverage(df: DataFrame, scene: str, a: Column, b: Column) -> DataFrame:
    """Percent of pixels under each mask and under their union."""
    pct = lambda c: 100 * F.avg(F.when(c, 1).otherwise(0))
    return df.groupBy(scene).agg(
        pct(a).alias("coverage_a"), pct(b).alias("coverage_b"), pct(a | b).alias("coverage_union")
    )


def bbox_per_instance(df: DataFrame, keys: Sequence[str], row: str = "row", col: str = "col") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(row).alias("row0"),
        F.min(col).alias("col0"),
        F.max(row).alias("row1"),
        F.max(col).alias("col1"),
        F.count(F.lit(1)).alias("pixels"),
    )


def bits_set(mask: Column, width: int = 64) -> Column:
    """1-based numbers of the bits set in a 64-bit mask; the sign bit is number 64."""
    return F.filter(F.sequence(F.lit(1), F.lit(width)), lambda b: F.getbit(mask, b - 1) == 1)


def band_stats(df: DataFrame, keys: Sequence[str], value: str, nodata: float = 0.0) -> DataFrame:
    """Min, max, mean, population sd, valid percent and quartiles; all zero for an empty band."""
    v = F.when((F.col(value) != nodata) & ~is_fill(F.col(value)), F.col(value))
    marked = df.select(*keys, v.alias("_x"))
    stats = spread.summary(
        marked,
        keys,
        [
            F.min("_x").alias("min"),
            F.max("_x").alias("max"),
            F.avg("_x").alias("mean"),
            F.stddev_pop("_x").alias("sd"),
            (100 * F.count("_x") / F.count(F.lit(1))).alias("valid"),
        ],
        "_x",
        {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95},
    )
    return stats.na.fill(0.0)


def histogram_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], bins: int = 100
) -> DataFrame:
    """Centre of the histogram bin in which each cumulative share is reached."""
    ends = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    slot = F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("_lo")) / width))
    counts = (
        df.join(ends, list(keys))
        .withColumn("_b", F.coalesce(slot, F.lit(0)))
        .groupBy(*keys, "_lo", "_hi", "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # At most `bins` rows per group from here on.
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.select("*", F.sum("_n").over(upto).alias("_c"), F.sum("_n").over(whole).alias("_t"))
    centre = F.col("_lo") + (F.col("_b") + 0.5) * width
    return placed.groupBy(*keys).agg(
        *[F.min(F.when(F.col("_c") >= p * F.col("_t"), centre)).alias(n) for n, p in probs.items()]
    )


def cohort_extent(df: DataFrame, keys: Sequence[str], lon: str, lat: str, time: str) -> DataFrame:
    """Bounding box and time span of each container and of the whole collection."""
    sets = [[F.col(k) for k in keys], []]
    return df.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.min(lon).alias("west"),
        F.min(lat).alias("south"),
        F.max(lon).alias("east"),
        F.max(lat).alias("north"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.count(F.lit(1)).alias("n"),
    )


def facet_counts(df: DataFrame, facets: Mapping[str, Column]) -> DataFrame:
    """Per facet value, the rows that pass every filter but the facet's own; one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("facet"), F.col(name).cast("string").alias("value"), cond.alias("hit"))
            for name, cond in facets.items()
        ]
    )
    return (
        df.select(F.explode(pairs).alias("f"))
        .where("f.value is not null")
        .groupBy("f.facet", "f.value")
        .agg(F.count_if(F.col("f.hit")).alias("n"))
    )


def stacked_points(df: DataFrame, source: Column, lon: str, lat: str, ident: str) -> DataFrame:
    """Distinct features per source, or per identical coordinates where there is no source."""
    place = F.concat_ws("/", F.col(lon).cast("string"), F.col(lat).cast("string"))
    stack = F.coalesce(source.cast("string"), place)
    return (
        df.select(stack.alias("stack"), ident)
        .distinct()
        .groupBy("stack")
        .agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("first_id"))
    )


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first in a declared order."""
    rest = [c for c in df.columns if c != key]
    row = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(row.alias("_r")).select(key, "_r.*")


def revisit_stats(df: DataFrame, location: str, day: str) -> DataFrame:
    """Locations seen on more than one date."""
    return (
        df.groupBy(location)
        .agg(F.count_distinct(day).alias("dates"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
        .where("dates > 1")
    )


def coverage_report(df: DataFrame, a: Column, b: Column, cost: float) -> DataFrame:
    """Keys with A, with B and with both, and the cost of what is missing."""
    return df.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(a).alias("with_a"),
        F.count_if(b).alias("with_b"),
        F.count_if(a & b).alias("with_both"),
        (F.count_if(~a) * cost).alias("missing_cost"),
    )


def reason_diagnosis(
    df: DataFrame,
    key: str,
    cloud: str,
    methane: str,
    strict: float = 0.02,
    relaxed: float = 0.50,
    methane_max: float = 0.03,
    need: int = 3,
) -> DataFrame:
    """How many candidates each sample has under both limits, and what holds it back."""
    clean = F.col(methane) <= methane_max
    counts = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if((F.col(cloud) <= strict) & clean).alias("ok_strict"),
        F.count_if((F.col(cloud) <= relaxed) & clean).alias("ok_relaxed"),
        F.count_if(clean).alias("_clean"),
    )
    c = F.col
    reason = (
        F.when(c("ok_strict") >= need, F.format_string("ok strict (%d)", "ok_strict"))
        .when(c("ok_relaxed") >= need, F.format_string("ok relaxed (%d, %d strict)", "ok_relaxed", "ok_strict"))
        .when((c("ok_relaxed") == 0) & (c("_clean") == 0), F.format_string("methane in all %d", "candidates"))
        .when(c("ok_relaxed") == 0, F.format_string("cloud in all %d", "candidates"))
        .otherwise(F.format_string("only %d of %d", "ok_relaxed", F.lit(need)))
    )
    return counts.withColumn("reason", reason).drop("_clean")
