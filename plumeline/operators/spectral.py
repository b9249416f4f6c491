"""Spectral filters and similarity measures on pixel tables with spectra as arrays."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.functions.angles import BAND_COUNT, FIRST_BAND_NM, LAST_BAND_NM
from plumeline.operators import spread
from plumeline.operators.ranks import finite
from plumeline.operators.stats import partial_gram
from plumeline.session import settled

# Fixed values of the retrieval.
RETRIEVAL_WINDOW_NM = (2122.0, 2488.0)
WIDE_WINDOW_NM = (1000.0, 2500.0)
WIDE_EXCLUDED_NM = ((1340.0, 1450.0), (1800.0, 1960.0))
SCALING = 1e5
ALPHA = 1e-4
TINY = 1e-9
METHANE_RATIO = 0.92
MIN_COMMON_PIXELS = 100
QA_BITS = (1, 2, 3, 4)
CLEAR_SCORE = 0.6
MIN_RIDGE_PIXELS = 50


# --- band windows ---------------------------------------------------------------------------


def band_centre(band: int) -> float:
    """Wavelength of a 1-based band."""
    return FIRST_BAND_NM + (band - 1) * (LAST_BAND_NM - FIRST_BAND_NM) / (BAND_COUNT - 1)


def window_bands(window: tuple[float, float], excluded: Sequence[tuple[float, float]] = ()) -> list[int]:
    """1-based bands inside a window and outside the half-open excluded ranges."""
    return [
        b
        for b in range(1, BAND_COUNT + 1)
        if window[0] <= band_centre(b) <= window[1] and not any(lo <= band_centre(b) < hi for lo, hi in excluded)
    ]


def wide_window(wavelength: Column) -> Column:
    """Whether a wavelength belongs to the wide retrieval window."""
    inside = wavelength.between(*WIDE_WINDOW_NM)
    for lo, hi in WIDE_EXCLUDED_NM:
        inside = inside & ~((wavelength >= lo) & (wavelength < hi))
    return inside


def take_bands(spectrum: Column, keep: Sequence[int]) -> Column:
    """Array with the listed 0-based bands."""
    return F.transform(F.array(*[F.lit(int(b)) for b in keep]), lambda i: F.get(spectrum, i))


# --- ratios ---------------------------------------------------------------------------------


def mbmp(t1: Column, t2: Column, r1: Column, r2: Column, eps: float = TINY) -> Column:
    """Fractional change of the band ratio against a reference; null without reference signal."""
    value = ((t2 + eps) / (r2 + eps)) / ((t1 + eps) / (r1 + eps)) - 1.0
    return F.when((r1 > 0) & (r2 > 0), value)


def mbmp_multi_reference(df: DataFrame, pixel: Sequence[str], value: str) -> DataFrame:
    """Median over the references of a pixel; a pixel has four of them."""
    return df.groupBy(*pixel).agg(F.percentile(value, 0.5).alias("mbmp"), F.count(value).alias("references"))


def target_reference_ratio(df: DataFrame, target: str, references: Sequence[str]) -> DataFrame:
    """Target over reference minus one per band, and whether each reference is valid throughout."""
    out = df
    for i, name in enumerate(references):
        pairs = F.arrays_zip(F.col(target).alias("t"), F.col(name).alias("b"))
        ratio = F.transform(pairs, lambda p: F.try_divide(p["t"].cast("double"), p["b"].cast("double")) - 1.0)
        valid = F.forall(
            pairs, lambda p: p["t"].isNotNull() & finite(p["t"]) & p["b"].isNotNull() & finite(p["b"]) & (p["b"] != 0)
        )
        out = out.withColumn(f"ok{i}", valid).withColumn(f"r{i}", F.when(F.col(f"ok{i}"), ratio))
    return out


def feature_sets(df: DataFrame, target: str, ratios: Sequence[str]) -> DataFrame:
    """Feature vectors: target, first ratio, mean of the valid ratios, all ratios, all with target."""
    r0 = F.col(ratios[0])
    valid = F.filter(F.array(*[F.col(r) for r in ratios]), lambda r: r.isNotNull())
    count = F.size(valid)
    total = F.aggregate(
        F.slice(valid, 2, F.greatest(count - 1, F.lit(0))),
        F.get(valid, F.lit(0)),
        lambda acc, r: F.zip_with(acc, r, lambda a, b: a + b),
    )
    mean = F.when(count > 0, F.transform(total, lambda v: v / count))
    every = F.when(count == len(ratios), F.flatten(valid))
    t = F.col(target).cast("array<double>")
    return df.select(
        "*",
        t.alias("f_target"),
        F.when(count > 0, t).alias("f_target_common"),
        r0.alias("f_r0"),
        mean.alias("f_rmean"),
        every.alias("f_r4"),
        F.concat(every, t).alias("f_r4t"),
    )


# --- similarity to a reference ------------------------------------------------------------------


def mars_difference(df: DataFrame, keys: Sequence[str], band: str, target: str, reference: str, min_pixels: int = MIN_COMMON_PIXELS) -> DataFrame:
    """Mean over bands of the mean absolute residual after matching the reference's mean.

    Two aggregations over pixels where both are finite; bands with too few of them are left out.
    """
    both = df.where(finite(F.col(target)) & finite(F.col(reference)))
    means = both.groupBy(*keys, band).agg(
        F.avg(target).alias("_t"), F.avg(reference).alias("_b"), F.count(F.lit(1)).alias("_n")
    )
    gains = means.where((F.col("_n") >= min_pixels) & (F.abs("_b") > 1e-12)).select(
        *keys, band, (F.col("_t") / F.col("_b")).alias("_g")
    )
    residual = F.abs(F.col(target) - F.col("_g") * F.col(reference))
    per_band = both.join(gains, [*keys, band]).groupBy(*keys, band).agg(F.avg(residual).alias("_r"))
    return per_band.groupBy(*keys).agg(F.avg("_r").alias("difference"), F.count("_r").alias("bands"))


def methane_fraction(df: DataFrame, keys: Sequence[str], swir1: str, swir2: str, threshold: float = METHANE_RATIO) -> DataFrame:
    """Share of pixels whose band ratio lies below a fraction of the chip's own median."""
    good = df.where((F.col(swir1) > 0) & (F.col(swir2) > 0)).select(*keys, (F.col(swir2) / F.col(swir1)).alias("_r"))
    medians = spread.percentiles(good, keys, "_r", {"_m": 0.5})
    low = (F.col("_r") < threshold * F.col("_m")).cast("double")
    return good.join(medians, list(keys)).groupBy(*keys).agg(F.avg(low).alias("methane"))


def qa_clear_score(df: DataFrame, keys: Sequence[str], qa: str) -> DataFrame:
    """Percent of pixels with none of the cloud bits set."""
    bad = F.lit(False)
    for b in QA_BITS:
        bad = bad | (F.getbit(F.col(qa), F.lit(b)) == 1)
    return df.groupBy(*keys).agg((100 * F.avg(F.when(bad, 0.0).otherwise(1.0))).alias("clear"))


def clear_share(df: DataFrame, keys: Sequence[str], score: str, limit: float = CLEAR_SCORE) -> DataFrame:
    """Percent of pixels whose clear-sky score reaches the limit; no score counts as not clear."""
    ok = F.coalesce((F.col(score) >= limit).cast("double"), F.lit(0.0))
    return df.groupBy(*keys).agg((100 * F.avg(ok)).alias("clear"))


def coregister_shift(df: DataFrame, scene: str, target: str, reference: str, reach: int) -> DataFrame:
    """Shift of the reference that correlates best with the target, refined by a parabola.

    Pixels meet their shifted partners by key; a scene ends with one correlation per shift.
    """
    span = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    moved = (
        df.select(scene, "row", "col", F.col(reference).alias("_b"))
        .withColumn("dy", span)
        .withColumn("dx", span)
        .select(scene, (F.col("row") + F.col("dy")).alias("row"), (F.col("col") + F.col("dx")).alias("col"), "dy", "dx", "_b")
    )
    joined = df.select(scene, "row", "col", F.col(target).alias("_t")).join(moved, [scene, "row", "col"])
    corr = joined.groupBy(scene, "dy", "dx").agg(F.corr("_t", "_b").alias("c")).where("c is not null")
    best = corr.groupBy(scene).agg(F.min_by(F.struct("dy", "dx", "c"), F.struct(-F.col("c"), F.abs("dy"), F.abs("dx"), "dy", "dx")).alias("_b"))
    best = best.select(scene, "_b.*")
    near = corr.select(scene, F.col("dy").alias("_y"), F.col("dx").alias("_x"), F.col("c").alias("_c"))
    around = best.join(near, scene).where(F.abs(F.col("_y") - F.col("dy")) + F.abs(F.col("_x") - F.col("dx")) == 1)
    pick = lambda dy, dx: F.max(F.when((F.col("_y") == F.col("dy") + dy) & (F.col("_x") == F.col("dx") + dx), F.col("_c")))
    sides = around.groupBy(scene).agg(
        pick(-1, 0).alias("_u"), pick(1, 0).alias("_d"), pick(0, -1).alias("_l"), pick(0, 1).alias("_r")
    )
    c = F.col
    bend = lambda a, b: F.coalesce(F.try_divide((a - b) * 0.5, a - 2 * c("c") + b), F.lit(0.0))
    return best.join(sides, scene, "left").select(
        scene, "dy", "dx", c("c").alias("correlation"), (c("dy") + bend(c("_u"), c("_d"))).alias("sub_dy"), (c("dx") + bend(c("_l"), c("_r"))).alias("sub_dx")
    )


def gaussian_residual(df: DataFrame, scene: str, value: str, shape: DataFrame, sigma: float = 1.0) -> DataFrame:
    """Value minus its Gaussian-smoothed copy; missing values smooth as zero, edges mirror.

    The kernel is separable: every pixel asks for its neighbours along rows, then along columns.
    """
    radius = int(4 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weights /= weights.sum()
    taps = F.array(*[F.struct(F.lit(k - radius).alias("k"), F.lit(float(w)).alias("w")) for k, w in enumerate(weights)])
    out = df.select(scene, "row", "col", F.coalesce(F.when(finite(F.col(value)), F.col(value)), F.lit(0.0)).alias("_v"))
    for axis, size in (("row", "height"), ("col", "width")):
        other = "col" if axis == "row" else "row"
        period = 2 * F.col(size)
        wrapped = F.pmod(F.col(axis) + F.col("_k.k"), period)
        mirror = F.when(wrapped < F.col(size), wrapped).otherwise(period - 1 - wrapped).cast("int")
        asks = (
            df.select(scene, "row", "col").join(shape, scene).withColumn("_k", F.explode(taps))
            .select(scene, "row", "col", mirror.alias("_src"), F.col("_k.w").alias("_w"))
        )
        source = out.select(scene, F.col(axis).alias("_src"), other, "_v")
        out = asks.join(source, [scene, "_src", other]).groupBy(scene, "row", "col").agg(F.sum(F.col("_w") * F.col("_v")).alias("_v"))
    return df.join(out, [scene, "row", "col"]).withColumn("residual", F.col(value) - F.col("_v")).drop("_v")


def mbmp_plus(df: DataFrame, scene: str, target: str, reference: str, swir: tuple[int, int], n: int, alpha: float = 1.0) -> DataFrame:
    """Inverse-pair difference minus what a ridge on the temporal ratios predicts.

    Sums of products per scene are added up in the tasks; each scene then solves one small system,
    and the weights go back to its pixels. Scenes with too few valid pixels keep the plain value.
    """
    a, b = swir
    t = lambda k: F.get(F.col(target), F.lit(k)).cast("double")
    r = lambda k: F.get(F.col(reference), F.lit(k)).cast("double")
    plain = F.when((F.abs(t(b)) > TINY) & (F.abs(r(b)) > TINY), t(a) / t(b) - r(a) / r(b))
    others = [k for k in range(n) if k not in swir]
    ratios = F.array(*[F.when(F.abs(r(k)) > TINY, t(k) / r(k)) for k in others])
    px = df.select("*", plain.alias("_y"), ratios.alias("_x"))
    whole = F.col("_y").isNotNull() & finite(F.col("_y")) & F.forall("_x", lambda v: v.isNotNull() & finite(v))
    px = px.withColumn("_ok", F.coalesce(whole, F.lit(False)))
    z = px.where("_ok").select(scene, F.concat(F.col("_x"), F.array("_y")).alias("_z"))
    gram = partial_gram(z, [scene], "_z")
    kind = df.schema[scene].dataType.simpleString()

    def solve(batches):
        for pdf in batches:
            rows = []
            for key, count, s, g in zip(pdf[scene], pdf["n"], pdf["s"], pdf["g"]):
                p = len(s) - 1
                mean = np.asarray(s) / count
                cov = np.asarray(g).reshape(p + 1, p + 1) - count * np.outer(mean, mean)
                sd = np.sqrt(np.maximum(np.diag(cov)[:p] / count, 0.0))
                sd[sd < 1e-9] = 1.0
                w = np.linalg.solve(cov[:p, :p] / np.outer(sd, sd) + alpha * np.eye(p), cov[:p, p] / sd) / sd
                rows.append((key, int(count), w, mean[p] - mean[:p] @ w))
            yield pd.DataFrame(rows, columns=[scene, "_n", "_w", "_c"])

    fits = gram.select(scene, "n", "s", "g").mapInPandas(solve, f"`{scene}` {kind}, _n bigint, _w array<double>, _c double")
    predicted = F.aggregate(F.zip_with("_x", "_w", lambda u, v: u * v), F.lit(0.0), lambda acc, v: acc + v) + F.col("_c")
    few = F.coalesce(F.col("_n"), F.lit(0)) < MIN_RIDGE_PIXELS
    value = F.when(few, F.col("_y")).when(F.col("_ok"), F.col("_y") - predicted)
    return px.join(fits, scene, "left").select(*df.columns, F.col("_y").alias("plain"), value.alias("mbmp_plus"))


# --- matched filters ------------------------------------------------------------------------------


@dataclass(frozen=True)
class FilterConfig:
    """Settings shared by the retrievals."""

    method = "mf"
    alpha: float = ALPHA
    scaling: float = SCALING
    column_step: int = 1


@dataclass(frozen=True)
class WideWindowConfig(FilterConfig):
    """Plain filter over the wide window."""

    window: tuple[float, float] = WIDE_WINDOW_NM
    excluded: tuple[tuple[float, float], ...] = WIDE_EXCLUDED_NM


@dataclass(frozen=True)
class AlbedoConfig(FilterConfig):
    """Filter divided by the albedo of the pixel."""

    method = "rmf"


@dataclass(frozen=True)
class SparseConfig(FilterConfig):
    """Reweighted sparse iterations with the signal taken out of the background."""

    method = "mag1c"
    iterations: int = 30
    removal: float = 1.0


@dataclass(frozen=True)
class FastSparseConfig(SparseConfig):
    """The same iterations with a rank-two covariance update and an optional tolerance."""

    method = "mag1c_fast"
    tolerance: float | None = None


CONFIGS = {"mf": FilterConfig, "rmf": AlbedoConfig, "mag1c": SparseConfig, "mag1c_fast": FastSparseConfig, "wwmf": WideWindowConfig}

# Above this many pixels a column is filtered by distributed sums instead of in one task.
COLUMN_LIMIT = 100_000


def _shrink(cov: np.ndarray, alpha: float) -> np.ndarray:
    """Off-diagonal entries pulled towards zero by alpha."""
    out = (1.0 - alpha) * cov
    np.fill_diagonal(out, np.diag(cov))
    return out


def _background(cov: np.ndarray, mean: np.ndarray, moments: tuple[np.ndarray, float, float], target: np.ndarray, template: np.ndarray, alpha: float):
    """Mean, target, whitened target and its norm of the background that is left when each pixel
    loses its signal times ``target``.

    ``moments`` are the signal's mean products with the centred bands, its mean and its mean square:
    all that the change of mean and covariance depends on.
    """
    shared, level, power = moments
    swap = np.outer(shared, target)
    left = cov - swap - swap.T + (power - level * level) * np.outer(target, target)
    centre = mean - level * target
    signature = template * centre
    white = np.linalg.solve(_shrink(left, alpha), signature)
    return centre, signature, white, max(float(signature @ white), TINY)


def filter_column(x: np.ndarray, template: np.ndarray, config: FilterConfig) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Enhancement and albedo of the pixels of one detector column, iterations run, converged.

    Pass 0 is the plain filter, without signal and prior; each later pass is the same step with the
    signal that the one before it found.
    """
    n = len(x)
    mean = x.mean(axis=0)
    u = x - mean
    cov = u.T @ u / n
    albedo = np.ones(n) if config.method == "mf" else x @ mean / (mean @ mean)
    passes = getattr(config, "iterations", 0)
    tolerance = getattr(config, "tolerance", None)
    score, target = np.zeros(n), np.zeros_like(mean)
    for number in range(passes + 1):
        signal = albedo * score * getattr(config, "removal", 1.0)
        centre, target, white, norm = _background(cov, mean, (signal @ u / n, signal.mean(), signal @ signal / n), target, template, config.alpha)
        prior = 1.0 / (albedo * (score + TINY)) if number else 0.0
        found = np.maximum(((x - centre) @ white - prior) / (albedo * norm), 0.0)
        moved, score = np.linalg.norm(found - score), found
        if number and tolerance is not None and moved < tolerance * (np.linalg.norm(found) + TINY):
            return score * config.scaling, albedo, number, True
    return score * config.scaling, albedo, passes, False


def fill_nodata_column_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Invalid values replaced by the mean of their detector column and band; empty columns marked.

    ``keys`` name scene, column and band. Null marks an invalid value.
    """
    means = df.groupBy(*keys).agg(F.avg(value).alias("_m"))
    return df.join(means, list(keys)).select(
        *[c for c in df.columns if c != value], F.coalesce(value, "_m").alias(value), F.col("_m").isNull().alias("empty")
    )


RESULT = "row int, enhancement double, albedo double, iterations int, converged boolean"


def _valid_rows(x: np.ndarray) -> np.ndarray:
    return np.isfinite(x).all(axis=1) & (x > -9990.0).all(axis=1)


def _retrieve_group(template: np.ndarray, config: FilterConfig, fill: bool, keys: Sequence[str], place: Sequence[str]):
    """Group function: one detector column (or column group) of one scene."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["spectrum"].to_numpy()).astype("float64")
        ok = _valid_rows(x)
        out = pdf[list(place)].copy()
        out["enhancement"] = np.nan
        out["albedo"] = np.nan
        out["iterations"], out["converged"] = 0, False
        if not ok.any():
            return out
        if fill:
            x[~ok] = x[ok].mean(axis=0)
            score, albedo, runs, converged = filter_column(x, template, config)
            score[~ok], albedo[~ok] = np.nan, np.nan
            out["enhancement"], out["albedo"] = score, albedo
        else:
            score, albedo, runs, converged = filter_column(x[ok], template, config)
            out.loc[ok, "enhancement"], out.loc[ok, "albedo"] = score, albedo
        out["iterations"], out["converged"] = runs, converged
        return out

    return run


def _large_columns(df: DataFrame, template: np.ndarray, config: FilterConfig) -> DataFrame:
    """The same filter for columns with very many pixels, by sums added up in the tasks.

    Each round sends one p x p system per column to the solver and joins its weights back.
    """
    keys = ["scene", "col"]
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    x = df.select(*keys, "row", F.col("spectrum").cast("array<double>").alias("x"), F.col("ok"))
    base = partial_gram(x.where("ok"), keys, "x").select(*keys, F.transform("s", lambda v: v / F.col("n")).alias("m"))
    x = x.join(base, keys)
    x = x.withColumn("x", F.when(F.col("ok"), F.col("x")).otherwise(F.col("m")))
    x = x.withColumn("u", F.zip_with("x", "m", lambda a, b: a - b))
    product = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    plain = config.method == "mf"
    albedo = F.lit(1.0) if plain else product("x", "m") / product("m", "m")
    x = x.withColumn("albedo", albedo).withColumn("score", F.lit(0.0))
    passes, tolerance = getattr(config, "iterations", 0), getattr(config, "tolerance", None)
    alpha, t = config.alpha, np.asarray(template, dtype="float64")
    x = settled(x.withColumn("runs", F.lit(passes)).withColumn("done", F.lit(False)))
    base = settled(base)

    def solve(batches):
        for pdf in batches:
            rows = []
            for _, r in pdf.iterrows():
                p = len(t)
                # The signal is the last of the summed columns; the bands are centred.
                g = np.asarray(r["g"]).reshape(p + 1, p + 1) / r["n"]
                moments = g[:p, p], r["s"][p] / r["n"], g[p, p]
                rows.append((*[r[k] for k in keys], *_background(g[:p, :p], np.asarray(r["m"]), moments, np.asarray(r["target"]), t, alpha)))
            yield pd.DataFrame(rows, columns=[*keys, "mu", "next", "white", "norm"])

    schema = kinds + ", mu array<double>, next array<double>, white array<double>, norm double"
    state = base.withColumn("target", F.transform("m", lambda v: F.lit(0.0) * v))
    for number in range(passes + 1):
        signal = F.col("albedo") * F.col("score") * getattr(config, "removal", 1.0)
        gram = partial_gram(x.where("not done").select(*keys, F.concat("u", F.array(signal)).alias("z")), keys, "z")
        fits = settled(gram.join(state, keys).mapInPandas(solve, schema))
        off = product(F.zip_with("x", "mu", lambda a, b: a - b), "white")
        prior = 1.0 / (F.col("albedo") * (F.col("score") + TINY)) if number else F.lit(0.0)
        found = F.greatest((off - prior) / (F.col("albedo") * F.col("norm")), F.lit(0.0))
        # Columns that are done have no fit and keep their score.
        x = settled(
            x.join(fits, keys, "left")
            .withColumn("before", F.col("score"))
            .withColumn("score", F.when(F.col("done"), F.col("score")).otherwise(found))
            .select(*x.columns, "before")
        )
        state = fits.select(*keys, F.col("next").alias("target")).join(base, keys)
        if number and tolerance is not None:
            square = lambda c: F.sqrt(F.sum(c * c))
            still = square(F.col("score") - F.col("before")) < tolerance * (square(F.col("score")) + TINY)
            stopped = x.where("not done").groupBy(*keys).agg(still.alias("stops")).where("stops")
            x = settled(
                x.join(stopped, keys, "left")
                .withColumn("runs", F.when(F.col("stops"), number).otherwise(F.col("runs")))
                .withColumn("done", F.col("done") | F.coalesce("stops", F.lit(False)))
                .drop("stops")
            )
            if x.where("not done").isEmpty():
                break
        x = x.drop("before")
    masked = lambda c: F.when(F.col("ok"), c)
    return x.select(
        *keys,
        "row",
        masked(F.col("score") * config.scaling).alias("enhancement"),
        masked(F.col("albedo")).alias("albedo"),
        F.col("runs").alias("iterations"),
        F.col("done").alias("converged"),
    )


def retrieve_scene(
    df: DataFrame, template: Sequence[float], config: FilterConfig, limit: int = COLUMN_LIMIT
) -> DataFrame:
    """Run a retrieval over pixels (scene, row, col, spectrum), one detector column at a time.

    Pixels with fill in any band take their column's mean and come back as null. A detector column
    has as many pixels as the scene has rows; a column above the limit is filtered by distributed
    sums with the same result.
    """
    t = np.asarray(template, dtype="float64")
    keys = ["scene", "col"]
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", " + RESULT
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    big = counts.where(F.col("_n") > limit).select(*keys)
    rows = df.select(*keys, "row", F.col("spectrum"))
    place = [*keys, "row"]
    run = _retrieve_group(t, config, True, keys, place)
    if big.isEmpty():
        return rows.groupBy(*keys).applyInPandas(run, schema)
    small = rows.join(big, keys, "left_anti").groupBy(*keys).applyInPandas(run, schema)
    good = F.forall("spectrum", lambda v: v.isNotNull() & ~F.isnan(v) & (v > -9990.0))
    large = rows.join(big, keys, "left_semi").withColumn("ok", good)
    has = large.groupBy(*keys).agg(F.bool_or("ok").alias("_has")).where("_has").select(*keys)
    return small.unionByName(_large_columns(large.join(has, keys, "left_semi"), t, config)).unionByName(
        large.join(has, keys, "left_anti").select(
            *keys,
            "row",
            F.lit(None).cast("double").alias("enhancement"),
            F.lit(None).cast("double").alias("albedo"),
            F.lit(0).alias("iterations"),
            F.lit(False).alias("converged"),
        )
    )


def retrieve_column_groups(
    df: DataFrame, template: Sequence[float], config: FilterConfig, limit: int = COLUMN_LIMIT
) -> DataFrame:
    """Adjacent detector columns filtered together, valid pixels only.

    Groups above the limit are filtered by distributed sums, as in ``retrieve_scene``.
    """
    t = np.asarray(template, dtype="float64")
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in ("scene", "col")) + ", " + RESULT
    grouped = df.select("scene", "col", "row", "spectrum", F.floor(F.col("col") / config.column_step).alias("_g"))
    run = _retrieve_group(t, config, False, ["scene", "_g"], ["scene", "col", "row"])
    counts = grouped.groupBy("scene", "_g").agg(F.count(F.lit(1)).alias("_n"))
    big = counts.where(F.col("_n") > limit).select("scene", "_g")
    if big.isEmpty():
        return grouped.groupBy("scene", "_g").applyInPandas(run, schema)
    small = grouped.join(big, ["scene", "_g"], "left_anti").groupBy("scene", "_g").applyInPandas(run, schema)
    good = F.forall("spectrum", lambda v: v.isNotNull() & ~F.isnan(v) & (v > -9990.0))
    large = grouped.join(big, ["scene", "_g"], "left_semi").withColumn("ok", good)
    whole = large.where("ok").select("scene", F.col("_g").alias("col"), F.struct("row", "col").alias("row"), "spectrum", "ok")
    done = _large_columns(whole, t, config)
    done = done.select("scene", "row.col", "row.row", "enhancement", "albedo", "iterations", "converged")
    none = F.lit(None).cast("double")
    empty = large.where("not ok").select(
        "scene", "col", "row", none.alias("enhancement"), none.alias("albedo"), F.lit(0).alias("iterations"), F.lit(False).alias("converged")
    )
    return small.unionByName(done).unionByName(empty)


def wide_window_filter(
    df: DataFrame, template: Sequence[float], wavelengths: Sequence[float], config: WideWindowConfig = WideWindowConfig()
) -> DataFrame:
    """Plain filter on the bands of the wide window; bands are dropped before the spectra move."""
    keep = [
        i
        for i, w in enumerate(wavelengths)
        if config.window[0] <= w <= config.window[1] and not any(lo <= w < hi for lo, hi in config.excluded)
    ]
    narrow = df.withColumn("spectrum", take_bands(F.col("spectrum"), keep))
    return retrieve_scene(narrow, [template[i] for i in keep], config)


def column_report(df: DataFrame, n_bands: int) -> DataFrame:
    """Valid pixels per detector column, and whether it is empty or has fewer pixels than bands."""
    ok = F.forall("spectrum", lambda v: v.isNotNull() & ~F.isnan(v) & (v > -9990.0))
    g = df.groupBy("scene", "col").agg(F.count_if(ok).alias("valid"))
    return g.select("*", (F.col("valid") == 0).alias("empty"), (F.col("valid") < n_bands).alias("underdetermined"))


def retrieve(df: DataFrame, template: Sequence[float], method: str, wavelengths: Sequence[float] | None = None, **settings) -> DataFrame:
    """Retrieval by name with the settings of its configuration."""
    config = CONFIGS[method](**settings)
    if isinstance(config, WideWindowConfig):
        if wavelengths is None:
            raise ValueError("the wide window needs the wavelengths of the bands")
        return wide_window_filter(df, template, wavelengths, config)
    if config.column_step > 1:
        return retrieve_column_groups(df, template, config)
    return retrieve_scene(df, template, config)
