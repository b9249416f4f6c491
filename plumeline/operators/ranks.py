"""Rankings, running totals, top-k, nearest rows and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.operators import spread

# Fixed values of the simulated-plume bank.
MASS_BUDGET = 1e-3
ZERO_THRESHOLD = 1e-4


def best_per_date(df: DataFrame, site: str, day: str, score: str, coverage: str, ident: str) -> DataFrame:
    """One scene per site and date: highest score, then coverage; nulls count as zero."""
    rest = [c for c in df.columns if c not in (site, day)]
    zero = F.lit(0.0)
    rank = F.struct(F.coalesce(score, zero), F.coalesce(coverage, zero), -F.col(ident))
    best = df.groupBy(site, day).agg(F.max_by(F.struct(*rest), rank).alias("_r"))
    return best.select(site, day, "_r.*")


# Up to this rank Spark itself limits every group before the shuffle.
RANK_LIMIT = 1000
SALTS = 64


def head_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str | None = None) -> DataFrame:
    """The first n rows of each group.

    For a short list the rank limit is applied before the shuffle as well. For a long one the
    group is cut into salted shares, the first n of each share are kept, and the final rank is
    taken over those.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    if n > RANK_LIMIT:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
        shares = df.withColumn("_salt", salt)
        ws = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = shares.withColumn("_rs", F.row_number().over(ws)).where(F.col("_rs") <= n).drop("_rs", "_salt")
    top = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return top.drop("_rn") if out is None else top.withColumnRenamed("_rn", out)


def top_n_references(
    df: DataFrame,
    site: str,
    difference: str,
    cloud: str,
    methane: str,
    ident: str,
    n: int = 3,
    cloud_max: float = 0.05,
    cloud_relaxed: float = 0.35,
    methane_max: float = 0.03,
) -> DataFrame:
    """The most similar candidates: those under the strict cloud limit first, relaxed ones fill up."""
    gas_ok = F.coalesce(~(F.col(methane) > methane_max), F.lit(True))
    strict = gas_ok & F.coalesce(~(F.col(cloud) > cloud_max), F.lit(True))
    relaxed = gas_ok & F.coalesce(F.col(cloud) <= cloud_relaxed, F.lit(False))
    tiers = df.withColumn("_pass", F.when(strict, 0).when(relaxed, 1)).where("_pass is not null")
    order = [F.col("_pass"), F.col(difference).asc_nulls_last(), F.col(ident)]
    return head_per_group(tiers, [site], order, n, "rank").withColumnRenamed("_pass", "pass")


def season_order(day: Column, target_day: Column) -> list[Column]:
    """Same year first, then earlier years; within a year the latest date first."""
    return [F.year(target_day) - F.year(day), F.desc(day)]


def fill_short_list(
    df: DataFrame, target: str, target_day: str, day: str, good: Column, clear: Column, ident: str, n: int
) -> DataFrame:
    """Passing scenes in season order, topped up by the clearest others on unused dates."""
    rest = [c for c in df.columns if c not in (target, target_day, day)]
    # One scene per date: a passing one beats any other, then the clearest.
    per_date = (
        df.withColumn("_good", good)
        .withColumn("_clear", clear)
        .groupBy(target, target_day, day)
        .agg(
            F.max_by(
                F.struct("_good", "_clear", *rest), F.struct(F.col("_good"), F.col("_clear"), -F.col(ident))
            ).alias("_r")
        )
        .select(target, target_day, day, "_r.*")
    )
    season = season_order(F.col(day), F.col(target_day))
    first_pick = [F.desc("_good"), F.when(F.col("_good"), season[0]), F.when(~F.col("_good"), -F.col("_clear"))]
    chosen = head_per_group(per_date, [target], [*first_pick, F.desc(day), F.col(ident)], n)
    w = Window.partitionBy(target).orderBy(*season, F.col(ident))
    return chosen.withColumn("slot", F.row_number().over(w)).withColumnRenamed("_good", "passed").drop("_clear")


def zscore_per_sample(df: DataFrame, keys: Sequence[str], value: str, mask: Column, out: str) -> DataFrame:
    """Z-score of every row with the mean and population sd of the masked rows of its group."""
    clean = F.when(finite(F.col(value)), F.col(value)).otherwise(F.lit(0.0))
    stats = df.groupBy(*keys).agg(
        F.avg(F.when(mask, clean)).alias("_m"), F.stddev_pop(F.when(mask, clean)).alias("_s")
    )
    sd = F.when(F.col("_s") < 1e-12, F.lit(1.0)).otherwise(F.col("_s"))
    return df.join(stats, list(keys)).withColumn(out, (clean - F.col("_m")) / sd).drop("_m", "_s")


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def visible_ratio_norm(df: DataFrame, sample: str, value: str, visible: Column, out: str) -> DataFrame:
    """Divide by the sample's mean over its visible bands."""
    means = df.where(visible).groupBy(sample).agg(F.avg(value).alias("_m"))
    return df.join(means, sample, "left").withColumn(out, F.try_divide(F.col(value), F.col("_m"))).drop("_m")


def mass_budget_threshold(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    budget: float = MASS_BUDGET,
    cap: float = ZERO_THRESHOLD,
) -> DataFrame:
    """Highest threshold below which at most ``budget`` of the positive mass lies, capped."""
    placed = spread.ordered_totals(df.where(F.col(value) > 0), keys, value, {"mass": F.sum(value)})
    over = F.col("mass_before") + F.col("mass") > budget * F.col("mass_total")
    return placed.groupBy(*keys).agg(
        F.least(cap * F.max(value), F.coalesce(F.min(F.when(over, F.col(value))), F.max(value))).alias("threshold")
    )


def edge_slope(df: DataFrame, keys: Sequence[str], position: str, value: str, lo: int, hi: int) -> DataFrame:
    """Least-squares slope of the log of a profile over a range of columns."""
    log = F.ln(F.greatest(F.col(value), F.lit(1e-3)))
    return df.where(F.col(position).between(lo, hi)).groupBy(*keys).agg(F.regr_slope(log, F.col(position)).alias("slope"))


def strictly_increasing(heights: Column) -> Column:
    pairs = F.arrays_zip(F.slice(heights, 1, F.size(heights) - 1).alias("a"), F.slice(heights, 2, F.size(heights) - 1).alias("b"))
    return F.forall(pairs, lambda p: p["a"] < p["b"])


def midpoints(heights: Column) -> Column:
    """Mid-level heights from the heights of the level faces."""
    return F.zip_with(
        F.slice(heights, 1, F.size(heights) - 1), F.slice(heights, 2, F.size(heights) - 1), lambda a, b: (a + b) * 0.5
    )


def patience_early_stop(
    df: DataFrame, keys: Sequence[str], step: str, score: str, patience: int, min_delta: float, max_step: int
) -> DataFrame:
    """Best checkpoint of a run, stopping after ``patience`` checks without a gain.

    A run has at most ``max_step`` checkpoints, so its sequence is a short array.
    """
    seq = F.array_sort(F.collect_list(F.struct(F.col(step).alias("it"), F.col(score).alias("sc"))))
    start = F.struct(
        F.lit(float("-inf")).alias("best"),
        F.lit(None).cast("bigint").alias("stage"),
        F.lit(0).alias("idle"),
        F.lit(None).cast("bigint").alias("last"),
    )

    def fold(s, x):
        gain = x["sc"] > s["best"] + min_delta
        go = s["idle"] < patience
        return F.when(~go, s).otherwise(
            F.struct(
                F.when(gain, x["sc"]).otherwise(s["best"]).alias("best"),
                F.when(gain, x["it"].cast("bigint")).otherwise(s["stage"]).alias("stage"),
                F.when(gain, F.lit(0)).otherwise(s["idle"] + 1).alias("idle"),
                x["it"].cast("bigint").alias("last"),
            )
        )

    runs = df.where(F.col(step) <= max_step).groupBy(*keys).agg(F.aggregate(seq, start, fold).alias("_s"))
    return runs.select(
        *keys, F.col("_s.best").alias("best"), F.coalesce("_s.stage", "_s.last").alias("stage"), F.col("_s.last").alias("last")
    )


def choose_spaced_trio(
    df: DataFrame, keys: Sequence[str], snap: str, targets: tuple[float, float, float], gap: int
) -> DataFrame:
    """Up to three snapshots per run at least ``gap`` apart and nearest to three targets.

    The best left and right partner of each middle snapshot come from running minima, so no pairs
    are formed. Without a trio the best pair is taken, without a pair the one nearest the middle.
    """
    t0, t1, t2 = targets
    s = F.col(snap)
    snaps = df.select(*keys, s.cast("int").alias("_b")).distinct()
    left = Window.partitionBy(*keys).orderBy("_b").rangeBetween(Window.unboundedPreceding, -gap)
    right = Window.partitionBy(*keys).orderBy("_neg").rangeBetween(Window.unboundedPreceding, -gap)
    b = F.col("_b")
    near = lambda t: F.struct(F.abs(b - t).alias("c"), b.alias("s"))
    marked = snaps.withColumn("_neg", -b).select(
        *keys,
        "_b",
        F.min(near(t0)).over(left).alias("_l"),
        F.min(near(t2)).over(right).alias("_r"),
    )
    trio = F.when(
        F.col("_l").isNotNull() & F.col("_r").isNotNull(),
        F.struct(
            (F.col("_l.c") + F.abs(b - t1) + F.col("_r.c")).alias("c"),
            F.array("_l.s", "_b", "_r.s").alias("s"),
        ),
    )
    pair = F.when(
        F.col("_l").isNotNull(),
        F.struct((F.col("_l.c") + F.abs(b - t2)).alias("c"), F.array("_l.s", "_b").alias("s")),
    )
    single = F.struct(F.abs(b - t1).alias("c"), F.array("_b").alias("s"))
    best = marked.groupBy(*keys).agg(F.coalesce(F.min(trio)["s"], F.min(pair)["s"], F.min(single)["s"]).alias("_s"))
    return best.select(*keys, F.explode("_s").alias(snap))


def argmax_row(df: DataFrame, value: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(value), tie).limit(1)


def nearest_row(df: DataFrame, value: str, target: float, tie: str) -> DataFrame:
    """The row whose value lies nearest to a target."""
    row = F.min_by(F.struct(*df.columns), F.struct(F.abs(F.col(value) - target), F.col(tie)))
    return df.agg(row.alias("_r")).select("_r.*")


def topk_union(a: DataFrame, b: DataFrame, ident: str, score: str, k: int) -> DataFrame:
    """Union of the k best of two tables, with which of them each came from."""
    best = lambda df, side: (
        df.orderBy(F.desc(score), ident).limit(k).select(ident, F.lit(True).alias(side))
    )
    both = best(a, "in_a").join(best(b, "in_b"), ident, "full")
    return both.select(ident, F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b"))


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many keys are in both tables, only left, only right."""
    sides = a.select(key, F.lit(1).alias("s")).unionByName(b.select(key, F.lit(2).alias("s")))
    codes = sides.groupBy(key).agg(F.bit_or("s").alias("c"))
    return codes.agg(
        F.count_if(F.col("c") == 3).alias("both"),
        F.count_if(F.col("c") == 1).alias("only_a"),
        F.count_if(F.col("c") == 2).alias("only_b"),
    )


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).unionByName(b.subtract(a))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merge_window_lists(a: Column, b: Column) -> Column:
    """Two window lists without duplicates, in first-seen order."""
    return F.array_distinct(F.concat(a, b))


def seen_flag(df: DataFrame, train: DataFrame, site: str) -> DataFrame:
    """Mark rows whose site occurs in the training table."""
    seen = train.select(site).distinct().withColumn("seen", F.lit(True))
    return df.join(seen, site, "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
