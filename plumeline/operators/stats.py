"""Rank statistics, tests, classification scores and models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.functions.tails import normal_two_sided, sign_two_sided, t_two_sided
from plumeline.operators import spread


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Correlation of tie-averaged ranks."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, x, y)
    ranked = both
    for value, rank in ((x, "_rx"), (y, "_ry")):
        names = [*keys, value]
        table = spread.rank_table(both, keys, value, rank).select(*[F.col(k).alias(f"{rank}_{k}") for k in names], rank)
        ranked = ranked.join(table, spread.on_keys(names, [f"{rank}_{k}" for k in names]))
    return ranked.groupBy(*keys).agg(F.corr("_rx", "_ry").alias("rho"), F.count("_rx").alias("n"))


def pearson(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.groupBy(*keys).agg(F.corr(x, y).alias("r"), F.count(x).alias("n"))


def ks_two_sample(df: DataFrame, value: str, group: str) -> DataFrame:
    """Largest distance between the distribution of each group and that of all rows.

    The distance peaks at a value of the group or right before one, so only a group's own values are
    looked at, each beside the share of all rows before and up to it.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(group).alias("_g"), F.col(value).alias("_v"))
    count = {"n": F.count(F.lit(1))}
    every = spread.ordered_totals(rows, [], "_v", count)
    every = every.select(F.col("_v").alias("_a"), (F.col("n_before") / F.col("n_total")).alias("_before"), ((F.col("n_before") + F.col("n")) / F.col("n_total")).alias("_upto"))
    own = spread.ordered_totals(rows, ["_g"], "_v", count).join(every, F.col("_v") == F.col("_a"))
    gap = F.greatest(F.abs(F.col("n_before") / F.col("n_total") - F.col("_before")), F.abs((F.col("n_before") + F.col("n")) / F.col("n_total") - F.col("_upto")))
    return own.groupBy(F.col("_g").alias(group)).agg(F.max(gap).alias("ks"), F.max("n_total").alias("n"))


def mann_whitney(df: DataFrame, keys: Sequence[str], value: str, first: Column) -> DataFrame:
    """U of the first group, its z with tie correction and the normal p-value."""
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), first.alias("_f"))
    placed = spread.ordered_totals(rows, keys, "_v", {"n": F.count(F.lit(1)), "a": F.count_if(F.col("_f"))})
    rank = F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)
    g = placed.groupBy(*keys).agg(
        F.sum(F.col("a") * rank).alias("_r"),
        F.max("n_total").cast("double").alias("_n"),
        F.max("a_total").cast("double").alias("_a"),
        F.sum(F.pow(F.col("n"), F.lit(3.0)) - F.col("n")).alias("_t"),
    )
    c = F.col
    b = c("_n") - c("_a")
    u = c("_r") - c("_a") * (c("_a") + 1) / 2
    var = c("_a") * b / 12 * (c("_n") + 1 - c("_t") / (c("_n") * (c("_n") - 1)))
    gap = u - c("_a") * b / 2
    z = F.signum(gap) * (F.abs(gap) - 0.5) / F.sqrt(var)
    out = g.select(*keys, u.alias("u"), c("_a").cast("bigint").alias("n_first"), b.cast("bigint").alias("n_second"), z.alias("z"))
    return out.withColumn("p", normal_two_sided("z"))


def paired_t(df: DataFrame, keys: Sequence[str], a: Column, b: Column) -> DataFrame:
    """Paired mean difference, its sd, share above zero, t and two-sided p."""
    g = (
        df.withColumn("_d", a - b)
        .groupBy(*keys)
        .agg(
            F.count("_d").alias("n"),
            F.avg("_d").alias("mean_diff"),
            F.stddev_samp("_d").alias("sd_diff"),
            F.avg((F.col("_d") > 0).cast("double")).alias("share_positive"),
        )
    )
    t = F.try_divide(F.col("mean_diff"), F.col("sd_diff") / F.sqrt(F.col("n")))
    return g.withColumn("t", t).withColumn("p", t_two_sided("t", (F.col("n") - 1).cast("double")))


def sign_and_wilcoxon(df: DataFrame, keys: Sequence[str], a: Column, b: Column, min_n: int = 10) -> DataFrame:
    """Sign test (exact) and signed-rank test (normal, tie corrected) of paired values."""
    d = df.select(*keys, (a - b).alias("_d")).where("_d is not null")
    signs = d.groupBy(*keys).agg(
        F.count_if(F.col("_d") > 0).alias("above"), F.count_if(F.col("_d") < 0).alias("below"), F.count("_d").alias("n")
    )
    moved = d.where("_d <> 0").withColumn("_m", F.abs("_d"))
    placed = spread.ordered_totals(moved, keys, "_m", {"k": F.count(F.lit(1)), "pos": F.count_if(F.col("_d") > 0)})
    rank = F.col("k_before") + (F.col("k") + 1) / F.lit(2.0)
    w = placed.groupBy(*keys).agg(
        F.sum(F.col("pos") * rank).alias("w_plus"),
        F.max("k_total").cast("double").alias("_n"),
        F.sum(F.pow(F.col("k"), F.lit(3.0)) - F.col("k")).alias("_t"),
    )
    c = F.col
    mean = c("_n") * (c("_n") + 1) / 4
    var = c("_n") * (c("_n") + 1) * (2 * c("_n") + 1) / 24 - c("_t") / 48
    z = F.when(c("n") >= min_n, (c("w_plus") - mean) / F.sqrt(var))
    joined = signs.join(w, list(keys), "left") if keys else signs.withColumn("_1", F.lit(1)).join(w.withColumn("_1", F.lit(1)), "_1", "left").drop("_1")
    out = joined.select(*keys, "n", "above", "below", "w_plus", z.alias("z"))
    return out.withColumn("p_sign", sign_two_sided("above", F.col("above") + F.col("below"))).withColumn(
        "p_wilcoxon", normal_two_sided("z")
    )


def percentile_of_score(df: DataFrame, keys: Sequence[str], value: str, score: Column) -> DataFrame:
    """Percent of a group's values at or below the group's score, ties counted half."""
    return df.groupBy(*keys).agg(
        (50 * (F.avg((F.col(value) < score).cast("double")) + F.avg((F.col(value) <= score).cast("double")))).alias("percentile")
    )


def context_difference(df: DataFrame, keys: Sequence[str], plume: str, background: str) -> DataFrame:
    """Median and quartiles of plume minus background, and how often it is positive."""
    d = df.withColumn("_d", F.col(plume) - F.col(background)).where("_d is not null")
    return spread.summary(
        d,
        keys,
        [F.count("_d").alias("n"), F.avg((F.col("_d") > 0).cast("double")).alias("share_positive")],
        "_d",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
    )


def within_factor_share(df: DataFrame, keys: Sequence[str], a: str, b: str, factor: float = 2.0) -> DataFrame:
    """Median ratio of two values and the share of rows within a factor of each other."""
    r = df.where((F.col(a) > 0) & (F.col(b) > 0)).withColumn("_r", F.col(a) / F.col(b))
    inside = F.col("_r").between(1 / factor, factor).cast("double")
    return spread.summary(r, keys, [F.count("_r").alias("n"), F.avg(inside).alias("share")], "_r", {"median_ratio": 0.5})


def wind_agreement(df: DataFrame, scopes: Column, ours: str, theirs: str, tolerance: float = 1.0) -> DataFrame:
    """Median absolute difference, correlation and share within a tolerance, per scope of a row."""
    gap = F.abs(F.col(ours) - F.col(theirs))
    long = df.select(F.explode(scopes).alias("scope"), ours, theirs, gap.alias("_g")).where("_g is not null")
    return spread.summary(
        long,
        ["scope"],
        [
            F.count("_g").alias("n"),
            F.corr(ours, theirs).alias("r"),
            F.avg((F.col("_g") <= tolerance).cast("double")).alias("within"),
        ],
        "_g",
        {"median_gap": 0.5},
    )


def roc_auc(df: DataFrame, keys: Sequence[str], score: str, y: str) -> DataFrame:
    """Area under the ROC curve, ties counted half; groups with one class are left out."""
    placed = spread.ordered_totals(
        df.select(*keys, score, y), keys, score, {"pos": F.count_if(F.col(y) == 1), "neg": F.count_if(F.col(y) == 0)}
    )
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    g = placed.groupBy(*keys).agg(
        F.sum(wins).alias("_w"), F.max("pos_total").alias("n_pos"), F.max("neg_total").alias("n_neg")
    )
    return g.where("n_pos > 0 and n_neg > 0").select(
        *keys, (F.col("_w") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"), "n_pos", "n_neg"
    )


def average_precision(df: DataFrame, keys: Sequence[str], score: str, y: str) -> DataFrame:
    """Step-wise area under the precision-recall curve over distinct scores."""
    placed = spread.ordered_totals(
        df.select(*keys, score, y), keys, score, {"pos": F.count_if(F.col(y) == 1), "n": F.count(F.lit(1))}
    )
    hits = F.col("pos_total") - F.col("pos_before")
    taken = F.col("n_total") - F.col("n_before")
    step = F.col("pos") / F.col("pos_total") * hits / taken
    return placed.where("pos_total > 0").groupBy(*keys).agg(F.sum(step).alias("ap"))


def seg_metrics(df: DataFrame, keys: Sequence[str], predicted: Column, truth: Column) -> DataFrame:
    """Counts and zero-safe scores of a predicted mask."""
    g = df.groupBy(*keys).agg(
        F.count_if(predicted & truth).alias("tp"),
        F.count_if(predicted & ~truth).alias("fp"),
        F.count_if(~predicted & truth).alias("fn"),
    )
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return g.select(
        "*",
        safe(tp, tp + fp + fn).alias("iou"),
        safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe(tp, tp + fp).alias("precision"),
        safe(tp, tp + fn).alias("recall"),
    )


def subset_evaluation(df: DataFrame, subsets: Mapping[str, Column], keys: Sequence[str], score: str, y: str) -> DataFrame:
    """AUC on several overlapping subsets in one pass."""
    names = F.filter(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in subsets.items()]), lambda x: x.isNotNull()
    )
    return roc_auc(df.withColumn("subset", F.explode(names)), ["subset", *keys], score, y)


def delta_per_scene(df: DataFrame, config: str, scene: str, value: str, a: str, b: str) -> DataFrame:
    """Difference of the seed means of two configurations on the scenes both have."""
    mean = lambda c: F.avg(F.when(F.col(config) == c, F.col(value)))
    g = df.where(F.col(config).isin(a, b)).groupBy(scene).agg(mean(a).alias("_a"), mean(b).alias("_b"))
    return g.where("_a is not null and _b is not null").select(scene, (F.col("_a") - F.col("_b")).alias("delta"))


def effect_decomposition(df: DataFrame, config: str, scene: str, value: str, full: str, common: str, base: str) -> DataFrame:
    """Total effect of a configuration split into its pixel-set part and its reference part."""
    terms = {"total": (full, base), "pixels": (common, base), "references": (full, common)}
    out = None
    for term, (a, b) in terms.items():
        part = delta_per_scene(df, config, scene, value, a, b).agg(
            F.lit(term).alias("term"), F.avg("delta").alias("mean_delta"), F.count("delta").alias("scenes")
        )
        out = part if out is None else out.unionByName(part)
    return out


def reference_date_offsets(df: DataFrame, keys: Sequence[str], target_day: str, slots: Sequence[str]) -> DataFrame:
    """Median and quartiles of the days between target and reference per slot, and how many lack one."""
    items = F.array(*[F.struct(F.lit(i + 1).alias("slot"), F.col(s).alias("day")) for i, s in enumerate(slots)])
    long = df.select(*keys, target_day, F.explode(items).alias("s")).select(
        *keys, "s.slot", F.abs(F.datediff("s.day", F.col(target_day))).alias("gap")
    )
    return spread.summary(
        long,
        [*keys, "slot"],
        [F.count("gap").alias("n"), F.count_if(F.col("gap").isNull()).alias("missing")],
        "gap",
        {"q1": 0.25, "median": 0.5, "q3": 0.75},
    )


def partial_gram(df: DataFrame, keys: Sequence[str], x: str) -> DataFrame:
    """Sum and outer-product sum of a vector column per group, added up inside every task first.

    Result per group: n, s array (length p) and g array (length p*p, row major).
    """
    kind = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = (kind + ", " if kind else "") + "n bigint, s array<double>, g array<double>"

    def sums(batches):
        for pdf in batches:
            groups = pdf.groupby(list(keys), sort=False) if keys else [((), pdf)]
            rows = []
            for key, part in groups:
                m = np.stack(part[x].to_numpy()).astype("float64")
                key = key if isinstance(key, tuple) else (key,)
                rows.append((*key, len(m), m.sum(axis=0), (m.T @ m).ravel()))
            yield pd.DataFrame(rows, columns=[*keys, "n", "s", "g"])

    parts = df.select(*keys, x).mapInPandas(sums, schema)
    n = parts.groupBy(*keys).agg(F.sum("n").alias("n"))

    def added(column):
        cells = parts.select(*keys, F.posexplode(column).alias("_i", "_v")).groupBy(*keys, "_i").agg(F.sum("_v").alias("_v"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda c: c["_v"])
        return cells.groupBy(*keys).agg(ordered.alias(column))

    if keys:
        return n.join(added("s"), list(keys)).join(added("g"), list(keys))
    one = lambda t: t.withColumn("_1", F.lit(1))
    return one(n).join(one(added("s")), "_1").join(one(added("g")), "_1").drop("_1")


def dot(x: Column, weights: Sequence[float]) -> Column:
    """Dot product of an array column with fixed weights."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    return F.aggregate(F.zip_with(x, w, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, v: acc + v)


def ridge_fit(df: DataFrame, x: str, y: str, alphas: Sequence[float]) -> dict[float, np.ndarray]:
    """Weights (intercept last) of a ridge classifier with targets -1 and 1 for every alpha.

    Only the (p+1) x (p+1) normal equations reach the driver.
    """
    target = F.when(F.col(y) == 1, 1.0).otherwise(-1.0)
    z = df.select(F.concat(F.col(x).cast("array<double>"), F.array(target)).alias("_z"))
    r = partial_gram(z, [], "_z").first()
    p = len(r["s"]) - 1
    mean = np.array(r["s"]) / r["n"]
    g = np.array(r["g"]).reshape(p + 1, p + 1) - r["n"] * np.outer(mean, mean)
    out = {}
    for alpha in alphas:
        w = np.linalg.solve(g[:p, :p] + alpha * np.eye(p), g[:p, p])
        out[alpha] = np.append(w, mean[p] - mean[:p] @ w)
    return out


def ridge_classifier(
    df: DataFrame, x: str, y: str, split: str, c_grid: Sequence[float] = (0.01, 0.1, 1.0, 10.0, 100.0)
) -> DataFrame:
    """Test rows with the score of the ridge whose strength is best on the validation split."""
    fits = ridge_fit(df.where(F.col(split) == "train"), x, y, [1.0 / c for c in c_grid])
    score = lambda w: dot(F.col(x), w[:-1]) + F.lit(float(w[-1]))
    val = df.where(F.col(split) == "val")
    long = val.select(
        F.col(y).alias("_y"),
        F.explode(F.array(*[F.struct(F.lit(a).alias("alpha"), score(w).alias("score")) for a, w in fits.items()])).alias("r"),
    ).select("_y", "r.*")
    aps = {r["alpha"]: r["ap"] for r in average_precision(long, ["alpha"], "score", "_y").collect()}
    best = max(fits, key=lambda a: (aps.get(a, 0.0), a))
    return df.where(F.col(split) == "test").withColumn("score", score(fits[best])).withColumn("alpha", F.lit(best))


def boosted_trees(
    df: DataFrame, x: str, y: str, split: str, rounds: int = 300, leaves_depth: int = 5, step: float = 0.1
) -> DataFrame:
    """Gradient-boosted trees with early stop on the validation split; test rows with a score."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    ready = df.select(
        "*",
        array_to_vector(F.col(x).cast("array<double>")).alias("_x"),
        F.col(y).cast("double").alias("_y"),
        (F.col(split) == "val").alias("_val"),
    )
    model = GBTClassifier(
        featuresCol="_x",
        labelCol="_y",
        maxIter=rounds,
        maxDepth=leaves_depth,
        stepSize=step,
        maxBins=255,
        validationIndicatorCol="_val",
        seed=0,
    ).fit(ready.where(F.col(split).isin("train", "val")))
    scored = model.transform(ready.where(F.col(split) == "test"))
    return scored.select(*df.columns, vector_to_array("probability")[1].alias("score"))
