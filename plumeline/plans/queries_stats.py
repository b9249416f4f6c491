"""Statistics and model evaluation over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import stats as S
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.queries_joins import RANKED, ranked
from plumeline.plans.registry import query


@query(
    "spearman",
    """WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS rx,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)
    SELECT l_returnflag, round(corr(rx, ry), 8) AS rho, count(*) AS n FROM r GROUP BY 1""",
)
def spearman(spark, d):
    return rounded(S.spearman(fx.table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice"), 8)


@query("pearson", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 8) AS r, count(*) AS n FROM lineitem GROUP BY 1")
def pearson(spark, d):
    return rounded(S.pearson(fx.table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice"), 8)


@query(
    "ks_two_sample",
    """WITH v AS (SELECT l_extendedprice AS v, count(*) AS n, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS b, count(*) FILTER (l_returnflag = 'R') AS c FROM lineitem GROUP BY 1),
      s AS (SELECT sum(n) OVER w / sum(n) OVER () AS fn, sum(a) OVER w / sum(a) OVER () AS fa, sum(b) OVER w / sum(b) OVER () AS fb, sum(c) OVER w / sum(c) OVER () AS fc FROM v WINDOW w AS (ORDER BY v)),
      k AS (SELECT max(abs(fa - fn)) AS a, max(abs(fb - fn)) AS b, max(abs(fc - fn)) AS c FROM s)
    SELECT 'A' AS split, round(a, 8) AS ks, (SELECT sum(a) :: BIGINT FROM v) AS n FROM k UNION ALL SELECT 'N', round(b, 8), (SELECT sum(b) :: BIGINT FROM v) FROM k UNION ALL SELECT 'R', round(c, 8), (SELECT sum(c) :: BIGINT FROM v) FROM k""",
)
def ks_two_sample(spark, d):
    t = fx.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("split"), "l_extendedprice")
    return rounded(S.ks_two_sample(t, "l_extendedprice", "split"), 8)


@query(
    "mann_whitney",
    f"""WITH {fx.SCORES}, r AS (SELECT sensor, toxic, rank() OVER (PARTITION BY sensor ORDER BY size) + (count(*) OVER (PARTITION BY sensor, size) - 1) / 2.0 AS rk FROM (SELECT sensor, size, y = 1 AS toxic FROM scores))
    SELECT sensor, sum(CASE WHEN toxic THEN rk END) - count(*) FILTER (toxic) * (count(*) FILTER (toxic) + 1) / 2 AS u, count(*) FILTER (toxic) AS n_first, count(*) FILTER (NOT toxic) AS n_second FROM r GROUP BY sensor""",
)
def mann_whitney(spark, d):
    return S.mann_whitney(fx.scores(spark, d), ["sensor"], "size", F.col("y") == 1).drop("z", "p")


@query(
    "paired_t",
    """WITH v AS (SELECT l_returnflag, l_discount - l_tax AS d FROM lineitem), g AS (SELECT l_returnflag, count(d) AS n, avg(d) AS m, stddev_samp(d) AS s, avg(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS p FROM v GROUP BY 1)
    SELECT l_returnflag, n, round(m, 8) AS mean_diff, round(s, 8) AS sd_diff, round(p, 8) AS share_positive, round(m / (s / sqrt(n)), 5) AS t FROM g""",
)
def paired_t(spark, d):
    g = S.paired_t(fx.table(spark, d, "lineitem"), ["l_returnflag"], F.col("l_discount"), F.col("l_tax"))
    return rounded(g.drop("p", "t"), 8).join(g.select("l_returnflag", F.round("t", 5).alias("t")), "l_returnflag")


@query(
    "sign_and_wilcoxon",
    """WITH d AS (SELECT l_returnflag AS flag, round(l_discount * 100) - round(l_tax * 100) - 1 AS d FROM lineitem), s AS (SELECT flag, count(*) AS n, count(*) FILTER (d > 0) AS above, count(*) FILTER (d < 0) AS below FROM d GROUP BY 1),
      r AS (SELECT flag, d, rank() OVER (PARTITION BY flag ORDER BY abs(d)) + (count(*) OVER (PARTITION BY flag, abs(d)) - 1) / 2.0 AS rk FROM d WHERE d <> 0)
    SELECT flag, n, above, below, w_plus FROM s JOIN (SELECT flag, sum(CASE WHEN d > 0 THEN rk ELSE 0 END) :: DOUBLE AS w_plus FROM r GROUP BY 1) USING (flag)""",
)
def sign_and_wilcoxon(spark, d):
    t = fx.table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "flag")
    out = S.sign_and_wilcoxon(t, ["flag"], F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100) + 1)
    return out.select("flag", "n", "above", "below", "w_plus")


@query(
    "percentile_of_score",
    """SELECT l_linenumber, round(50 * (avg(CASE WHEN l_extendedprice < 50000 THEN 1 ELSE 0 END) + avg(CASE WHEN l_extendedprice <= 50000 THEN 1 ELSE 0 END)), 6) AS percentile FROM lineitem GROUP BY 1""",
)
def percentile_of_score(spark, d):
    return rounded(S.percentile_of_score(fx.table(spark, d, "lineitem"), ["l_linenumber"], "l_extendedprice", F.lit(50000.0)))


@query(
    "context_difference",
    f"""WITH {fx.PIXELS}, m AS (SELECT scene, band, avg(value) FILTER (mask = 1) AS p, avg(value) FILTER (mask = 0) AS b FROM pixels GROUP BY ALL)
    SELECT band, count(*) AS n, avg(CASE WHEN p > b THEN 1.0 :: DOUBLE ELSE 0 END) AS share_positive, round(quantile_cont(p - b, 0.25), 6) AS q1, round(quantile_cont(p - b, 0.5), 6) AS median, round(quantile_cont(p - b, 0.75), 6) AS q3 FROM m GROUP BY band""",
)
def context_difference(spark, d):
    m = fx.pixels(spark, d).groupBy("scene", "band").agg(
        F.avg(F.when(F.col("mask") == 1, F.col("value"))).alias("p"), F.avg(F.when(F.col("mask") == 0, F.col("value"))).alias("b")
    )
    return rounded(S.context_difference(m, ["band"], "p", "b"))


PAIRED_FLUX = """pf AS (SELECT l_orderkey AS scene, l_returnflag AS flag, sum(l_extendedprice) AS a, sum(l_quantity) * 1500 AS b FROM lineitem GROUP BY ALL)"""


def paired_flux(spark, d):
    return fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("scene"), F.col("l_returnflag").alias("flag")).agg(
        F.sum("l_extendedprice").alias("a"), (F.sum("l_quantity") * 1500).alias("b")
    )


@query(
    "within_factor_share",
    f"""WITH {PAIRED_FLUX} SELECT flag, count(*) AS n, round(avg(CASE WHEN a / b BETWEEN 0.5 AND 2 THEN 1 ELSE 0 END), 6) AS share, round(quantile_cont(a / b, 0.5), 6) AS median_ratio FROM pf GROUP BY flag""",
)
def within_factor_share(spark, d):
    return rounded(S.within_factor_share(paired_flux(spark, d), ["flag"], "a", "b"))


@query(
    "wind_agreement",
    """WITH e AS (SELECT event_type, value AS o, value * 0.9 + event_id % 7 / 2.0 AS t FROM events), l AS (SELECT 'all' AS scope, * FROM e UNION ALL SELECT event_type, * FROM e)
    SELECT scope, count(*) AS n, round(corr(o, t), 6) AS r, round(avg(CASE WHEN abs(o - t) <= 1 THEN 1 ELSE 0 END), 6) AS within, round(quantile_cont(abs(o - t), 0.5), 6) AS median_gap FROM l GROUP BY scope""",
)
def wind_agreement(spark, d):
    e = fx.table(spark, d, "events").select(
        "event_type", F.col("value").alias("o"), (F.col("value") * 0.9 + F.col("event_id") % 7 / F.lit(2.0)).alias("t")
    )
    return rounded(S.wind_agreement(e, F.array(F.lit("all"), F.col("event_type")), "o", "t"))


AUC = """(SELECT {g} sum(CASE WHEN y = 1 THEN rk END) AS rs, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn FROM
  (SELECT *, rank() OVER ({p} ORDER BY score) + (count(*) OVER (PARTITION BY {q} score) - 1) / 2.0 AS rk FROM {t}) {gb})"""


@query(
    "roc_auc",
    f"WITH {fx.SCORES} SELECT round((rs - np * (np + 1) / 2) / (np * nn), 8) AS auc, np AS n_pos, nn AS n_neg FROM "
    + AUC.format(g="", p="", q="", t="scores", gb=""),
)
def roc_auc(spark, d):
    return rounded(S.roc_auc(fx.scores(spark, d), [], "score", "y"), 8)


@query(
    "auc_per_scene",
    f"WITH {fx.SCORES}, a AS (SELECT site, (rs - np * (np + 1) / 2) / (np * nn) AS auc FROM "
    + AUC.format(g="site,", p="PARTITION BY site", q="site,", t="scores", gb="GROUP BY site")
    + " WHERE np > 0 AND nn > 0) SELECT round(avg(auc), 6) AS mean, round(stddev_samp(auc), 6) AS sd, count(*) AS n FROM a",
)
def auc_per_scene(spark, d):
    a = S.roc_auc(fx.scores(spark, d), ["site"], "score", "y")
    return rounded(a.agg(F.avg("auc").alias("mean"), F.stddev_samp("auc").alias("sd"), F.count("auc").alias("n")))


@query(
    "average_precision",
    f"""WITH {fx.SCORES}, c AS (SELECT sensor, score, count(*) FILTER (y = 1) AS p, count(*) AS n FROM scores GROUP BY ALL),
      w AS (SELECT sensor, p, sum(p) OVER (PARTITION BY sensor ORDER BY score DESC) AS tp, sum(n) OVER (PARTITION BY sensor ORDER BY score DESC) AS k, sum(p) OVER (PARTITION BY sensor) AS t FROM c)
    SELECT sensor, round(sum(p / t * tp / k), 8) AS ap FROM w GROUP BY sensor""",
)
def average_precision(spark, d):
    return rounded(S.average_precision(fx.scores(spark, d), ["sensor"], "score", "y"), 8)


@query(
    "seg_metrics",
    f"""WITH {fx.PIXELS}, g AS (SELECT scene, band, count(*) FILTER (value > 1.05 AND mask = 1) AS tp, count(*) FILTER (value > 1.05 AND mask = 0) AS fp, count(*) FILTER (value <= 1.05 AND mask = 1) AS fn FROM pixels GROUP BY scene, band)
    SELECT *, round(coalesce(tp / nullif(tp + fp + fn, 0), 0), 8) AS iou, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1, round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall FROM g""",
)
def seg_metrics(spark, d):
    p = fx.pixels(spark, d)
    return rounded(S.seg_metrics(p, ["scene", "band"], F.col("value") > 1.05, F.col("mask") == 1), 8)


def _split_vectors(spark, d):
    e = fx.table(spark, d, "embeddings")
    split = F.when(F.col("vec_id") % 5 < 3, "train").when(F.col("vec_id") % 5 == 3, "val").otherwise("test")
    return e.select("vec_id", F.col("embedding").alias("x"), (F.col("label") >= 7).cast("int").alias("y"), split.alias("split"))


@query("ridge_classifier")
def ridge_classifier(spark, d):
    out = S.ridge_classifier(_split_vectors(spark, d), "x", "y", "split")
    return rounded(out.select("vec_id", "y", "alpha", "score"))


@query("boosted_trees")
def boosted_trees(spark, d):
    out = S.boosted_trees(_split_vectors(spark, d), "x", "y", "split", rounds=4, leaves_depth=3)
    return out.select("vec_id", "y", "score")


@query(
    "subset_evaluation",
    f"""WITH {fx.SCORES}, s AS (SELECT 'full' AS subset, * FROM scores UNION ALL SELECT 'lt1000', * FROM scores WHERE size < 1000 UNION ALL SELECT 'lt2000', * FROM scores WHERE size < 2000)
    SELECT subset, round((rs - np * (np + 1) / 2) / (np * nn), 8) AS auc, np AS n_pos, nn AS n_neg FROM """
    + AUC.format(g="subset,", p="PARTITION BY subset", q="subset,", t="s", gb="GROUP BY subset"),
)
def subset_evaluation(spark, d):
    subsets = {"full": F.lit(True), "lt1000": F.col("size") < 1000, "lt2000": F.col("size") < 2000}
    return rounded(S.subset_evaluation(fx.scores(spark, d), subsets, [], "score", "y"), 8)


CONFIGS = """cf AS (SELECT l_suppkey AS scene, CASE l_returnflag WHEN 'A' THEN 'r4' WHEN 'R' THEN 'r0_common' ELSE 'r0' END AS config, l_discount AS auc FROM lineitem)"""


def configs(spark, d):
    name = F.when(F.col("l_returnflag") == "A", "r4").when(F.col("l_returnflag") == "R", "r0_common").otherwise("r0")
    return fx.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("scene"), name.alias("config"), F.col("l_discount").alias("auc"))


@query(
    "delta_per_scene",
    f"""WITH {CONFIGS}, m AS (SELECT scene, avg(auc) FILTER (config = 'r4') AS a, avg(auc) FILTER (config = 'r0') AS b FROM cf GROUP BY scene)
    SELECT scene, round(a - b, 8) AS delta FROM m WHERE a IS NOT NULL AND b IS NOT NULL""",
)
def delta_per_scene(spark, d):
    return rounded(S.delta_per_scene(configs(spark, d), "config", "scene", "auc", "r4", "r0"), 8)


@query(
    "effect_decomposition",
    f"""WITH {CONFIGS}, m AS (SELECT scene, avg(auc) FILTER (config = 'r4') AS a, avg(auc) FILTER (config = 'r0_common') AS c, avg(auc) FILTER (config = 'r0') AS b FROM cf GROUP BY scene)
    SELECT 'total' AS term, round(avg(a - b), 8) AS mean_delta, count(a - b) AS scenes FROM m UNION ALL SELECT 'pixels', round(avg(c - b), 8), count(c - b) FROM m UNION ALL SELECT 'references', round(avg(a - c), 8), count(a - c) FROM m""",
)
def effect_decomposition(spark, d):
    return rounded(S.effect_decomposition(configs(spark, d), "config", "scene", "auc", "r4", "r0_common", "r0"), 8)


@query(
    "reference_date_offsets",
    f"""WITH {RANKED}, w AS (SELECT c_mktsegment AS sensor, id, max(date) FILTER (rank = 1) AS t, max(date) FILTER (rank = 2) AS d1, max(date) FILTER (rank = 8) AS d2 FROM ranked JOIN customer ON id = c_custkey GROUP BY ALL),
      l AS (SELECT sensor, 1 AS slot, abs(d1 - t) AS gap FROM w UNION ALL SELECT sensor, 2, abs(d2 - t) FROM w)
    SELECT sensor, slot, count(gap) AS n, count(*) FILTER (gap IS NULL) AS missing, round(quantile_cont(gap, 0.25), 4) AS q1, round(quantile_cont(gap, 0.5), 4) AS median, round(quantile_cont(gap, 0.75), 4) AS q3 FROM l GROUP BY ALL""",
)
def reference_date_offsets(spark, d):
    r = ranked(spark, d, 8).groupBy("id").agg(
        *[F.max(F.when(F.col("rank") == k, F.col("date"))).alias(n) for k, n in ((1, "t"), (2, "d1"), (8, "d2"))]
    )
    c = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("sensor"))
    return rounded(S.reference_date_offsets(r.join(c, "id"), ["sensor"], "t", ["d1", "d2"]), 4)
