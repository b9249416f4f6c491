"""Order statistics as one lazy plan: exact in large groups, for any numbers, without a job of their own."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import rows_of, same_rows
from plumeline.operators import aggs, spread, stats


class Jobs:
    """How many Spark jobs ran inside the block."""

    def __init__(self, spark):
        self.tracker, self.context = spark.sparkContext.statusTracker(), spark.sparkContext

    def __enter__(self):
        self.context.setJobGroup("counted", "counted")
        return self

    def __exit__(self, *_):
        self.n = len(self.tracker.getJobIdsForGroup("counted"))
        self.context.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="module")
def points(spark):
    """Three groups of very different sizes and spreads: ties, tiny and huge numbers, both zeros, infinities, NaN, nulls."""
    rng = random.Random(12)
    odd = [0.0, -0.0, float("inf"), float("-inf"), float("nan"), None, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, float(np.nextafter(1.0, 2.0)), float(np.nextafter(1.0, 0.0))]
    rows = [("a", rng.choice(odd)) for _ in range(600)] + [("a", rng.gauss(0, 10) ** 3) for _ in range(1500)]
    rows += [("b", float(rng.randint(-5, 5))) for _ in range(900)] + [(None, rng.random()) for _ in range(400)] + [("c", 2.0)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


def test_no_job_before_the_result_is_asked_for(spark, points):
    with Jobs(spark) as jobs:
        spread.ordered_totals(points, ["g"], "v", {"n": F.count(F.lit(1))})
        spread.percentiles(points, ["g"], "v", {"p": 0.5})
        spread.average_ranks(points, ["g"], "v", "r")
        spread.row_positions(points, "v", ["g"], "i")
        spread.summary(points, ["g"], [F.count(F.lit(1)).alias("n")], "v", {"p": 0.5})
        stats.ks_two_sample(points, "v", "g")
        stats.roc_auc(points.withColumn("y", F.lit(1)), ["g"], "v", "y")
        aggs.ecdf(points, ["g"], "v")
    assert jobs.n == 0


def test_scans_of_what_ran(spark, tmp_path, points):
    """Without large groups the digits' branch, and for percentiles the count of group sizes, are gone from what is left to run."""
    points.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for found in (spread.ordered_totals(table, ["g"], "v", {"n": F.count(F.lit(1))}), spread.percentiles(table, ["g"], "v", {"p": 0.5})):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        assert plan.count("FileScan parquet") == 1 and "Union" not in plan, plan


@pytest.mark.parametrize("keys", [["g"], []])
def test_digits_order_all_numbers(points, keys):
    sums = {"n": F.count(F.lit(1)), "s": F.count("g")}
    plain = spread.ordered_totals(points, keys, "v", sums)
    cut = spread.ordered_totals(points, keys, "v", sums, limit=3)
    # Infinities as text: their difference is no number.
    a, b = (rows_of(t.withColumn("v", F.col("v").cast("string")))[1] for t in (plain, cut))
    same_rows(b, a)
    assert len(a) > 1500


def test_whole_numbers_and_times(spark):
    rows = spark.range(300).select((F.col("id") % 7 - 3).alias("i"), F.date_add(F.lit("2020-01-01"), (F.col("id") % 50).cast("int")).alias("d"))
    rows = rows.withColumn("t", F.col("d").cast("timestamp")).withColumn("b", F.col("i").cast("decimal(10,2)"))
    for c in ("i", "d", "t", "b"):
        count = {"n": F.count(F.lit(1))}
        same_rows(rows_of(spread.ordered_totals(rows, [], c, count, limit=2))[1], rows_of(spread.ordered_totals(rows, [], c, count))[1])
    with pytest.raises(TypeError):
        spread.ordered_totals(rows.withColumn("x", F.lit("x")), [], "x", {"n": F.count(F.lit(1))})


@pytest.mark.parametrize("limit", [3, spread.GROUP_LIMIT])
def test_percentiles(points, limit):
    probs = {"lo": 0.0, "a": 0.13, "m": 0.5, "hi": 1.0}
    finite = points.where("v is null or isnan(v) or abs(v) < 1e300")
    got = {r["g"]: [r[n] for n in probs] for r in spread.percentiles(finite, ["g"], "v", probs, limit).collect()}
    pdf = finite.toPandas().dropna(subset=["v"])
    want = {g: np.percentile(part["v"], [100 * p for p in probs.values()]) for g, part in pdf.groupby(pdf["g"].fillna("none"))}
    assert {g or "none" for g in got} == set(want)
    for g, values in got.items():
        assert np.allclose(values, want[g or "none"], rtol=1e-12)
    whole = spread.percentiles(finite, [], "v", probs, limit).first()
    assert np.allclose([whole[n] for n in probs], np.percentile(pdf["v"], [100 * p for p in probs.values()]), rtol=1e-12)


def test_whole_table_without_values(points):
    assert spread.percentiles(points.where("false"), [], "v", {"p": 0.5}).collect()[0]["p"] is None
    assert spread.percentiles(points.where("false"), ["g"], "v", {"p": 0.5}).count() == 0


def test_positions_in_groups(points):
    found = spread.row_positions(points.where("v is not null").withColumn("id", F.monotonically_increasing_id()), "v", ["id"], "i", limit=3, keys=["g"]).collect()
    by = {}
    for r in found:
        by.setdefault(r["g"], []).append((r["i"], r["v"]))
    for rows in by.values():
        rows.sort()
        assert [i for i, _ in rows] == list(range(len(rows)))
        values = [float("inf") if v != v else v for _, v in rows]
        assert values == sorted(values)


def test_many_groups_against_all(spark):
    """Far more groups than fit into one row."""
    rng = random.Random(4)
    rows = [(i % 700, round(rng.gauss(i % 700 / 300, 1), 1)) for i in range(7000)] + [(None, 9.0)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(6)
    got = {r["g"]: (r["ks"], r["n"]) for r in stats.ks_two_sample(df, "v", "g").collect()}
    every = np.sort([v for _, v in rows])
    assert len(got) == 701
    for g in [None, *range(0, 700, 37)]:
        own = np.sort([v for k, v in rows if k == g])
        grid = np.unique(every)
        share = lambda x: np.searchsorted(x, grid, "right") / len(x)
        assert abs(got[g][0] - np.abs(share(own) - share(every)).max()) < 1e-12 and got[g][1] == len(own)


def test_columns_with_any_name(spark):
    rows = spark.range(60).selectExpr("id % 3 as _b", "id % 7 as _i", "1 as _c", "id as _n")
    for value in ("_i", "_n", "_c"):
        cut = spread.ordered_totals(rows, ["_b"], value, {"_a": F.count(F.lit(1))}, limit=2)
        same_rows(rows_of(cut)[1], rows_of(spread.ordered_totals(rows, ["_b"], value, {"_a": F.count(F.lit(1))}))[1])
    assert spread.percentiles(rows, ["_b"], "_n", {"_a": 0.5}, limit=2).count() == 3
