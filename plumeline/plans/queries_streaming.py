"""Incremental steps and user functions over the driver tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from plumeline.functions import udfs as U
from plumeline.operators import spectral as S
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.queries_spectral import TEMPLATE, WAVELENGTHS, cube
from plumeline.plans.registry import query
from plumeline.session import scratch_path
from plumeline.streaming import ingest as I

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark, d):
    s = I.arrivals(spark, d, EVENTS, glob="events.parquet")
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _paths(spark, name):
    return scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state")


@query("incremental_ready_files", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def incremental_ready_files(spark, d):
    """Events first land as several files, then are picked up eight files at a time."""
    landing = scratch_path(spark, "landing")
    fx.table(spark, d, "events").repartition(20, "event_id").write.parquet(landing)
    out, state = _paths(spark, "ready")
    done = I.incremental_ready_files(I.arrivals(spark, landing, EVENTS, glob="*.parquet", per_batch=8), out, state)
    return done.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("incremental_step", "SELECT user_id, count(*) AS n, max(value) AS top FROM events GROUP BY 1")
def incremental_step(spark, d):
    """The step runs on two deltas; its output covers both."""
    landing = scratch_path(spark, "landing")
    out, state = _paths(spark, "step")
    e = fx.table(spark, d, "events")
    work = lambda t: t.groupBy("user_id").agg(F.count("*").alias("n"), F.max("value").alias("top"))
    for part in (e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")):
        part.write.mode("append").parquet(landing)
        done = I.incremental_step(I.arrivals(spark, landing, EVENTS, glob="*.parquet", per_batch=1000), work, out, state)
    return done.groupBy("user_id").agg(F.sum("n").alias("n"), F.max("top").alias("top"))


@query("dedup_first_arrival", "SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def dedup_first_arrival(spark, d):
    out, state = _paths(spark, "dedup")
    s = event_stream(spark, d).select("user_id", "event_id", "value", "ts")
    return I.dedup_first_arrival(s, "user_id", ["ts", "event_id"], out, state).drop("ts")


@query(
    "late_label_expiry",
    """SELECT c_custkey AS granule FROM customer WHERE c_acctbal < 3000 AND c_custkey NOT IN (SELECT user_id FROM events WHERE ts > TIMESTAMP '2024-01-25')""",
)
def late_label_expiry(spark, d):
    out, state = _paths(spark, "labels")
    labels = event_stream(spark, d).select(F.col("user_id").alias("granule"), "ts")
    free = fx.table(spark, d, "customer").where("c_acctbal < 3000").select(F.col("c_custkey").alias("granule"))
    kept, _ = I.late_label_expiry(labels, free, "granule", "ts", F.lit("2024-01-25").cast("timestamp"), out, state)
    return kept


@query(
    "tumbling_windows",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""",
)
def tumbling_windows(spark, d):
    out, state = _paths(spark, "tumbling")
    w = I.windowed_counts(event_stream(spark, d), "ts", "1 day", ["event_type"], "value", "2 hours")
    t = I.collect_complete(w, out, state)
    return t.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    "sliding_windows",
    """WITH s AS (SELECT date_trunc('hour', ts) - to_hours(CAST(i * 6 AS INTEGER)) - to_hours(CAST(hour(ts) % 6 AS INTEGER)) AS start, * FROM events, range(0, 2) t(i)) SELECT start, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY ALL""",
)
def sliding_windows(spark, d):
    out, state = _paths(spark, "sliding")
    w = I.windowed_counts(event_stream(spark, d), "ts", "12 hours", [], "value", "2 hours", slide="6 hours")
    t = I.collect_complete(w, out, state)
    return t.select(F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"))


@query(
    "session_windows",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
    SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""",
)
def session_windows(spark, d):
    out, state = _paths(spark, "session")
    t = I.collect_complete(I.session_counts(event_stream(spark, d), "ts", "6 hours", ["user_id"], "2 hours"), out, state)
    return t.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("user_defined_scalar", "SELECT p_partkey, round(CASE WHEN p_size > 25 THEN sqrt(p_retailprice) ELSE p_retailprice / 10 END, 8) AS value FROM part")
def user_defined_scalar(spark, d):
    def shape(size: pd.Series, price: pd.Series) -> pd.Series:
        return pd.Series(np.where(size > 25, np.sqrt(price), price / 10))

    return fx.table(spark, d, "part").select("p_partkey", F.round(U.scalar(shape, "double")("p_size", "p_retailprice"), 8).alias("value"))


@query("user_defined_aggregate", "SELECT l_returnflag, max(l_extendedprice) - min(l_extendedprice) AS span FROM lineitem GROUP BY 1")
def user_defined_aggregate(spark, d):
    t = fx.table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", "l_orderkey")
    top = U.aggregate_by_parts(t, ["l_returnflag"], "l_extendedprice", lambda s: s.max(), F.max("_p"), out="hi")
    low = U.aggregate_by_parts(t, ["l_returnflag"], "l_extendedprice", lambda s: s.min(), F.min("_p"), out="lo")
    return top.join(low, "l_returnflag").select("l_returnflag", (F.col("hi") - F.col("lo")).alias("span"))


@query(
    "user_defined_grouped_map",
    """SELECT l_suppkey, l_linenumber, count(*) AS n, round(max(l_extendedprice) / sum(l_extendedprice), 8) AS top_share FROM lineitem GROUP BY ALL""",
)
def user_defined_grouped_map(spark, d):
    def share(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["l_extendedprice"].to_numpy()
        v = v[~np.isnan(v)]
        top = round(v.max() / v.sum(), 8) if v.sum() else np.nan
        return pd.DataFrame({**{k: pdf[k].to_numpy()[:1] for k in keys}, "n": len(pdf), "top_share": top})

    keys = ["l_suppkey", "l_linenumber"]
    t = fx.table(spark, d, "lineitem").select(*keys, "l_extendedprice")
    return U.grouped_map(t, keys, share, "l_suppkey bigint, l_linenumber int, n bigint, top_share double")


@query(
    "user_defined_table_function",
    """WITH s AS (SELECT s_suppkey AS scene, 10 + s_suppkey % 7 AS h, 9 + s_suppkey % 5 AS w FROM supplier) SELECT scene, CAST(i * 4 AS INT) AS row_off, CAST(j * 4 AS INT) AS col_off FROM s, range(0, 10) a(i), range(0, 10) b(j) WHERE i * 4 + 4 <= h AND j * 4 + 4 <= w""",
)
def user_defined_table_function(spark, d):
    U.register_table_functions(spark)
    k = F.col("s_suppkey")
    fx.table(spark, d, "supplier").select(
        k.alias("scene"), (10 + k % 7).cast("int").alias("h"), (9 + k % 5).cast("int").alias("w")
    ).createOrReplaceTempView("sized_scenes")
    return spark.sql("SELECT scene, t.row_off, t.col_off FROM sized_scenes, LATERAL tile_windows(h, w, 4) t")


@query("pluggable_methods")
def pluggable_methods(spark, d):
    """Every retrieval by name over the same cube; how many pixels each marks."""
    c = cube(spark, d)
    out = None
    for name in S.CONFIGS:
        part = S.retrieve(c, TEMPLATE, name, WAVELENGTHS, alpha=0.05).groupBy("scene").agg(
            F.lit(name).alias("method"), F.count("enhancement").alias("valid"), F.avg("albedo").alias("albedo")
        )
        out = part if out is None else out.unionByName(part)
    return rounded(out)
