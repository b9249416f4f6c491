"""Incremental steps: ready files, deltas, first arrivals, late labels and time windows.

Every step runs with ``availableNow``: it takes what has arrived since its checkpoint and ends, so
the same job can be scheduled again. Batches are written with an id, which makes a replayed batch
overwrite itself after a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.sources.sinks import exists


def arrivals(
    spark: SparkSession, path: str, schema: T.StructType | str, glob: str = "*.parquet", per_batch: int = 8
) -> DataFrame:
    """Files not yet handled, a few per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", per_batch)
        .option("pathGlobFilter", glob)
        .parquet(path)
    )


def _batch_path(out: str, batch_id: int) -> str:
    return f"{out}/batch={batch_id}"


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Run one step over everything available."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def incremental_ready_files(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Copy newly finished items to the output in micro-batches; returns the whole output."""
    spark = stream.sparkSession

    def handle(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(_batch_path(out, batch_id))

    run_available(stream, checkpoint, handle)
    return spark.read.parquet(out)


def incremental_step(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> DataFrame:
    """Apply a batch operator to the delta only; returns the whole output."""
    spark = stream.sparkSession

    def handle(df: DataFrame, batch_id: int) -> None:
        work(df).write.mode("overwrite").parquet(_batch_path(out, batch_id))

    run_available(stream, checkpoint, handle)
    return spark.read.parquet(out)


def dedup_first_arrival(stream: DataFrame, key: str, order: Sequence[str], out: str, checkpoint: str) -> DataFrame:
    """The first record of every key across all arrivals, without a time limit."""
    spark = stream.sparkSession
    rest = [c for c in stream.columns if c != key]

    def handle(df: DataFrame, batch_id: int) -> None:
        first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")
        if batch_id and exists(spark, out):
            # A replayed batch must not see its own earlier attempt.
            seen = spark.read.parquet(out).where(F.col("batch") < batch_id).select(key)
            first = first.join(seen, key, "left_anti")
        first.write.mode("overwrite").parquet(_batch_path(out, batch_id))

    run_available(stream, checkpoint, handle)
    return spark.read.parquet(out).drop("batch")


def dedup_within(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Streaming deduplication whose state is dropped once the watermark has passed."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def late_label_expiry(
    labels: DataFrame, negatives: DataFrame, key: str, inserted: str, cutoff: Column, out: str, checkpoint: str
) -> tuple[DataFrame, DataFrame]:
    """Negatives that still hold, and the late labels that ended the others.

    Labels stream in; those after the cutoff that hit a negative go to a side table.
    """
    spark = labels.sparkSession
    held = negatives.select(key).distinct()

    def handle(df: DataFrame, batch_id: int) -> None:
        late = df.where(F.col(inserted) > cutoff).join(held, key, "left_semi")
        late.select(key, inserted).write.mode("overwrite").parquet(_batch_path(out, batch_id))

    run_available(labels, checkpoint, handle)
    late = spark.read.parquet(out).drop("batch")
    return negatives.join(late.select(key).distinct(), key, "left_anti"), late


def windowed_counts(
    stream: DataFrame, time: str, width: str, keys: Sequence[str], value: str, delay: str, slide: str | None = None
) -> DataFrame:
    """Counts and sums per tumbling or sliding window behind a watermark."""
    span = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        stream.withWatermark(time, delay)
        .groupBy(span.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")
    )


def session_counts(stream: DataFrame, time: str, gap: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Counts per session of a key, closed by a gap."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.session_window(time, gap).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
    )


def collect_complete(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run a windowed aggregate to the end of what is available and return its full result table."""
    spark = stream.sparkSession
    last: dict[str, int] = {}

    def handle(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(_batch_path(out, batch_id))
        last["id"] = batch_id

    query = (
        stream.writeStream.outputMode("complete").foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(_batch_path(out, last["id"]))
