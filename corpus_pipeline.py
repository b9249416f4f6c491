"""The corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator of ``plumeline.llm`` on all rows that the stage before kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.llm import copies, langid, mixing, quality, queries
from plumeline.llm.common import Bloom, table, written

#: Rows that go to a Python worker at a time, in bytes; Spark's own limit is 64 MB, held on both sides of the pipe.
BATCH_BYTES = 4_000_000


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with batches of about ``BATCH_BYTES`` for the session from then on: its rows are computed later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
        return stage(spark, docs, sf_dir)

    return run


def whole_row(docs: DataFrame) -> Column:
    """A document's columns in one, to travel through an operator as its key."""
    return F.struct(*[docs[c] for c in docs.columns])


def row_key(docs: DataFrame) -> Column:
    """The id, and a hash of the whole row that tells rows with equal or null ids apart."""
    return F.struct(docs["doc_id"].isNull().alias("none"), docs["doc_id"].alias("id"), F.xxhash64(*[docs[c] for c in docs.columns]).alias("row"))


@in_small_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the neighbour vote predicts as good. Without text there is no vote: it stays."""
    labels = table(spark, sf_dir, "labels").where(~queries.held_out(3, 1))
    model = quality.learn(docs, labels)
    return docs.where(quality.score_of(docs["text"], model) >= 0.5)


@in_small_batches
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letter, or a null text. An unsure prediction stays."""
    model = langid.learn(docs.where(~queries.held_out(5, 0)))
    found = langid.language_of(docs["text"], model)
    return docs.where(found["lang_pred"] != langid.UNKNOWN)


@in_small_batches
def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays (null ids last), of repeated rows one.

    Near copies have 0.8 or more of their five-word shingles in common. SimHash fingerprints in the
    Gray-ordered index name candidates, bands of minima those that the few bits miss, and exact sets decide.
    """
    keyed = docs.select(whole_row(docs).alias("row"), row_key(docs).alias("key"), docs["text"])
    found = written(copies.near_copies(keyed, key="key"), "components")
    lost = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("first")).where("n > 1 or key <> first")
    lost = written(lost.select("key", "first"), "lost")
    # Rows that cannot be among the lost ones stay where they are; only the others are looked up.
    keyed = keyed.withColumn("maybe", Bloom(lost.select(F.xxhash64("key"))).may(F.xxhash64("key")))
    again = keyed.where("maybe").join(lost.where("key <> first"), "key", "left_anti").dropDuplicates(["key"])
    return keyed.where("not maybe").select("row.*").unionByName(again.select("row.*"))


@in_small_batches
def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop whole documents, as often as the mix takes their words, rounded."""
    keyed = docs.select(whole_row(docs).alias("row"), row_key(docs).alias("key"), docs["text"], docs["source"])
    taken = mixing.mix(keyed, key="key").where("size > 0")
    times = taken.select("key", F.round(F.col("taken") / F.col("size")).cast("int").alias("times")).where("times > 0").dropDuplicates(["key"])
    again = F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")
    return keyed.select("row", "key").join(times, "key").select("row", again).select("row.*")


@in_small_batches
def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens along the curve."""
    return queries.packed(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", dedup_stage),
    ("mixing sources to target weights", mix_stage),
    ("packing", pack_stage),
]

#: The classifiers and the packing are beyond SQL; tests hold the stages against direct computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
