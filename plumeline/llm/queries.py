"""The registered queries of the subpackage, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.llm import chat, counts, langid, merkle, mixing, packing, quality, repair, simhash, topk, toxicity, trie, versions
from plumeline.llm.common import remainder, table
from plumeline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack_along_curve(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op1_curve_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query("op2_repair_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    repair.write_shards(table(spark, sf_dir, "documents"), path)
    found = repair.read_shards(spark, path).select("part", "seq", F.col("key").alias("doc_id"), "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    starts = repair.shard_starts(spark, path)
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("shard_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def held_out(mod: int, rest: int):
    """Rows kept from learning; a null id is not held out, but has no label either."""
    return F.coalesce(remainder("doc_id", mod) == rest, F.lit(False))


@query("op3_language_families")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~held_out(5, 0)))
    return langid.identify(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


@query("op4_subword_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~held_out(4, 2)))
    return toxicity.score(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


@query("op5_exact_search", topk.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), topk.scaled(F.col("embedding")).alias("vector"))
    return topk.search(rows.where("id % 50 = 0"), rows)


@query("op6_gray_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_version_sketches")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = versions.compare_versions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op8_quota_mix", mixing.SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op9_budget_windows")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", one), (-7, 1, "assistant", one)], turns.schema)
    found = chat.read_back(chat.budgeted_windows(turns.unionByName(more)))
    return found.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


@query("op10_neighbour_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.where(~held_out(3, 1)))
    return quality.score(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


@query("op13_merkle_manifest", merkle.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claims = {"text": F.when(F.coalesce(remainder("doc_id", 3) == 0, F.lit(False)), tampered).otherwise(F.col("text"))}
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], claims=claims)
    as_hex = lambda c: F.lower(F.hex(c)).alias(c)
    return found.select(
        "doc_id", as_hex("leaf"), as_hex("subroot"), as_hex("root"), F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), as_hex("folded_root"), "verified"
    )


@query("op11_piece_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"))


@query("op12_conversation_trie", trie.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(trie.numbered(table(spark, sf_dir, "conversations"))))
