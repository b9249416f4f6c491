"""Token counts against the library on whole texts."""

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from plumeline.llm import counts, queries

HARD = [
    None, "", " ", "  ", "   ", "a", " a", "  a", "a ", "a  ", "a  b", "a   b    c", "\n", "\n a", "a\n", "a \n b", "a\n\n  b", "\t x\ty",
    "▁", "▁▁a", "a▁ b", "a ▁b", " ▁", "▁ ", "<s> x </s><unk> <0x0A> <pad>", "ＡＢ　x", "é x ́y", "日本語 テスト 🙂🙂", "\x00z \x00", "12 345 6789",
    "x" * 5000, "a1b2-c3.d(e)f", "it's x.y,z", "naïve–façade…ok", "ß×÷ĀɏƵ", "a\x00b\x01", " " * 999, "long  words " * 4000, "a\r\nb \r c", "    def f(x):\n        return x",
]


def whole(texts):
    model = SentencePieceProcessor(model_file=public_tokenizers.path(counts.MODEL))
    return [len(model.encode(t or "")) for t in texts]


def test_sums_of_pre_tokens_are_counts_of_texts():
    lists = counts.pre_tokens(pa.array(HARD))
    found = [sum(counts.piece_counts(x)) + (t or "").count("\n") for x, t in zip(lists.to_pylist(), HARD)]
    assert found == whole(HARD)
    assert counts.pre_tokens(pa.array(["", "a  b.c\n", "(é)"])).to_pylist() == [[""], ["▁a", "▁▁b", ".", "c", ""], ["▁(", "é", ")"]]


def test_packed_numbers():
    values, starts = np.array([1, 255, 256, 70000, 3]), np.array([0, 2, 2, 4, 5])
    again = counts.unpacked(counts.packed(values, starts))
    assert [x.tolist() for x in again] == [starts.tolist(), values.tolist()]


def test_hard_texts(spark):
    """Null and repeated keys, repeated rows, blocks of a few texts, and columns named like the operator's own."""
    data = [(None if i == 3 else i // 2, t, "x", i, b"w") for i, t in enumerate(HARD + HARD[-5:])]
    docs = spark.createDataFrame(data, "doc_id int, text string, key string, block int, words binary").repartition(3)
    for size in (64, counts.STEP_BYTES):
        found = counts.token_counts(docs, limit=100, bytes_=size).collect()
        want = [(d[0], len((d[1] or "").encode()), n, n > 100) for d, n in zip(data, whole([d[1] for d in data]))]
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in queries.op11(spark, "/root/testdata/sf0.001").collect()}
    counted = whole([r["text"] for r in rows])
    assert found == {r["doc_id"]: (len((r["text"] or "").encode()), n, n > 4096) for r, n in zip(rows, counted)}


def test_other_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([("a", "x y"), ("b", None)], "name string, body string")
    found = counts.token_counts(docs, key="name", text="body")
    assert found.columns == ["name", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, found.collect())) == [("a", 3, 2, False), ("b", 0, 0, False)]
    assert counts.token_counts(docs.where("false"), key="name", text="body").count() == 0
    pair = docs.select(F.struct("name").alias("name"), "body")
    assert {r["name"]["name"]: r["n_tokens"] for r in counts.token_counts(pair, key="name", text="body").collect()} == {"a": 2, "b": 0}
