"""Tokenizing word by word, packing along the curve, and grammar-compressed shards."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumeline.llm import packing, queries, repair, tokens

HARD = [
    None, "", " ", "a", " a", "a ", "a  b", "a\nb c", "a \nb", "a\n b", "a\n \nb", "x.\nY z", "it's don't we'll", "a'b .c ,d",
    "été, Ñandú! 日本語 テスト", "<|endoftext|> x", "12 345 a1b2 c_d", "\t\tx\ty", "é x ́y", "A!! B### C***.", "foo)bar ((x)) |",
    " x y", "word. 's x 's", "tail' s", "İstanbul ß", "x.\n\nY", "\n", "a\r\nb", "long " * 3000,
]


def whole(name, texts, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for x in texts]


@pytest.mark.parametrize("name,end", [(tokens.BYTE_BPE, 1), (tokens.WORD_BPE, 2)])
def test_words_give_the_ids_of_whole_texts(name, end):
    for _ in range(2):  # the second time from the remembered words
        ids, starts, _ = tokens.coder(name).encode(pa.array(HARD), end)
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == whole(name, HARD, end)


def rows(spark, texts):
    """Ids in another order, one id twice, one null, and columns whose names the operators use too."""
    data = [(None if i == 3 else i // 2 * 3 if i < 4 else i * 7, t, f"k{i}", i, b"x") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, key string, start int, ids binary").repartition(3)


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def check_packed(pieces, want, length=2048):
    """Every id in one piece, sequences without gaps, padding only where a length is no power of two."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at == length or at < length and at & (at - 1) == 0
    assert sum(p["length"] for p in pieces) == sum(len(w) for _, w in want)
    for key, ids in want:
        ps = by_doc[key, len(ids)]
        starts = {p["start"] for p in ps}
        assert 0 in starts
        for p in ps:
            part = ids[p["start"] : p["start"] + p["length"]]
            same = [w for k, w in want if k == key and len(w) == len(ids)]
            crc = p["ids_crc32"]
            assert crc in {zlib.crc32(np.array(w[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for w in same}
            assert len(part) == p["length"]


def test_packing(spark):
    df = rows(spark, HARD)
    got = queries.packed(df).collect()
    data = df.select("doc_id", "text").collect()
    check_packed(got, list(zip([r[0] for r in data], whole(tokens.BYTE_BPE, [r[1] for r in data], 1))))
    docs = documents(spark)
    data = docs.select("doc_id", "text").collect()
    got = queries.packed(docs).collect()
    check_packed(got, list(zip([r[0] for r in data], whole(tokens.BYTE_BPE, [r[1] for r in data], 1))))
    assert queries.packed(df.where("false")).count() == 0


def test_curve_neighbours():
    for bits in (1, 2, 3):
        n = 1 << bits
        points = np.array([(x, y, z) for x in range(n) for y in range(n) for z in range(n)])
        key = packing.hilbert_key(points, bits)
        assert sorted(key.tolist()) == list(range(n**3))
        assert np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1).max() == 1


def test_copies_lie_together(spark):
    df = spark.createDataFrame([(i, f"text number {i % 5} " * 40) for i in range(50)], "doc_id long, text string")
    got = packing.pack_along_curve(df).select("doc_id", "curve").collect()
    assert len({r["curve"] for r in got}) == 5


def test_grammar_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(300):
        ids = rng.integers(0, rng.integers(1, 6), rng.integers(0, 200)).astype(np.uint16)
        codes, rules = repair.compress(ids, 100, least=2)
        assert (repair.expand(codes, rules, 100) == ids).all()
        shard = repair.Shard(repair.Shard.pack(ids, np.array([len(ids)]), 100))
        assert (shard.ids() == ids).all()
        if len(ids) > 5:
            a = int(rng.integers(0, len(ids) - 2))
            n = int(rng.integers(1, len(ids) - a))
            assert (shard.ids(a, n) == ids[a : a + n]).all()


def test_grammar_compresses_repeats():
    ids = np.tile(np.arange(16, dtype=np.uint16), 500)
    codes, rules = repair.compress(ids, 100)
    assert len(codes) < len(ids) / 12 and (repair.lengths_of(rules, 100) == [len(repair.expand(np.array([100 + k], np.uint16), rules, 100)) for k in range(len(rules))]).all()


def test_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "SHARD_IDS", 500)
    df = rows(spark, HARD)
    repair.write_shards(df, str(tmp_path / "a"))
    starts = repair.shard_starts(spark, str(tmp_path / "a"))
    got = repair.read_shards(spark, str(tmp_path / "a")).join(starts, ["part", "seq"]).withColumn("start", F.col("shard_start") + F.col("place")).orderBy("start").collect()
    data = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = whole(tokens.WORD_BPE, [r[1] for r in data], 2)
    assert [r["key"] for r in got] == [r[0] for r in data]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in got] == want
    assert [r["start"] for r in got] == np.cumsum([0] + [len(w) for w in want])[:-1].tolist()
    repair.write_shards(df.where("false"), str(tmp_path / "b"))
    assert repair.read_shards(spark, str(tmp_path / "b")).count() == 0


def test_shards_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want = whole(tokens.WORD_BPE, [r["text"] for r in docs], 2)
    got = queries.QUERIES["op2_repair_shards"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    at = 0
    for d, w, g in zip(docs, want, got, strict=True):
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) == (d["doc_id"], at, len(w), zlib.crc32(np.array(w, "<u4").tobytes()))
        at += len(w)
