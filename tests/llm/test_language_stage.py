"""The language stage drops only what op3 gives no language."""

from zlib import crc32

import corpus_pipeline as pipeline
from plumeline.llm import langid, queries

SMALL = "/root/testdata/sf0.001"


def test_unsure_documents_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    by_language = {}
    for r in docs.where("n_chars > 400").orderBy("doc_id").collect():
        by_language.setdefault(r["lang"], []).append(r["text"].split())
    # One or two words of each language in turn: short texts whose languages compete.
    # Their ids are held out, so that the stage does not learn from them.
    held = [i for i in range(9000, 20000) if crc32(str(i).encode()) % 5 == 0]
    mixed = []
    for i in range(400):
        words = []
        for k, texts in enumerate(by_language.values()):
            text = texts[i % len(texts)]
            at = (i * 13 + k * 5) % (len(text) - 2)
            words += text[at : at + 1 + i % 2]
        mixed.append((held[i], " ".join(words), "en", "z", 0))
    none = set(held[400:402])
    extra = spark.createDataFrame(mixed + [(held[400], "12 34 56", "en", "z", 8), (held[401], None, None, "z", 0)], docs.schema)
    more = docs.unionByName(extra)
    model = langid.learn(more.where(~queries.held_out(5, 0)))
    found = langid.language_of(more["text"], model)
    named = more.select("doc_id", found["lang_pred"].alias("lang_pred"), found["score"].alias("score")).collect()
    scores = sorted(r["score"] for r in named if r["lang_pred"] != langid.UNKNOWN)
    assert scores[0] < 0.3, scores[:5]
    kept = {r["doc_id"] for r in pipeline.language_stage(spark, more, SMALL).collect()}
    assert kept == {r["doc_id"] for r in named if r["lang_pred"] != langid.UNKNOWN}
    assert not kept & none
