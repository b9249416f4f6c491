"""Each stage of the pipeline on the rows that the stage before kept."""

from collections import Counter

import corpus_pipeline as pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from plumeline.llm import mixing, quality, queries
from test_copies import components

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, 0), (None, "a b c d", "en", "z", 7), (5001, "", "en", None, 0)], docs.schema)
    docs = docs.unionByName(extra).withColumn("_copy", docs["n_chars"])
    columns = docs.columns
    names = [n for n, _ in pipeline.STAGES]
    assert len(names) == 5
    good = pipeline.written(pipeline.quality_stage(spark, docs, SMALL), "t")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where(~queries.held_out(3, 1))
    kept = {r["doc_id"] for r in quality.score(docs, quality.learn(docs, labels)).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == columns
    spoken = pipeline.written(pipeline.language_stage(spark, good, SMALL), "t")
    assert spoken.columns == columns and spoken.where("text is null or text = ''").count() == 0
    single = pipeline.written(pipeline.dedup_stage(spark, spoken, SMALL), "t")
    told = spoken.collect()
    label = components([r["text"] for r in told])
    groups = {}
    for r, group in zip(told, label):
        groups.setdefault(group, set()).add(r["doc_id"])
    first = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted(r["doc_id"] for r in single.collect() if r["doc_id"] is not None) == sorted(i for i in first if i is not None)
    assert single.count() == len(groups)
    assert single.columns == columns
    mixed = pipeline.written(pipeline.mix_stage(spark, single, SMALL), "t")
    assert mixed.columns == columns
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert times and max(times.values()) <= 2 and set(times) <= {r["doc_id"] for r in single.collect()}
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix(single).collect()}
    assert 1.3 < sum(sizes[k] * n for k, n in times.items()) / sum(sizes.values()) < 1.7
    packed = pipeline.pack_stage(spark, mixed, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == set(times)


def test_run(spark):
    assert pipeline.run(spark, SMALL).count() > 0


def test_empty(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_batches_for_python_are_small(spark, tmp_path):
    """The stages' rows go to Python in batches of a few MB, where a table's texts are many times that."""
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.range(0, 200, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40_000).alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    for name, stage in pipeline.STAGES[:2]:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
        stage(spark, docs.limit(0), str(tmp_path))
        largest = max(r["size"] for r in docs.mapInArrow(sizes, "size long").collect())
        assert 200_000 < largest < 2 * pipeline.BATCH_BYTES, name
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
