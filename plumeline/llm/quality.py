"""Quality by nearest neighbours among labelled latent-semantic vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.common import BAG_STEP, SMALL_STEP, STAGE_STEP, Words, by_steps, grams, labelled_sample, ragged, read_sparse, sparse_rows, spread_bag, text_column, weighted_bag

#: Buckets of hashed byte n-grams, case and signs kept, and their sizes. One more bucket counts words
#: that are the one before them; these add no n-grams.
BUCKETS, SIZES = 1 << 12, range(1, 4)
#: Latent dimensions.
DIMS = 48
#: Documents of each label that vote (about; a hash draws them), and neighbours that are asked.
PER_LABEL, NEIGHBOURS = 2000, 25
#: Rows of one block of cosine products, and the power of a cosine that weighs a vote.
BLOCK, SHARPNESS = 512, 8
#: Documents and words whose n-grams are counted at a time.
DOCS, RUN = 128, 25_000


@dataclass
class Model:
    project: np.ndarray  # (buckets + 1) x dimensions, on mean n-gram counts
    vectors: np.ndarray  # voters x dimensions, of length 1
    votes: np.ndarray


def term_grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    word, bucket = grams(words.vocabulary, SIZES, BUCKETS)
    size = pc.binary_length(words.vocabulary).to_numpy(zero_copy_only=False)
    keep = size[word] > 0
    return word[keep], bucket[keep]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(labels: np.ndarray, starts: np.ndarray, buckets: np.ndarray, weights: np.ndarray, seed: int = 0) -> Model:
    """Weigh the terms, find the leading right singular vectors of the sample, and place the voters."""
    x = np.zeros((len(labels), BUCKETS + 1), np.float32)
    x[np.repeat(np.arange(len(labels)), np.diff(starts)), buckets] = weights
    if len(labels) == 0:
        return Model(np.zeros((BUCKETS + 1, DIMS), np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0))
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1
    scale = (idf / np.sqrt(x.mean(axis=0) + 1e-5)).astype(np.float32)
    x *= scale
    basis = np.random.default_rng(seed).standard_normal((BUCKETS + 1, min(DIMS + 8, len(x)))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, turn = np.linalg.svd(x @ basis, full_matrices=False)
    project = (basis @ turn.T)[:, :DIMS]
    return Model((scale[:, None] * project).astype(np.float32), unit(x @ project).astype(np.float32), labels.astype(np.float64))


def vote(vectors: np.ndarray, model: Model, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest voters, weighted by cosine; block by block, over all voters."""
    out = np.full(len(vectors), 0.5)
    k = min(neighbours, len(model.votes))
    if k == 0:
        return out
    for a in range(0, len(vectors), BLOCK):
        near = vectors[a : a + BLOCK].astype(np.float32) @ model.vectors.T
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        out[a : a + BLOCK] = np.where(total > 0, (weight * model.votes[best]).sum(axis=1) / np.maximum(total, 1e-300), 0.5)
    return out


def place(text: pa.Array, project: np.ndarray) -> np.ndarray:
    """Latent vectors of length 1; a text without words has the zero vector.

    N-grams are counted per document and bucket, for some documents and some of their words at a
    time, so neither many small texts nor a long one need much memory.
    """
    words = Words(text)
    again = words.collapse()
    word, bucket = term_grams(words)
    order = np.argsort(word, kind="stable")
    bucket, held = bucket[order], np.bincount(word, minlength=len(words.vocabulary))
    first, cells = np.cumsum(held) - held, len(project)
    out = np.zeros((len(text), project.shape[1]), np.float32)
    for a in range(0, len(text), DOCS):
        starts = words.starts[a : a + DOCS + 1]
        n = len(starts) - 1
        counts = np.zeros(n * cells, np.float32)
        for at in range(starts[0], starts[-1], RUN):
            code = words.codes[at : min(at + RUN, starts[-1])]
            doc = np.searchsorted(starts, np.arange(at, at + len(code)), side="right") - 1
            cell = np.repeat(doc * cells, held[code]) + bucket[ragged(first[code], held[code])]
            counts += np.bincount(cell, minlength=len(counts))
        counts = counts.reshape(n, cells)
        counts[:, -1] += again[a : a + n]
        out[a : a + n] = (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)) @ project
    return unit(out)


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Voters from a bounded sample of labelled rows; the sample's n-gram bags reach the driver.

    A document with several label rows votes for each. Labels other than 0 and 1 are ignored.
    """

    def bags(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column(1))
        again = words.collapse()
        word, bucket = term_grams(words)
        doc, bucket, weight = spread_bag(words, word, bucket, np.ones(len(word), np.float32))
        rows = []
        for (b, w), r in zip(weighted_bag(doc, bucket, weight, batch.num_rows, BUCKETS), again):
            if r:
                b, w = np.append(b, np.int32(BUCKETS)), np.append(w, np.float32(r))
            rows.append((b, w / np.float32(max(w.sum(), 1))))
        return sparse_rows([batch.column(0)], ["label"], rows)

    known = labels.select(labels[key].alias("key"), labels[label].cast("int").alias("label")).where("label in (0, 1)")
    sample = labelled_sample(known, "label", "key", per_label)
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("buckets", T.BinaryType()), T.StructField("weights", T.BinaryType())])
    # The sample's expected size is fixed by per_label, so it fits in every executor.
    rows = [r for r in source.join(F.broadcast(sample), "key").select("label", "text").mapInArrow(by_steps(bags, BAG_STEP), schema).collect() if len(r["buckets"])]
    rows.sort(key=lambda r: (r["label"], bytes(r["weights"]), bytes(r["buckets"])))
    return fit(np.array([r["label"] for r in rows], int), *read_sparse(rows))


def score(docs: DataFrame, model: Model, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row, from its whole text alone.

    A null or empty text has no direction: its score is 0.5 of no vote, and so is every score where
    nothing was learned. Rows with a null or repeated key are scored like others; other columns are
    ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = vote(place(batch.column(1), model.project), model)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], [key, "score", "predicted"])

    source = docs.select(docs[key].alias(key), docs[text].alias("text"))
    schema = T.StructType([source.schema[key], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return source.mapInArrow(by_steps(run, SMALL_STEP), schema)


def score_of(text: Column, model: Model) -> Column:
    """The score of ``score`` as a column, for wide rows that stay where they are."""
    return text_column(lambda t: pa.array(vote(place(t, model.project), model)), "double", STAGE_STEP)(text)
