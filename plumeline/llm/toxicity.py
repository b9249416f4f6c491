"""Toxicity: subword embeddings averaged into a linear softmax, all learned together."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.common import BAG_STEP, SMALL_STEP, Words, by_steps, grams, labelled_sample, read_sparse, sparse_rows, spread_bag, weighted_bag
from plumeline.llm.langid import SIGNS

#: Buckets of hashed byte n-grams of a word, and their sizes; embedding dimensions. A word repeated
#: at once counts once.
BUCKETS, SIZES, DIMS = 1 << 15, range(3, 7), 4
#: Documents of each label to learn from (about; a hash draws them).
PER_LABEL = 1500
#: Factor on a document's mean vector: one word among hundreds must be able to decide.
GAIN = 100.0
#: Words with the zero vector that every mean counts besides, so that a few odd words don't decide.
PAD = 16
#: Documents of the sample that an n-gram must stand in to be learned.
LEAST = 3
#: Steps of learning at least, however small the sample.
STEPS = 1200


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dimensions
    out: np.ndarray  # dimensions x labels
    bias: np.ndarray

    def lean(self) -> np.ndarray:
        """What a bucket adds to the log-odds of label 1."""
        return (self.vectors @ (self.out[:, 1] - self.out[:, 0])).astype(np.float32)


def subwords(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, bucket, weight): each word's vector is the mean of its n-grams' vectors."""
    plain = pc.utf8_lower(pc.utf8_trim(words.vocabulary, characters=SIGNS))
    word, bucket = grams(plain, SIZES, BUCKETS)
    size = pc.binary_length(plain).to_numpy(zero_copy_only=False)
    word, bucket = word[size[word] > 0], bucket[size[word] > 0]
    return word, bucket, (1 / np.maximum(np.bincount(word, minlength=len(size)), 1)[word]).astype(np.float32)


def fit(labels: np.ndarray, starts: np.ndarray, buckets: np.ndarray, weights: np.ndarray, prior: float, rounds: int = 20, batch: int = 64, rate: float = 0.05, decay: float = 1e-4, seed: int = 0) -> Model:
    """Embeddings and softmax together, by Adam on mini-batches of sparse rows.

    ``prior`` is label 1's share among all labelled rows; the sample's own share is taken out of the bias.
    """
    rng = np.random.default_rng(seed)
    model = Model((rng.standard_normal((BUCKETS, DIMS)) * 0.05).astype(np.float32), rng.standard_normal((DIMS, 2)).astype(np.float32), np.zeros(2, np.float32))
    if len(labels) == 0 or labels.min() == labels.max():
        model.out[:] = 0
        model.bias[1] = 0 if len(labels) == 0 else 10 * (2 * labels[0] - 1)
        return model
    # Buckets that few documents have teach only noise; they keep the zero vector.
    weights = np.where((np.bincount(buckets, minlength=BUCKETS) >= LEAST)[buckets], weights, 0).astype(np.float32)
    model.vectors[np.bincount(buckets, minlength=BUCKETS) < LEAST] = 0
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (model.vectors, model.out, model.bias)]
    step = 0
    rounds = max(rounds, STEPS * batch // len(labels))
    for epoch in range(rounds):
        order = rng.permutation(len(labels))
        pace = rate * (1 - epoch / rounds)
        for a in range(0, len(order), batch):
            rows = order[a : a + batch]
            size = (starts[rows + 1] - starts[rows]).astype(np.int64)
            ends = np.cumsum(size)
            at = np.repeat(starts[rows] - ends + size, size) + np.arange(ends[-1])
            b, w = buckets[at], weights[at] * np.float32(GAIN)
            row = np.repeat(np.arange(len(rows)), size)
            mean = np.stack([np.bincount(row, model.vectors[b, d] * w, len(rows)) for d in range(DIMS)], axis=1).astype(np.float32)
            z = mean @ model.out + model.bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            delta = z / z.sum(axis=1, keepdims=True)
            delta[np.arange(len(rows)), labels[rows]] -= 1
            delta /= len(rows)
            back = (delta @ model.out.T).astype(np.float32)
            grad = np.stack([np.bincount(b, back[row, d] * w, BUCKETS) for d in range(DIMS)], axis=1).astype(np.float32) + decay * model.vectors
            step += 1
            for p, g, (m, v) in zip((model.vectors, model.out, model.bias), (grad, mean.T @ delta, delta.sum(axis=0)), state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    share = labels.mean()
    model.bias[1] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return model


def score_texts(text: pa.Array, lean: np.ndarray, bias: float) -> np.ndarray:
    """Chance of label 1. Log-odds are linear in the words, so each different word is weighed once."""
    words = Words(text)
    words.collapse()
    word, bucket, weight = subwords(words)
    n = len(words.vocabulary)
    held = np.stack([np.bincount(word, lean[bucket] * weight, n), np.bincount(word, minlength=n) > 0], axis=1).astype(np.float32)
    sums = words.sums(held)
    odds = GAIN * sums[:, 0] / (sums[:, 1] + PAD) + bias
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Model from a bounded sample of labelled rows; the sample's n-gram bags reach the driver.

    A document with several label rows teaches each of them. Labels other than 0 and 1 are ignored.
    """

    def bags(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column(1))
        words.collapse()
        doc, bucket, weight = spread_bag(words, *subwords(words))
        rows = weighted_bag(doc, bucket, weight, batch.num_rows, BUCKETS)
        return sparse_rows([batch.column(0)], ["label"], [(b, w / (w.sum() + PAD)) for b, w in rows])

    known = labels.select(labels[key].alias("key"), labels[label].cast("int").alias("label")).where("label in (0, 1)")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    sample = labelled_sample(known, "label", "key", per_label)
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("buckets", T.BinaryType()), T.StructField("weights", T.BinaryType())])
    # The sample's expected size is fixed by per_label, so it fits in every executor.
    rows = source.join(F.broadcast(sample), "key").select("label", "text").mapInArrow(by_steps(bags, BAG_STEP), schema).collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["weights"]), bytes(r["buckets"])))
    prior = counts.get(1, 0) / max(sum(counts.values()), 1)
    known_labels, bag = np.array([r["label"] for r in rows], int), read_sparse(rows)
    del rows
    return fit(known_labels, *bag, prior)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row, from its whole text alone.

    An empty or null text has the bias alone. Rows with a null or repeated key are scored like
    others; other columns are ignored.
    """
    lean, bias = model.lean(), float(model.bias[1] - model.bias[0])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = score_texts(batch.column(1), lean, bias)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], [key, "score", "predicted"])

    source = docs.select(docs[key].alias(key), docs[text].alias("text"))
    schema = T.StructType([source.schema[key], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return source.mapInArrow(by_steps(run, SMALL_STEP), schema)
