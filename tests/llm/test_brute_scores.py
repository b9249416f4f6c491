"""Scores of the classifiers against plain loops: one word, one voter at a time."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plumeline.llm import quality, toxicity
from plumeline.llm.common import Words

TEXTS = [None, "", "  ", "a", "one one one two", "Some words, some WORDS again", "é ñandú 日本語", "x" * 300, "left right " * 800]


def words_of(text):
    """Words of a text, one of each run of equal ones."""
    found = pc.ascii_split_whitespace(pa.array([text or ""]))[0].as_py()
    return [w for i, w in enumerate(found) if i == 0 or w != found[i - 1]]


def test_toxicity_word_by_word():
    lean = np.random.default_rng(2).normal(size=toxicity.BUCKETS).astype(np.float32)
    found = toxicity.score_texts(pa.array(TEXTS), lean, -1.5)
    for text, score in zip(TEXTS, found):
        total, count = 0.0, 0
        for w in words_of(text):
            one = Words(pa.array([w]))
            _, bucket, weight = toxicity.subwords(one)
            total += sum(float(lean[b]) * float(x) for b, x in zip(bucket, weight))
            count += len(bucket) > 0
        odds = toxicity.GAIN * total / (count + toxicity.PAD) - 1.5
        assert math.isclose(score, 1 / (1 + math.exp(-max(-50, min(50, odds)))), rel_tol=1e-4), text


def test_quality_vote_by_full_sort():
    rng = np.random.default_rng(3)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    voters, votes = unit(rng.normal(size=(700, 12))), rng.integers(0, 2, 700).astype(float)
    model = quality.Model(np.zeros((1, 12), np.float32), voters, votes)
    asked = np.concatenate([unit(rng.normal(size=(quality.BLOCK + 40, 12))), np.zeros((1, 12), np.float32)])
    for k in (1, 7, 5000):
        found = quality.vote(asked, model, k)
        for i in (0, 1, quality.BLOCK - 1, quality.BLOCK, len(asked) - 1):
            near = sorted(((float(np.dot(asked[i].astype(float), v.astype(float))), y) for v, y in zip(voters, votes)), reverse=True)[:k]
            weight = [max(c, 0.0) ** quality.SHARPNESS for c, _ in near]
            want = sum(w * y for w, (_, y) in zip(weight, near)) / sum(weight) if sum(weight) > 0 else 0.5
            assert math.isclose(found[i], want, rel_tol=1e-3, abs_tol=1e-6), (k, i)


def test_quality_vector_word_by_word():
    rng = np.random.default_rng(4)
    project = rng.normal(size=(quality.BUCKETS + 1, 5)).astype(np.float32)
    found = quality.place(pa.array(TEXTS), project)
    for text, vector in zip(TEXTS, found):
        cells, every = np.zeros(len(project)), pc.ascii_split_whitespace(pa.array([text or ""]))[0].as_py()
        kept = words_of(text)
        for w in kept:
            one = Words(pa.array([w]))
            _, bucket = quality.term_grams(one)
            for b in bucket:
                cells[b] += 1
        cells[-1] += len(every) - len(kept)
        want = cells / max(cells.sum(), 1) @ project
        want = want / np.linalg.norm(want) if np.linalg.norm(want) > 0 else want
        assert np.allclose(vector, want, atol=2e-3), text
