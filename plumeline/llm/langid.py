"""Language identification in two levels: the family first, then the language within it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from plumeline.llm.common import BAG_STEP, SMALL_STEP, STAGE_STEP, Words, by_steps, grams, labelled_sample, read_sparse, sparse_rows, spread_bag, text_column, weighted_bag

#: Buckets of hashed byte n-grams, and their sizes.
BUCKETS, SIZES = 1 << 13, range(1, 5)
#: Documents of each language to learn from (about; a hash draws them).
PER_LANGUAGE = 300
UNKNOWN = "und"
SIGNS = ".,!?:;#$%&*|()[]{}<>\"'`-_/\\@+=~^"


@dataclass
class Model:
    """Languages in families; a column of weights per decision, on mean n-gram counts."""

    families: list[list[str]]
    pairs: list[tuple[int, int, int]]  # family, and the two languages' places in it
    weights: np.ndarray  # buckets x (families + pairs)
    bias: np.ndarray


def letter_grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the different words that hold a letter."""
    plain = pc.utf8_lower(pc.utf8_trim(words.vocabulary, characters=SIGNS))
    word, bucket = grams(plain, SIZES, BUCKETS)
    keep = pc.match_substring_regex(plain, r"\pL").to_numpy(zero_copy_only=False)[word]
    return word[keep], bucket[keep]


def separate(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30, seed: int = 0) -> np.ndarray:
    """Linear support vector machine (hinge loss) by dual coordinate ascent; y is +1 or -1.

    The last weight is the bias. Both sides get the same total cost.
    """
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    upper = cost * np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    norm, alpha, w = (x**2).sum(axis=1), np.zeros(len(x)), np.zeros(x.shape[1], x.dtype)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(x)):
            gap = y[i] * float(w @ x[i]) - 1
            new = min(max(alpha[i] - gap / norm[i], 0.0), upper[i])
            if new != alpha[i]:
                moved = max(moved, abs(new - alpha[i]))
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def group_families(centres: np.ndarray, count: int) -> list[list[int]]:
    """Closest languages together: average-linkage clustering of their mean vectors by cosine."""
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    near = unit @ unit.T
    groups = [[i] for i in range(len(centres))]
    while len(groups) > count:
        _, a, b = max((near[np.ix_(groups[a], groups[b])].mean(), -a, -b) for a in range(len(groups)) for b in range(a + 1, len(groups)))
        groups[-a] = sorted(groups[-a] + groups[-b])
        del groups[-b]
    return groups


def fit(languages: list[str], starts: np.ndarray, buckets: np.ndarray, weights: np.ndarray) -> Model:
    """Learn from sparse rows of mean n-gram counts and each row's language."""
    x = np.zeros((len(languages), BUCKETS), np.float32)
    x[np.repeat(np.arange(len(languages)), np.diff(starts)), buckets] = weights
    scale = (1 / np.sqrt(x.mean(axis=0) + 1e-5)).astype(np.float32)
    x *= scale
    names = sorted(set(languages))
    of = np.array([names.index(v) for v in languages], int)
    centres = np.stack([x[of == i].mean(axis=0) for i in range(len(names))]) if names else np.zeros((0, BUCKETS))
    families = group_families(centres - centres.mean(axis=0), int(np.ceil(np.sqrt(len(names))))) if names else []
    found, pairs = [], []
    for group in families:
        inside = np.isin(of, group)
        found.append(separate(x, np.where(inside, 1.0, -1.0)) if len(families) > 1 else np.append(np.zeros(BUCKETS, np.float32), np.float32(1)))
    for f, group in enumerate(families):
        for i in range(len(group)):
            for j in range(i + 1, len(group)):
                rows = (of == group[i]) | (of == group[j])
                found.append(separate(x[rows], np.where(of[rows] == group[i], 1.0, -1.0)))
                pairs.append((f, i, j))
    matrix = np.stack(found, axis=1) if found else np.zeros((BUCKETS + 1, 0), np.float32)
    return Model([[names[i] for i in g] for g in families], pairs, matrix[:-1] * scale[:, None], matrix[-1])


def decide(margins: np.ndarray, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each row: the best family, then most pairwise votes within it.

    Votes are logistic in the margin; ties go to the language that sorts first.
    """
    soft = lambda m: 1 / (1 + np.exp(-2 * np.clip(m, -30, 30)))
    n, f = len(margins), len(model.families)
    chance = soft(margins[:, :f])
    family = chance.argmax(axis=1)
    chance = chance[np.arange(n), family]
    names, score = np.empty(n, object), np.zeros(n)
    for k, group in enumerate(model.families):
        rows = np.flatnonzero(family == k)
        votes = np.zeros((len(rows), len(group)))
        for p, (of, i, j) in enumerate(model.pairs):
            if of == k:
                share = soft(margins[rows, f + p])
                votes[:, i] += share
                votes[:, j] += 1 - share
        best = votes.argmax(axis=1)
        names[rows] = np.array(group, object)[best]
        score[rows] = chance[rows] * (votes[np.arange(len(rows)), best] / max(len(group) - 1, 1) if len(group) > 1 else 1)
    return names.tolist(), score


def score_texts(text: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    words = Words(text)
    word, bucket = letter_grams(words)
    n, m = len(words.vocabulary), model.weights.shape[1]
    held = np.empty((n, m + 1), np.float32)
    held[:, m] = np.bincount(word, minlength=n)
    for k in range(m):
        held[:, k] = np.bincount(word, model.weights[:, k][bucket], n)
    sums = words.sums(held)
    total = sums[:, m]
    margins = sums[:, :m] / np.maximum(total, 1)[:, None] + model.bias
    if not model.families:
        return [UNKNOWN] * len(total), np.zeros(len(total))
    names, score = decide(margins, model)
    letters = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
    return [v if ok else UNKNOWN for v, ok in zip(names, letters)], np.where(letters, score, 0.0)


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Model from a bounded sample of the rows with a language; the sample's n-gram counts reach the driver.

    Rows with a null text or none of whose words has a letter teach nothing.
    """

    def bags(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column(2))
        word, bucket = letter_grams(words)
        doc, bucket, weight = spread_bag(words, word, bucket, np.ones(len(word), np.float32))
        rows = weighted_bag(doc, bucket, weight, batch.num_rows, BUCKETS)
        return sparse_rows([batch.column(1)], ["lang"], [(b, w / max(w.sum(), 1)) for b, w in rows])

    source = docs.select(docs[key].alias("key"), docs[lang].alias("lang"), docs[text].alias("text"))
    sample = labelled_sample(source.where("text is not null"), "lang", "key", per_language)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("buckets", T.BinaryType()), T.StructField("weights", T.BinaryType())])
    rows = [r for r in sample.select("key", "lang", "text").mapInArrow(by_steps(bags, BAG_STEP), schema).collect() if len(r["buckets"])]
    rows.sort(key=lambda r: (r["lang"], bytes(r["weights"])))
    return fit([r["lang"] for r in rows], *read_sparse(rows))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row, from its whole text alone.

    A text that is null or has no letter is ``und`` with score 0, and so is every text when nothing
    was learned. Rows with a null or repeated key are scored like others; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = score_texts(batch.column(1), model)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], [key, "lang_pred", "score"])

    source = docs.select(docs[key].alias(key), docs[text].alias("text"))
    schema = T.StructType([source.schema[key], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(by_steps(run, SMALL_STEP), schema)


def language_of(text: Column, model: Model) -> Column:
    """What ``identify`` finds as a struct column (lang_pred, score), for wide rows that stay where they are."""

    def run(t: pa.Array) -> pa.Array:
        names, score = score_texts(t, model)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return text_column(run, "lang_pred string, score double", STAGE_STEP)(text)
