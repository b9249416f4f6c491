"""The near-dedup stage against all pairs of texts, at similarities around 0.8 and above."""

from itertools import combinations
from random import Random

import corpus_pipeline as pipeline
from plumeline.llm import copies


def sets_of(texts):
    out = []
    for text in texts:
        words = (text or "").lower().split()
        out.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    return out


def similar(a, b):
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)


def components(texts):
    sets = sets_of(texts)
    label = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if similar(sets[i], sets[j]) and label[i] != label[j]:
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    return label


def varied(rng):
    """Families of a text and copies with some words exchanged, some copies of copies, and odd texts."""
    word = lambda: f"w{rng.randrange(4000)}"
    texts = [None, "", " \t", "One two", "one  TWO", "one two three", "a b c d e", "A b c d e f"]
    for family in range(60):
        base = [word() for _ in range(rng.randrange(60, 400))]
        texts.append(" ".join(base))
        for copy in range(6):
            again = list(base)
            for at in rng.sample(range(len(base)), max(1, len(base) * rng.randrange(5, 40) // 1000)):
                again[at] = word()
            texts.append(" ".join(again))
            if copy % 3 == 2:
                base = again
    return texts


def test_pairs_against_brute_force(spark):
    texts = varied(Random(7))
    sets = sets_of(texts)
    pairs = [len(a & b) / len(a | b) for a, b in combinations(sets, 2) if a and b]
    assert sum(0.8 <= s < 0.95 for s in pairs) > 200 and sum(0.7 < s < 0.8 for s in pairs) > 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: r["component_id"] for r in copies.near_copies(docs).collect()}
    want = components(texts)
    assert found == dict(enumerate(want))
    single = pipeline.dedup_stage(spark, docs, "")
    assert {r["doc_id"] for r in single.collect()} == set(want)


def test_recall_of_bands():
    """Pairs at 0.8 exactly: 400 of 500 hashes in common."""
    import numpy as np

    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(2000):
        own = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        a, b = own[:450], np.concatenate([own[:400], own[450:]])
        assert copies.alike(a, b)
        missed += not (copies.bands_of(a) == copies.bands_of(b)).any()
    assert missed <= 2


def test_fingerprints_name_candidates(spark, monkeypatch):
    """Every text's five-word fingerprint is looked up in the index, and what it links is held against the sets."""
    from plumeline.llm.simhash import fingerprint

    rng, looked, held = Random(11), [], []
    base = [f"w{rng.randrange(4000)}" for _ in range(900)]
    texts = [None, "", "one two", " ".join(base)]
    for at in (5, 300, 600):
        texts.append(" ".join([*base[:at], "other", *base[at + 1 :]]))
    texts += [" ".join(f"w{rng.randrange(4000)}" for _ in range(80)) for _ in range(5)]
    near_links, linked = copies.near_links, copies.linked
    monkeypatch.setattr(copies, "near_links", lambda p, radius: looked.append([r[0] for r in p.collect()]) or near_links(p, radius))
    monkeypatch.setattr(copies, "linked", lambda p, sets: held.append(p.count()) or linked(p, sets))
    single = pipeline.dedup_stage(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), "")
    assert {r["doc_id"] for r in single.collect()} == set(components(texts))
    assert sorted(looked[0]) == sorted({int.from_bytes(fingerprint(t, 5), signed=True) for t in texts[2:]})
    assert held[0] > 0


def test_print_pairs_hold_all_near_ones(spark):
    rng = Random(3)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for k in range(60):
        own = rng.choice(prints)
        for _ in range(rng.randrange(5)):
            own ^= 1 << rng.randrange(64)
        prints.append(own)
    rows = [(p - (1 << 64) if p >> 63 else p, i, i * 10) for i, p in enumerate(prints)]
    found = copies.print_pairs(spark.createDataFrame(rows, "print long, id int, size int"))
    pairs = [(r["id_src"], r["id_dst"]) for r in found.collect()]
    label = lambda links: _labels(len(prints), links)
    assert label(pairs) == label([(a, b) for a, b in combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3])
    assert len(set(label(pairs))) < len(prints) - 30


def _labels(n, links):
    label = list(range(n))
    for a, b in links:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    return label


def test_family_below_the_least_similarity(spark, monkeypatch):
    """Copies of a text that is not there share bands, but few pairs of them are at 0.8: few are held against the sets."""
    rng, held = Random(5), []
    base, texts = [f"w{i}" for i in range(150)], []
    for k in range(150):
        own = list(base)
        for at in rng.sample(range(0, 150, 3), 4):
            own[at] = f"x{k}" if rng.random() < 0.5 else "same"
        texts.append(" ".join(own))
    linked = copies.linked
    monkeypatch.setattr(copies, "linked", lambda p, sets: held.append(p.count()) or linked(p, sets))
    found = {r["doc_id"]: r["component_id"] for r in copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    want = components(texts)
    assert found == dict(enumerate(want)) and 1 < len(set(want)) < 150
    assert held[-1] < 300


def test_parities_differ_in_no_more_than_the_sets():
    import numpy as np

    rng = np.random.default_rng(2)
    for both, a, b in [(0, 0, 3), (5, 1, 0), (130, 16, 16), (400, 50, 50), (30, 900, 2)]:
        words = rng.integers(0, 1 << 63, both + a + b, dtype=np.uint64) * np.uint64(2)
        x, y = (copies.parities_of(w).view(np.uint64) for w in (words[: both + a], np.concatenate([words[:both], words[both + a :]])))
        assert int(np.bitwise_count(x ^ y).sum()) <= a + b
        assert copies.parities_of(words).shape == (8,)
