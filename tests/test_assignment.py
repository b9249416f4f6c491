"""One-to-one assignment is the full matrix's optimum at every size, also with costs over one."""

import random

import numpy as np
import pytest

from plumeline.operators import joins


def direct(pairs, n_a, n_b):
    """Least total over the full matrix, without a partner counted as one."""
    size = max(n_a, n_b)
    cost = np.ones((n_a, n_b))
    for _, a, b, c in pairs:
        cost[a, b] = c
    chosen = joins.min_cost_assignment(cost)
    assert len(chosen) == min(n_a, n_b) <= size
    return float(sum(cost[r, c] for r, c in chosen))


def scenes():
    rng = random.Random(4)
    pairs = [(0, 0, 0, 1.5)], [(1, 0, 0, 0.1), (1, 1, 1, 1.5)]
    sizes = [(0, 1, 1), (1, 2, 2)]
    pairs = [p for part in pairs for p in part]
    for scene in range(2, 14):
        n_a, n_b = rng.randint(3, 6), rng.randint(3, 6)
        share = rng.choice([0.3, 0.8, 1.0])
        pairs += [(scene, a, b, round(rng.random() * 3, 4)) for a in range(n_a) for b in range(n_b) if rng.random() < share]
        sizes.append((scene, n_a, n_b))
    # More plumes than codes: one far pair is all that is left, or every plume overlaps every other.
    many = 260
    pairs += [(14, i, i, 0.25) for i in range(many - 1)] + [(14, many - 1, many - 1, 1.5)]
    pairs += [(15, a, b, round(1 + rng.random(), 4)) for a in range(2) for b in range(many)]
    return pairs, sizes + [(14, many, many), (15, 2, many)]


@pytest.mark.parametrize("limit", [1, joins.MAX_CODES])
def test_costs_over_one_against_the_direct_optimum(spark, limit):
    pairs, sizes = scenes()
    p = spark.createDataFrame(pairs, "scene int, plume_a int, plume_b int, cost double")
    s = spark.createDataFrame(sizes, "scene int, n_a int, n_b int")
    cost = {(r[0], r[1], r[2]): r[3] for r in pairs}
    chosen = [tuple(r) for r in joins.assign_one_to_one(p, s, limit).select("scene", "plume_a", "plume_b").collect()]
    for scene, n_a, n_b in sizes:
        mine = [c for c in chosen if c[0] == scene]
        assert len({c[1] for c in mine}) == len({c[2] for c in mine}) == len(mine)
        total = sum(cost[c] for c in mine) + min(n_a, n_b) - len(mine)
        assert abs(total - direct([x for x in pairs if x[0] == scene], n_a, n_b)) < 1e-6, scene
    assert {(0, 0, 0), (1, 1, 1)} <= set(chosen)
    assert (14, 259, 259) in chosen and sum(c[0] == 15 for c in chosen) == 2
