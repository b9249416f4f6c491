"""Sources placed all at once are those of a walk through the tries."""

import math

from pyspark.sql import functions as F

from plumeline.functions.draws import draw
from plumeline.operators import inject


def walk(spark, patch, height, width, n, seed, attempts, margin=10, separation=15):
    tries = spark.range(1, n * attempts + 1).select(
        F.pmod(draw(F.lit(patch), F.col("id"), "r", seed), F.lit(height - 2 * margin)).alias("r"), F.pmod(draw(F.lit(patch), F.col("id"), "c", seed), F.lit(width - 2 * margin)).alias("c"), "id"
    )
    taken, cells = [], {}
    for t in tries.orderBy("id").collect():
        if len(taken) == n:
            break
        r, c = t["r"] + margin, t["c"] + margin
        near = [p for a in (-1, 0, 1) for b in (-1, 0, 1) for p in cells.get((r // separation + a, c // separation + b), [])]
        if all(math.hypot(r - x, c - y) >= separation for x, y in near):
            taken.append((r, c))
            cells.setdefault((r // separation, c // separation), []).append((r, c))
    return taken


def placed(spark, patches, **more):
    p = spark.createDataFrame(patches, "patch int, height int, width int, n int")
    found = {}
    for r in inject.place_sources(p, seed=5, **more).orderBy("patch", "source").collect():
        found.setdefault(r["patch"], []).append((r["source"], r["row"], r["col"]))
    return found


def test_equals_the_walk(spark):
    patches = [(1, 70, 60, 5), (2, 64, 64, 30), (3, 300, 40, 12), (4, 20, 90, 3), (5, 90, 90, 0), (6, 22, 22, 2)]
    found = placed(spark, patches, attempts=100)
    assert set(found) == {1, 2, 3, 6}
    for patch, height, width, n in patches:
        want = walk(spark, patch, height, width, n, 5, 100) if height > 20 and width > 20 else []
        assert found.get(patch, []) == [(i, *p) for i, p in enumerate(want)]
    assert len(found[2]) < 30 and len(found[1]) == 5 and len(found[6]) == 1


def test_crowded_patch(spark):
    """Ten thousand candidates at once in one patch."""
    found = placed(spark, [(9, 900, 900, 2500)], attempts=4)[9]
    assert found == [(i, *p) for i, p in enumerate(walk(spark, 9, 900, 900, 2500, 5, 4))]
    assert len(found) > 1500


def test_empty(spark):
    assert placed(spark, [(4, 20, 90, 3)]) == {}


def test_no_broadcast_of_the_cells(spark, monkeypatch):
    """Tries and sources meet in shuffled partitions: their cells reach neither the driver nor one task whole."""
    plans, cut = [], inject.cut_lineage
    monkeypatch.setattr(inject, "cut_lineage", lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or cut(d))
    assert len(placed(spark, [(1, 70, 60, 5), (2, 64, 64, 30)], attempts=20)[1]) == 5
    meet = [p for p in plans if "LeftAnti" in p]
    assert meet and all("SortMergeJoin" in p for p in meet) and not any("LeftAnti, Build" in p for p in meet)
