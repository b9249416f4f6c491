"""Limits that are part of a feature fail loudly, and criteria of simulated volumes."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plumeline.operators import bank, pixels


def coded(spark, n):
    a = spark.createDataFrame([(1, i) for i in range(n)], "scene int, plume int")
    b = a.where("false")
    matched = spark.createDataFrame([], "scene int, plume_a int, plume_b int")
    inner = spark.createDataFrame([], "scene int, plume_a int, plume_b int, in_a double, in_b double")
    return pixels.instance_codes(a, b, matched, inner, inner)


def test_codes_fit_a_byte(spark):
    assert coded(spark, 255).agg(F.max("code")).first()[0] == 255
    with pytest.raises(PySparkException, match="more than 255 codes in scene 1"):
        coded(spark, 256).collect()


def test_criteria(spark):
    names = "volume, peak, edge_upwind, edge_downwind, edge_top, edge_bottom, interior_min, slope, width_edge_m, foreign_share"
    rows = [
        (1, 1000.0, 19.0, 30.0, 5.0, 5.0, 40.0, -0.1, 60.0, 0.001),
        (2, 1000.0, 20.0, 60.0, 5.0, 5.0, 40.0, -0.1, 80.0, None),
        (3, 1000.0, 0.0, 30.0, 5.0, 21.0, 40.0, 0.0, 40.0, float("nan")),
    ]
    kinds = "volume int, " + ", ".join(f"{n.strip()} double" for n in names.split(",")[1:])
    found = {r["volume"]: r for r in bank.volume_criteria(spark.createDataFrame(rows, kinds)).collect()}
    told = lambda v: [found[v][c] for c in ("fades_out", "entry_ok", "lateral_ok", "foreign_ok", "width_ok", "passes", "touches_edge")]
    assert told(1) == [True, True, True, True, True, True, False]
    assert told(2) == [False, False, True, False, False, False, True]
    assert told(3) == [False, True, False, False, True, False, False]


def test_grown_masks(spark):
    """Against a loop over the box: pixels at the rim and outside, lines of many and of one, two masks."""
    from random import Random

    rng = Random(5)
    a, b = ({(s, rng.randrange(-3, 34), rng.randrange(-3, 43)) for s in range(3) for _ in range(n)} for n in (25, 9))
    frame = lambda px: spark.createDataFrame(sorted(px), "scene int, row int, col int")
    shape = spark.createDataFrame([(0, 30, 40), (1, 7, 5), (2, 34, 43)], "scene int, height int, width int")
    size = {0: (30, 40), 1: (7, 5), 2: (34, 43)}
    for radius in (0, 1, 5):
        want = {(s, r + i, c + j) for s, r, c in a | b for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)}
        want = {(s, r, c) for s, r, c in want if 0 <= r < size[s][0] and 0 <= c < size[s][1]}
        rows = [tuple(x) for x in pixels.mask_union_dilate([frame(a), frame(b)], shape, radius).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
