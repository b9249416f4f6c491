"""Band pairs from matrices against numpy, with missing values, many samples and all 285 bands."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumeline.operators import pixels


def contrast(v, m):
    ok = np.isfinite(v)
    p, b = v[ok & m], v[ok & ~m]
    if len(p) < 5 or len(b) < 20 or b.std() < 1e-9:
        return None
    return abs(p.mean() - b.mean()) / b.std()


def rows_of(rng, samples, n, count):
    out = []
    for s in range(samples):
        for k in range(count):
            t, r = (list(map(float, 1 + 0.3 * rng.random(n))) for _ in range(2))
            if k % 7 == 0:
                t[k % n] = None
            if k % 11 == 0:
                r[(k + 1) % n] = 0.0
            if k % 13 == 0:
                t = t[: n - 1]
            out.append((None if s == 2 else f"s{s}", k % 3 == 0 if k % 17 else None, t, r))
    return out


@pytest.mark.parametrize("cells", [pixels.PAIR_CELLS, 1])
def test_pairs(spark, cells, monkeypatch):
    rng, n = np.random.default_rng(7), 6
    rows = rows_of(rng, 4, n, 90)
    df = spark.createDataFrame(rows, "sample string, m boolean, t array<double>, r array<double>").repartition(5)
    monkeypatch.setattr(pixels, "PAIR_CELLS", cells)
    got = {(r["sample"], r["i"], r["j"]): (r["raw"], r["normalised"]) for r in pixels.band_ratio_pairs(df, "sample", "t", "r", F.col("m"), n).collect()}
    assert len(got) == 4 * n * (n - 1)
    for s in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == s and r[1] is not None]
        m = np.array([r[1] for r in own])
        t, r = (np.array([[np.nan if i >= len(x[k]) or x[k][i] is None else x[k][i] for i in range(n)] for x in own]) for k in (2, 3))
        for i in range(n):
            for j in range(n):
                if i == j:
                    continue
                with np.errstate(all="ignore"):
                    safe = (np.abs(t[:, j]) > 1e-9) & (np.abs(r[:, j]) > 1e-9)
                    a, b = np.where(safe, t[:, i] / t[:, j], np.nan), np.where(safe, r[:, i] / r[:, j], np.nan)
                    want = contrast(a - b, m), contrast(a / b, m)
                assert np.allclose(got[s, i, j], want, rtol=1e-9), (s, i, j)


def test_all_bands(spark):
    rng = np.random.default_rng(1)
    rows = [("x", k % 2 == 0, list(map(float, 1 + rng.random(285))), list(map(float, 1 + rng.random(285)))) for k in range(60)]
    df = spark.createDataFrame(rows, "sample string, m boolean, t array<double>, r array<double>")
    found = pixels.band_ratio_pairs(df, "sample", "t", "r", F.col("m"), 285)
    assert found.agg(F.count("raw"), F.max("i"), F.max("j")).first()[0:3] == (285 * 284, 284, 284)
