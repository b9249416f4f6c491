"""Order-free comparison of Spark rows with DuckDB rows."""

from __future__ import annotations

import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def close(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    if number(a) and number(b):
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


def order(row):
    return tuple((x is None, str(round(x, 4)) if isinstance(x, float) else str(x)) for x in row)


def same_rows(got, expected):
    got, expected = sorted(got, key=order), sorted(expected, key=order)
    assert len(got) == len(expected), (len(got), len(expected))
    wrong = [(g, e) for g, e in zip(got, expected) if not close(g, e)]
    assert not wrong, (len(wrong), wrong[:3])


def rows_of(df):
    cols = sorted(df.columns)
    return cols, [tuple(plain(r[c]) for c in cols) for r in df.collect()]
