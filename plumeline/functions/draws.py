"""Reproducible draws from a digest of keys and a seed, the same on every engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(*keys: Column | str | int) -> Column:
    """An integer in [0, 2^32)."""
    parts = [k if isinstance(k, Column) else F.lit(k) for k in keys]
    digest = F.md5(F.concat_ws("-", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def uniform(*keys: Column | str | int) -> Column:
    """A double in [0, 1)."""
    return draw(*keys) / F.lit(4294967296.0)
