"""Places of rows inside their groups, without a group in one task.

Rows are sorted by range, so a group of any size lies in as many partitions as it needs; what earlier
partitions hold of it is added back from one row per group and partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.llm.common import written

#: Where monotonically_increasing_id keeps the partition's number.
PART_BIT = 33


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows sorted by (keys, order), from a table, with ``_at`` (ascending) and ``_part``."""
    found = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = written(found.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    return rows.withColumn("_part", F.shiftright("_at", PART_BIT))


def _joined(rows: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = parts.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), *[c for c in parts.columns if c not in (*keys, "_part")])
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_k_{i}"))
    # The table's size is known, so that the join sends it to all tasks only where it is small.
    return rows.join(written(named, "parts"), on).drop("_p", *[f"_k_{i}" for i in range(len(keys))])


def placed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with ``place``, from 0 in the group of their keys (no nulls there), and the group's ``total``.

    Rows that are equal in all of ``order`` take their places in any order.
    """
    rows = in_order(df, keys, order)
    parts = rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("total"))
    found = _joined(rows, parts, keys)
    return found.withColumn("place", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def earlier_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, Column], fold: Callable[[Column | str], Column], join: Callable[[Column, Column], Column], down: bool = False
) -> DataFrame:
    """The rows with, under each name, the fold of a column over the rows before them in their group.

    ``fold`` is an aggregate that ``join`` puts together (sums, exclusive ors; 0 changes nothing).
    ``down`` takes the rows after them instead.
    """
    rows = in_order(df, keys, order)
    for name, c in totals.items():
        rows = rows.withColumn(f"_v_{name}", c)
    parts = rows.groupBy(*keys, "_part").agg(*[fold(f"_v_{n}").alias(f"_s_{n}") for n in totals])
    way = (lambda c: F.desc(c)) if down else (lambda c: F.asc(c))
    other = Window.partitionBy(*keys).orderBy(way("_part")).rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy(*keys, "_part").orderBy(way("_at")).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "_part", *[F.coalesce(fold(f"_s_{n}").over(other), F.lit(0)).alias(f"_o_{n}") for n in totals])
    local = rows.select("*", *[F.coalesce(fold(f"_v_{n}").over(own), F.lit(0)).alias(f"_l_{n}") for n in totals])
    found = _joined(local, parts, keys)
    return found.select(*df.columns, *[join(F.col(f"_l_{n}"), F.col(f"_o_{n}")).alias(n) for n in totals])
