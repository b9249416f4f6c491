"""Places where users bring their own functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scalar(fn: Callable[[pd.Series], pd.Series], returns: str) -> Callable[..., Column]:
    """A vectorised per-value function."""
    return F.pandas_udf(fn, returns)


def aggregate_by_parts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    partial: Callable[[pd.Series], float],
    combine: Column,
    parts: int = 64,
    out: str = "value",
) -> DataFrame:
    """A reducer of the user's own, run on hashed parts of every group and then combined.

    ``combine`` is an aggregate over the column ``_p`` of partial results, so no group has to fit in
    one task.
    """
    share = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    name = df.schema[value].name

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {k: pdf[k].iloc[0] for k in keys}
        row["_p"] = float(partial(pdf[name]))
        return pd.DataFrame([row])

    kind = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    done = df.withColumn("_share", share).groupBy(*keys, "_share").applyInPandas(one, f"{kind}, _p double")
    return done.groupBy(*keys).agg(combine.alias(out))


#: Types of keys whose equality is the same in Spark and in pandas, null apart from all values.
PLAIN_KEYS = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def grouped_map(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A whole-group function, one call per group; meant for groups of bounded size such as scenes.

    With keys of plain types groups come to Python many at a time, as rows sorted by key: a batch per
    group would take longer than most functions do.
    """
    if not keys or not all(isinstance(df.schema[k].dataType, PLAIN_KEYS) for k in keys):
        return df.groupBy(*keys).applyInPandas(fn, schema)
    names = list(keys)
    whole = {c.name: c.dataType.typeName() for c in df.schema if isinstance(c.dataType, (T.IntegralType, T.BooleanType))}
    natural = {"byte": "int8", "short": "int16", "integer": "int32", "long": "int64", "boolean": "bool"}

    def differs(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
        found = np.zeros(len(a), bool)
        for k in names:
            x, y = a[k], b[k]
            # In this order, so that a null is never compared with a value.
            none = x.isna().to_numpy() | y.isna().to_numpy()
            found |= np.where(none, x.isna().to_numpy() != y.isna().to_numpy(), x.to_numpy() != y.to_numpy())
        return found

    def call(parts: list[pd.DataFrame]) -> pd.DataFrame:
        group = parts[0] if len(parts) == 1 else pd.concat(parts)
        # Nulls elsewhere in the batch make whole numbers floats: a group without nulls has its own type.
        for c, kind in whole.items():
            if group[c].dtype != natural[kind] and not group[c].isna().any():
                group = group.assign(**{c: group[c].astype(natural[kind])})
        return fn(group.reset_index(drop=True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            inner = np.flatnonzero(differs(batch.iloc[1:], batch.iloc[:-1])) + 1
            cuts, done = [0, *inner.tolist(), len(batch)], []
            for a, b in zip(cuts, cuts[1:]):
                part = batch.iloc[a:b]
                if held and (a > 0 or differs(held[-1].iloc[-1:], part.iloc[:1])[0]):
                    done.append(call(held))
                    held = []
                held.append(part)
            # One frame per run of equal types: joined with floats, large whole numbers would be rounded.
            for _, alike in groupby(done, key=lambda f: (tuple(f.columns), tuple(f.dtypes))):
                yield pd.concat(list(alike), ignore_index=True)
        if held:
            yield call(held)

    return df.repartition(*names).sortWithinPartitions(*names).mapInPandas(run, schema)


class TileWindows:
    """Table function: the square windows of one size that fit a scene."""

    def eval(self, height: int, width: int, size: int):
        for row in range(0, height - size + 1, size):
            for col in range(0, width - size + 1, size):
                yield row, col


def register_table_functions(spark: SparkSession) -> None:
    spark.udtf.register("tile_windows", F.udtf(TileWindows, returnType="row_off int, col_off int"))
