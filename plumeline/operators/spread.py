"""Order statistics that never put a whole hot group into one task, as plans without a job of their own.

A group may hold a third of all rows. Window functions partitioned by such a key, and the exact
``percentile`` aggregate, would gather it in one task. Groups up to a limit take these plain Spark forms.
Larger ones become cells, one per key and value, that are ordered digit by digit: a number's bits, in
the order of the numbers, are three digits of 22, 21 and 21 bits. Totals per leading digits are rows
beside the cells, and what lies before a cell is what lies before its first digit, before its second
digit under the same first, and before the cell under the same two. A window then holds at most the
values of one digit, four million, however large the group is. Percentiles need a few positions only: of
a large group's rows only those under the digits that hold one are counted by the next digit. The result
is exact either way.

Everything is one lazy plan. Which groups are large is a table in it, with one row per ``limit`` rows of
input at most, and therefore broadcast; where it turns out empty, adaptive execution drops the digits'
branch unrun.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.functions.draws import draw

#: Rows or cells of a group that one task orders by itself.
GROUP_LIMIT = 1_000_000
#: Rows that a task gets where a table is dealt by its number of rows.
TASK_ROWS = 200_000
#: Bits below the first and below the second digit.
CUTS = (42, 21)


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def on_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of two lists of columns, nulls equal to nulls."""
    return F.expr(" and ".join(f"{q(a)} <=> {q(b)}" for a, b in zip(left, right)) or "true")


def ordered_code(kind: T.DataType, value: str) -> str:
    """SQL of a 64-bit code whose unsigned order is the order of the values; null first, as in a window."""
    if isinstance(kind, T.DateType):
        number = f"cast(unix_date({q(value)}) as double)"
    elif isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType)):
        number = f"cast({q(value)} as double)"
    else:
        raise TypeError(f"{value} is {kind.simpleString()}: only numbers and times can be ordered here")
    # Adding zero makes -0.0 the same as 0.0. The top bit of a negative number is set: all its bits turn.
    bits = f"cast(java_method('java.lang.Double', 'doubleToLongBits', coalesce({number}, 0D) + 0D) as bigint)"
    return f"if({q(value)} is null, 0L, {bits} ^ (shiftright({bits}, 63) | {-(1 << 63) + 1}L - 1L))"


def parts_of(spark: SparkSession, rows: int) -> int:
    """Partitions for so many rows: as many as tasks run at once, and more as the table grows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def by_size(rows: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the groups with up to so many rows, and of those with more."""
    sizes = rows.groupBy(*keys).agg(F.expr("count(1) as _dg_n")).where(f"_dg_n > {limit}")
    hot = F.broadcast(sizes.selectExpr(*[f"{q(k)} as {q('_dg_h_' + k)}" for k in keys]))
    on = on_keys(keys, [f"_dg_h_{k}" for k in keys])
    return rows.join(hot, on, "left_anti"), rows.join(hot, on, "left_semi")


def digit_totals(cells: DataFrame, kind: T.DataType, keys: Sequence[str], value: str, names: Sequence[str]) -> DataFrame:
    """Totals before each cell and of its group, from totals per leading digits."""
    v, same = q(value), [q(k) for k in keys]
    sums = [q(n) for n in names]
    digits = [f"shiftrightunsigned(_dg_c, {cut})" for cut in CUTS]
    each = ", ".join(
        f"named_struct('i', {i}, 'a', {digits[0]}, 'b', {digits[1] if i > 1 else 'cast(null as bigint)'}, 'v', {v if i > 2 else f'cast(null as {kind.simpleString()})'})" for i in (1, 2, 3)
    )
    rows = cells.selectExpr("*", f"{ordered_code(kind, value)} as _dg_c").selectExpr(*same, *sums, f"inline(array({each})) as (_dg_i, _dg_a, _dg_b, {v})")
    rows = rows.groupBy(*keys, "_dg_i", "_dg_a", "_dg_b", value).agg(*[F.expr(f"sum({n}) as {n}") for n in sums])
    # Level by level: the totals of the level above open each window with what lies before all of it.
    before, total = [q(f"_dg_b_{n}") for n in names], [q(f"_dg_t_{n}") for n in names]
    ahead = "rows between unbounded preceding and 1 preceding"
    top = f"partition by {', '.join([*same, 'if(_dg_i > 1, _dg_a, null)', 'if(_dg_i > 1, _dg_b, null)', '_dg_i'])}"
    rows = rows.selectExpr(
        "*", *[f"if(_dg_i = 1, coalesce(sum({n}) over ({top} order by _dg_a {ahead}), 0), null) as {b}" for n, b in zip(sums, before)], *[f"if(_dg_i = 1, sum({n}) over ({top}), null) as {t}" for n, t in zip(sums, total)]
    )
    base = [*same, "_dg_i", "_dg_a", "_dg_b", v, *sums]
    for i, group in ((2, "_dg_a"), (3, "_dg_a, _dg_b")):
        # Rows of other levels only pass through, each in a window of its own digits.
        part = f"partition by {', '.join([*same, group])}, _dg_i in ({i - 1}, {i}), if(_dg_i in ({i - 1}, {i}), null, _dg_b)"
        running = f"over ({part} order by _dg_i, _dg_b, {v} {ahead})"
        rows = rows.selectExpr(
            *base,
            *[f"if(_dg_i = {i}, coalesce(sum(if(_dg_i = {i}, {n}, {b})) {running}, 0), {b}) as {b}" for n, b in zip(sums, before)],
            *[f"if(_dg_i = {i}, max(if(_dg_i = {i}, null, {t})) over ({part}), {t}) as {t}" for t in total],
        )
    return rows.where("_dg_i = 3").selectExpr(*same, v, *sums, *[f"{b} as {q(n + '_before')}" for n, b in zip(names, before)], *[f"{t} as {q(n + '_total')}" for n, t in zip(names, total)])


def ordered_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sums: Mapping[str, Column],
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """One row per (keys, value): each sum, its total before the value and its group total.

    ``sums`` maps a name to an aggregate that is added up, for example ``{"n": F.count("*")}``; the
    result has ``n``, ``n_before`` and ``n_total``. Nulls come first.
    """
    names = list(sums)
    group = list(keys) or ["_whole"]
    rows = df if keys else df.withColumn("_whole", F.lit(0))
    cells = rows.groupBy(*group, value).agg(*[e.alias(n) for n, e in sums.items()])
    small, large = by_size(cells, group, limit)
    whole = f"partition by {', '.join(q(k) for k in group)}"
    earlier = f"over ({whole} order by {q(value)} rows between unbounded preceding and 1 preceding)"
    columns = [q(c) for c in (*keys, value, *names)]
    plain = small.selectExpr(
        *columns, *[f"coalesce(sum({q(n)}) {earlier}, 0) as {q(n + '_before')}" for n in names], *[f"sum({q(n)}) over ({whole}) as {q(n + '_total')}" for n in names]
    )
    placed = digit_totals(large, df.schema[value].dataType, group, value, names)
    return plain.unionByName(placed if keys else placed.drop("_whole"))


def _digit_percentiles(rows: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Percentiles digit by digit: only rows under the digits that hold a wanted position are counted further."""
    same, sides = [q(k) for k in keys], [f"_dg_h_{k}" for k in keys]
    clean = rows.select(*keys, F.col(value).cast("double").alias("_dg_v")).where(F.col("_dg_v").isNotNull() & ~F.isnan("_dg_v"))
    coded = clean.selectExpr(*same, "_dg_v", f"{ordered_code(T.DoubleType(), '_dg_v')} as _dg_c")
    coded = coded.selectExpr(*same, "_dg_v", *[f"shiftrightunsigned(_dg_c, {cut}) as _dg_{i}" for i, cut in enumerate(CUTS)])
    pos = {name: f"(_dg_total - 1) * {float(p)!r}D" for name, p in probs.items()}
    holds = lambda x: f"(_dg_before <= {x} and {x} < _dg_before + _dg_n)"
    wanted = " or ".join(holds(f"{side}({x})") for x in pos.values() for side in ("floor", "ceil")) or "false"
    digits, found = [f"_dg_{i}" for i in range(len(CUTS))] + ["_dg_v"], None
    for i, digit in enumerate(digits):
        part = coded.selectExpr("*", "0L as _dg_base", "0L as _dg_all")
        if found is not None:
            # A few rows per group: where its wanted positions lie.
            named = found.selectExpr(*[f"{k} as {q(h)}" for k, h in zip(same, sides)], *[f"{d} as {d}_h" for d in digits[:i]], "_dg_before as _dg_base", "_dg_total as _dg_all")
            part = coded.join(F.broadcast(named), on_keys([*keys, *digits[:i]], [*sides, *[f"{d}_h" for d in digits[:i]]]))
        cells = part.groupBy(*keys, *digits[: i + 1]).agg(*[F.expr(f"{e} as {n}") for e, n in (("count(1)", "_dg_n"), ("max(_dg_base)", "_dg_base"), ("max(_dg_all)", "_dg_all"))])
        whole = f"partition by {', '.join([*same, *digits[:i]])}"
        ahead = f"sum(_dg_n) over ({whole} order by {digit} rows between unbounded preceding and 1 preceding)"
        total = "_dg_all" if i else f"sum(_dg_n) over ({whole})"
        cells = cells.selectExpr(*same, *digits[: i + 1], "_dg_n", f"_dg_base + coalesce({ahead}, 0) as _dg_before", f"{total} as _dg_total")
        found = cells.where(wanted)
    picks, between = [], []
    for i, (name, x) in enumerate(pos.items()):
        at = lambda y: f"max(if({holds(y)}, _dg_v, null))"
        picks += [F.expr(f"{at(f'floor({x})')} as _dg_lo{i}"), F.expr(f"{at(f'ceil({x})')} as _dg_hi{i}"), F.expr(f"max({x} - floor({x})) as _dg_f{i}")]
        between.append(f"_dg_lo{i} * (1 - _dg_f{i}) + _dg_hi{i} * _dg_f{i} as {q(name)}")
    return found.groupBy(*keys).agg(*picks).selectExpr(*same, *between)


def summary(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    value: str,
    probs: Mapping[str, float],
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Aggregates of a group's rows and exact percentiles of one column, with linear interpolation.

    Nulls and NaN have no part in the percentiles. Without keys there is one row, also of no rows.
    """
    names = list(probs)
    group = list(keys) or ["_whole"]
    rows = df if keys else df.withColumn("_whole", F.lit(0))
    small, large = by_size(rows, group, limit)
    v = F.col(value).cast("double")
    marks = F.percentile(F.when(~F.isnan(v), v), F.array(*[F.lit(float(probs[n])) for n in names])).alias("_p")
    if not keys:
        # One of the two sides has all rows; the other one's row of an empty table is left out.
        some = F.count(F.lit(1)).alias("_some")
        plain = small.agg(*aggs, some, marks)
        spread_out = large.groupBy(*group).agg(*aggs, some).join(_digit_percentiles(large, group, value, probs), group, "left")
        plain = plain.select(*[c for c in plain.columns if c != "_p"], *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
        both = plain.unionByName(spread_out.select(*plain.columns))
        kept = [F.max_by(c, "_some").alias(c) for c in plain.columns if c != "_some"]
        return both.agg(*kept)
    plain = small.groupBy(*keys).agg(*aggs, marks)
    plain = plain.select(*[c for c in plain.columns if c != "_p"], *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
    named = _digit_percentiles(large, keys, value, probs).select(*[F.col(k).alias(f"_m_{k}") for k in keys], *names)
    spread_out = large.groupBy(*keys).agg(*aggs).join(named, on_keys(keys, [f"_m_{k}" for k in keys]), "left")
    return plain.unionByName(spread_out.select(*plain.columns))


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Exact percentiles per group with linear interpolation; nulls and NaN are left out, and groups of nothing else."""
    clean = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return summary(clean, keys, [F.count(F.lit(1)).alias("_rows")], "_v", probs, limit).drop("_rows")


def rank_table(df: DataFrame, keys: Sequence[str], value: str, out: str, limit: int = GROUP_LIMIT) -> DataFrame:
    """The 1-based rank, ties averaged, of each different value of a group."""
    totals = ordered_totals(df, keys, value, {"_at": F.count(F.lit(1))}, limit)
    return totals.selectExpr(*[q(c) for c in (*keys, value)], f"_at_before + (_at + 1) / 2D as {q(out)}")


def _with_totals(df: DataFrame, keys: Sequence[str], value: str, limit: int) -> DataFrame:
    """The rows with how many rows of their group lie before (``_before``) and at (``_at``) their value."""
    totals = ordered_totals(df, keys, value, {"_at": F.count(F.lit(1))}, limit)
    names = [*keys, value]
    named = totals.select(*[F.col(k).alias(f"_r_{k}") for k in names], "_at", F.col("_at_before").alias("_before"))
    return df.join(named, on_keys(names, [f"_r_{k}" for k in names])).drop(*[f"_r_{k}" for k in names])


def average_ranks(
    df: DataFrame, keys: Sequence[str], value: str, out: str, limit: int = GROUP_LIMIT
) -> DataFrame:
    """The frame with the 1-based rank of ``value`` inside its group, ties averaged."""
    names = [*keys, value]
    table = rank_table(df, keys, value, out, limit).select(*[F.col(k).alias(f"_r_{k}") for k in names], out)
    return df.join(table, on_keys(names, [f"_r_{k}" for k in names])).drop(*[f"_r_{k}" for k in names])


def row_positions(
    df: DataFrame, value: str, tie: Sequence[str], out: str, limit: int = GROUP_LIMIT, keys: Sequence[str] = ()
) -> DataFrame:
    """0-based position by (value, tie...), in all or per group; the rows of one value are numbered in one task."""
    found = _with_totals(df, keys, value, limit)
    place = F.row_number().over(Window.partitionBy(*keys, value).orderBy(*tie))
    return found.withColumn(out, F.col("_before") + place - 1).drop("_at", "_before")


def with_parts(df: DataFrame, member: str, parts: int) -> DataFrame:
    """Add ``part``, the share out of ``parts`` that a member's digest falls in, whatever the size of its group.

    Operators that gather members into one value per group gather per (group, part): a table whose
    groups can outgrow a task asks for more parts, and gets the same grain for all of its groups.
    """
    return df.withColumn("part", F.pmod(draw(F.col(member)), F.lit(parts)).cast("int") if parts > 1 else F.lit(0))
