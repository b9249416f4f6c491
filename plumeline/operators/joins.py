"""Joins: consensus, lookups, day ranges, nearest neighbours, brackets, slots and pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.functions.angles import circular_diff
from plumeline.session import cut_lineage, settled

# Fixed values of the cross-catalogue match.
MIN_OVERLAP_M2 = 3500.0
IOU_MIN = 0.1
CONTAINMENT_MIN = 0.5
SOURCE_NEAR_M = 1000.0
DISTANCE_SCALE_M = 2000.0
MAX_CODES = 255

# Fixed values of the reference search.
WINDOW_DAYS = 120
BUFFER_DAYS = 5
SEASON_DAYS = 45
YEARS_BACK = 2
POOL_SIZE = 40


def consensus_join(a: DataFrame, b: DataFrame, key: str, count_a: str, count_b: str) -> DataFrame:
    """Full outer join of two per-granule rollups; consensus where both hold plumes."""
    joined = a.join(b, key, "full_outer").na.fill(0, [count_a, count_b])
    return joined.withColumn("consensus", (F.col(count_a) > 0) & (F.col(count_b) > 0))


def lookup_left(df: DataFrame, table: DataFrame, key: str, value: str, fallback: str | Column) -> DataFrame:
    """Left join one value; misses take the fallback."""
    fb = F.col(fallback) if isinstance(fallback, str) else fallback
    hit = table.select(key, F.col(value).alias("_v"))
    return df.join(hit, key, "left").withColumn(value, F.coalesce("_v", fb)).drop("_v")


def enrich(df: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Attach several tables on the same composite key."""
    for part in parts:
        df = df.join(part, list(keys), "left")
    return df


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows still lacking each enriched column; all zero when the enrichment is complete."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def compare_versions(old: DataFrame, new: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Both versions of a value side by side on the common keys."""
    a = old.select(*keys, F.col(column).alias(f"{column}_old"))
    b = new.select(*keys, F.col(column).alias(f"{column}_new"))
    return a.join(b, list(keys))


def pivot_references(df: DataFrame, ident: str, rank: str, columns: Sequence[str], slots: int = 3) -> DataFrame:
    """Ranked references to one row per sample with a column set per slot."""
    picks = [
        F.first(F.when(F.col(rank) == k, F.col(c)), ignorenulls=True).alias(f"{c}{k}")
        for k in range(1, slots + 1)
        for c in columns
    ]
    return df.where(F.col(rank) <= slots).groupBy(ident).agg(*picks)


def overlap_pairs(a: DataFrame, b: DataFrame, scene: str = "scene", plume: str = "plume") -> DataFrame:
    """Plume pairs of two pixel sets that share pixels: counts, IoU and containment both ways.

    The join key is the pixel, so only pairs that really overlap are ever formed.
    """
    left = a.select(scene, "row", "col", F.col(plume).alias("plume_a")).distinct()
    right = b.select(scene, "row", "col", F.col(plume).alias("plume_b")).distinct()
    area_a = left.groupBy(scene, "plume_a").agg(F.count(F.lit(1)).alias("area_a"))
    area_b = right.groupBy(scene, "plume_b").agg(F.count(F.lit(1)).alias("area_b"))
    shared = left.join(right, [scene, "row", "col"]).groupBy(scene, "plume_a", "plume_b").agg(F.count(F.lit(1)).alias("inter"))
    pairs = shared.join(area_a, [scene, "plume_a"]).join(area_b, [scene, "plume_b"])
    return pairs.select(
        scene,
        "plume_a",
        "plume_b",
        "inter",
        "area_a",
        "area_b",
        (F.col("inter") / (F.col("area_a") + F.col("area_b") - F.col("inter"))).alias("iou"),
        (F.col("inter") / F.col("area_a")).alias("in_a"),
        (F.col("inter") / F.col("area_b")).alias("in_b"),
    )


def with_match_cost(pairs: DataFrame, distance: str) -> DataFrame:
    """Cost of a pair: what is not contained, plus source distance in units of two kilometres."""
    far = F.coalesce(F.col(distance) / DISTANCE_SCALE_M, F.lit(1e3))
    return pairs.withColumn("cost", 1 - F.greatest("in_a", "in_b") + far)


def self_overlap_pairs(df: DataFrame, scene: str = "scene", plume: str = "plume") -> DataFrame:
    """Unordered pairs of different plumes of one pixel set that share pixels."""
    return overlap_pairs(df, df, scene, plume).where("plume_a < plume_b")


def min_cost_assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """Minimum-cost one-to-one assignment of rows to columns by shortest augmenting paths."""
    flip = cost.shape[0] > cost.shape[1]
    c = cost.T if flip else cost
    n, m = c.shape
    price_r, price_c = np.zeros(n), np.zeros(m)
    row_of, col_of = np.full(m, -1), np.full(n, -1)
    for start in range(n):
        dist, via, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, dtype=bool)
        visited = [start]
        row, base = start, 0.0
        while True:
            reach = base + c[row] - price_r[row] - price_c
            better = ~done & (reach < dist)
            dist[better], via[better] = reach[better], row
            col = int(np.argmin(np.where(done, np.inf, dist)))
            base, done[col] = dist[col], True
            if row_of[col] < 0:
                break
            row = int(row_of[col])
            visited.append(row)
        price_r[start] += base
        for r in visited[1:]:
            price_r[r] += base - dist[col_of[r]]
        price_c[done] -= base - dist[done]
        while True:
            row = int(via[col])
            row_of[col] = row
            col, col_of[row] = int(col_of[row]), col
            if row == start:
                break
    pairs = [(i, int(col_of[i])) for i in range(n)]
    return [(j, i) for i, j in pairs] if flip else pairs


def _solve_scene(pdf: pd.DataFrame) -> pd.DataFrame:
    a = {p: i for i, p in enumerate(sorted(pdf["plume_a"].unique()))}
    b = {p: i for i, p in enumerate(sorted(pdf["plume_b"].unique()))}
    if pdf["whole"].iloc[0]:
        shape = (int(pdf["n_a"].iloc[0]), int(pdf["n_b"].iloc[0]))
    else:
        shape = (len(a), len(b) + len(a))
    cost = np.ones(shape)
    rows = pdf["plume_a"].map(a).to_numpy()
    cols = pdf["plume_b"].map(b).to_numpy()
    cost[rows, cols] = pdf["cost"].to_numpy()
    chosen = set(min_cost_assignment(cost))
    keep = [(r, c) in chosen for r, c in zip(rows, cols)]
    return pdf.loc[keep, ["scene", "plume_a", "plume_b"]]


def assign_one_to_one(pairs: DataFrame, sizes: DataFrame, whole_limit: int = MAX_CODES) -> DataFrame:
    """Minimum-cost one-to-one pairs per scene; pairs that do not overlap cost one.

    ``pairs`` has scene, plume_a, plume_b, cost for overlapping pairs; ``sizes`` has scene, n_a,
    n_b. Every plume of the side with fewer gets a partner, so a pair dearer than one is chosen where
    no cheaper partner is left; this holds at every size. Instance codes allow at most 255 plumes per
    side, so a scene's matrix is small. A scene with more is solved per connected component of its
    overlaps, where a plume may stay alone at cost one. That is the same optimum whenever the plumes
    left alone can all be dealt partners they don't overlap, which is certain if the most overlaps on
    either side add up to no more than what the larger side has left; any other scene is solved on its
    whole matrix.
    """
    whole = (F.col("n_a") <= whole_limit) & (F.col("n_b") <= whole_limit)
    sized = pairs.join(sizes, "scene").withColumn("whole", whole)
    schema = pairs.select("scene", "plume_a", "plume_b").schema
    small = sized.where("whole").select("scene", "plume_a", "plume_b", "cost", "n_a", "n_b", "whole")
    out = small.groupBy("scene").applyInPandas(_solve_scene, schema)
    if sizes.where(~whole).isEmpty():
        return out
    from plumeline.operators.select import connected_components

    big = sized.where("not whole")
    node = lambda side: F.concat_ws("/", "scene", F.lit(side), f"plume_{side}")
    labels = connected_components(big.select(node("a").alias("src"), node("b").alias("dst")))
    tagged = big.withColumn("node", node("a")).join(labels, "node")
    tagged = tagged.select("scene", "plume_a", "plume_b", "cost", "n_a", "n_b", "whole", "component")
    solved = tagged.groupBy("scene", "component").applyInPandas(lambda pdf: _solve_scene(pdf), schema)
    solved = cut_lineage(solved)
    rest = big
    for side in ("a", "b"):
        rest = rest.join(solved.select("scene", f"plume_{side}"), ["scene", f"plume_{side}"], "left_anti")
    found = sizes.where(~whole).join(solved.groupBy("scene").agg(F.count(F.lit(1)).alias("_k")), "scene", "left")
    for side in ("a", "b"):
        most = rest.groupBy("scene", f"plume_{side}").agg(F.count(F.lit(1)).alias("_n"))
        found = found.join(most.groupBy("scene").agg(F.max("_n").alias(f"_{side}")), "scene", "left")
    left = F.greatest("n_a", "n_b") - F.coalesce("_k", F.lit(0))
    tight = cut_lineage(found.where((F.col("_a") + F.col("_b")) > left).select("scene"))
    again = big.join(tight, "scene", "left_semi").withColumn("whole", F.lit(True)).select(*small.columns)
    again = again.groupBy("scene").applyInPandas(_solve_scene, schema)
    return out.unionByName(solved.join(tight, "scene", "left_anti")).unionByName(again)


def accept_match(inter_m2: Column, iou: Column, in_a: Column, in_b: Column, distance_m: Column) -> Column:
    """Large enough shared area, and close by one of three measures."""
    near = F.coalesce(distance_m <= SOURCE_NEAR_M, F.lit(False))
    return (inter_m2 >= MIN_OVERLAP_M2) & (
        (iou >= IOU_MIN) | (F.greatest(in_a, in_b) >= CONTAINMENT_MIN) | near
    )


# Candidate pairs one grid cell may hold before a smaller radius is searched first.
MAX_CELL_PAIRS = 256
# Radii along a tile's side.
TILE = 16


def _numbered(df: DataFrame, keys: Sequence[str], ident: str, limit: int) -> DataFrame:
    """Position ``n`` of a row among the rows of its keys; crowded keys are numbered in shares."""
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0]
    if top is None or top <= limit:
        return df.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(ident)))
    shared = df.withColumn("_s", F.pmod(F.xxhash64(ident), F.lit(256)))
    inside = shared.withColumn("_i", F.row_number().over(Window.partitionBy(*keys, "_s").orderBy(ident)))
    earlier = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    starts = shared.groupBy(*keys, "_s").agg(F.count(F.lit(1)).alias("_c"))
    starts = starts.select(*keys, "_s", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_o"))
    return inside.join(starts, [*keys, "_s"]).withColumn("n", F.col("_i") + F.col("_o")).drop("_s", "_i", "_o")


def _search_levels(left: DataFrame, right: DataFrame, scene: str, limit: float, max_pairs: int) -> list[float]:
    """Radii to search, smallest first, so that no grid cell offers too many pairs at once."""
    levels = [limit]
    while levels[0] > limit / 2**30:
        cell = lambda c: F.floor(F.col(c) / levels[0])  # noqa: B023, E731
        na = left.groupBy(scene, cell("ax").alias("cx"), cell("ay").alias("cy")).agg(F.count(F.lit(1)).alias("na"))
        nb = right.groupBy(scene, cell("bx").alias("cx"), cell("by").alias("cy")).agg(F.count(F.lit(1)).alias("nb"))
        load = na.join(nb, [scene, "cx", "cy"]).agg(F.max(F.col("na") * F.col("nb"))).first()[0]
        if load is None or load <= max_pairs:
            break
        levels.insert(0, levels[0] / 8)
    return levels


def greedy_distance_pairs(
    a: DataFrame, b: DataFrame, scene: str, ident: str, limit: float, max_pairs: int = MAX_CELL_PAIRS, crowd: int = 1_000_000
) -> DataFrame:
    """Closest cross pairs first, each point used once, distances under the limit.

    Points have x and y in the unit of the limit. Coincident points are paired by their position in
    id order. Where cells are crowded the search starts at a smaller radius, which thins them out
    before wider neighbourhoods are looked at. Within a radius, each round takes the pairs of a tile
    that no pair outside can change, until none is left.
    """
    left = a.select(scene, F.col(ident).alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    right = b.select(scene, F.col(ident).alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    same = _numbered(left, [scene, "ax", "ay"], "a", crowd).join(
        _numbered(right, [scene, "bx", "by"], "b", crowd).withColumnRenamed("bx", "ax").withColumnRenamed("by", "ay"),
        [scene, "ax", "ay", "n"],
    )
    found = cut_lineage(same.select(scene, "a", "b", F.lit(0.0).alias("distance")))
    radius = 0.0
    while radius < limit:
        free_a = left.join(found.select(scene, "a"), [scene, "a"], "left_anti")
        free_b = right.join(found.select(scene, "b"), [scene, "b"], "left_anti")
        # Twice as far each time, or as far as what is left by now is thin.
        radius = min(max(2 * radius, _search_levels(free_a, free_b, scene, limit, max_pairs)[0]), limit)
        cells_a = free_a.select(
            "*",
            F.explode(F.sequence(F.floor(F.col("ax") / radius) - 1, F.floor(F.col("ax") / radius) + 1)).alias("cx"),
        ).select(
            "*",
            F.explode(F.sequence(F.floor(F.col("ay") / radius) - 1, F.floor(F.col("ay") / radius) + 1)).alias("cy"),
        )
        cells_b = free_b.select(
            "*", F.floor(F.col("bx") / radius).alias("cx"), F.floor(F.col("by") / radius).alias("cy")
        )
        # A radius's pairs are formed once; each round goes over those whose points are both free.
        near = settled(
            cells_a.join(cells_b, [scene, "cx", "cy"])
            .withColumn("distance", F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")))
            .where(F.col("distance") < radius)
            .select(scene, "a", "b", "distance", "ax", "ay")
        )
        turn, kind = 0, near.select(scene, "a", "b", "distance").schema
        while True:
            # A pair's place among all pairs of its two points tells a tile what it does not see.
            for end, other in (("a", "b"), ("b", "a")):
                near = near.withColumn(f"_{end}", F.dense_rank().over(Window.partitionBy(scene, end).orderBy("distance", other)))
            # Tiles lie elsewhere in every round, so that the rim of one round is inside in another.
            tile = [F.floor(F.col(c) / (TILE * radius) + (turn * step) % 1).alias(t) for c, t, step in (("ax", "_tx", 0.618), ("ay", "_ty", 0.414))]
            fresh = settled(near.select("*", *tile).groupBy(scene, "_tx", "_ty").applyInArrow(_greedy_in_tile, kind))
            if fresh.isEmpty():
                break
            found, turn = found.unionByName(fresh), turn + 1
            for end in ("a", "b"):
                near = near.join(fresh.select(scene, end), [scene, end], "left_anti")
            near = settled(near.select(scene, "a", "b", "distance", "ax", "ay"))
        found = settled(found)
    return found


def _greedy_in_tile(key: tuple, pairs: pa.Table) -> pa.Table:
    """The pairs of a tile that the greedy rule takes whatever lies outside.

    Pairs come by distance and then by id. A point is unsure from where a pair of its is missing here, or
    may have been taken; what an unsure point would take waits for another round. A pair that is the first
    of both its points is always taken.
    """
    pairs = pairs.take(pc.sort_indices(pairs, [("distance", "ascending"), ("a", "ascending"), ("b", "ascending")]))
    codes = [pc.fill_null(pairs.column(c).combine_chunks().dictionary_encode().indices, -1).to_pylist() for c in ("a", "b")]
    places = [pairs.column(f"_{c}").to_pylist() for c in ("a", "b")]
    free, unsure, taken = range(3)
    # The last place is for points without an id: they are never taken, but stand in the way.
    state, seen = ([[0] * (len(pairs) + 1) for _ in codes] for _ in range(2))
    kept = []
    for i, (a, b, *place) in enumerate(zip(*codes, *places)):
        for mine, known, point, now in zip(state, seen, (a, b), place):
            if now > known[point] + 1 and mine[point] == free:
                mine[point] = unsure
            known[point] = now
        one, two = state[0][a], state[1][b]
        if taken in (one, two):
            continue
        if a >= 0 and b >= 0 and one == two == free:
            state[0][a] = state[1][b] = taken
            kept.append(i)
        else:
            state[0][a] = state[1][b] = unsure
    return pairs.take(pa.array(kept, pa.int64())).select([c for c in pairs.column_names if not c.startswith("_") and c not in ("ax", "ay")])


def days_between(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def within_days_join(
    targets: DataFrame, candidates: DataFrame, site: str, max_days: int, target_day: str = "target_day", day: str = "day"
) -> DataFrame:
    """Candidates of the same site within a number of days of the target.

    Days are cut into buckets of the window's width and the join key is (site, bucket), so a site
    with very many acquisitions is spread over time.
    """
    epoch = F.lit("1970-01-01").cast("date")
    slot = lambda c: F.floor(F.datediff(F.col(c), epoch) / max_days)
    left = targets.select("*", F.explode(F.sequence(slot(target_day) - 1, slot(target_day) + 1)).alias("_slot"))
    right = candidates.withColumn("_slot", slot(day))
    joined = left.join(right, [site, "_slot"]).drop("_slot")
    return joined.where(days_between(F.col(day), F.col(target_day)) <= max_days)


def seasonal_window_join(
    targets: DataFrame,
    candidates: DataFrame,
    site: str,
    target: str,
    candidate: str,
    window: int = WINDOW_DAYS,
    buffer: int = BUFFER_DAYS,
    season: int = SEASON_DAYS,
    years: int = YEARS_BACK,
    pool: int = POOL_SIZE,
) -> DataFrame:
    """Candidate scenes of each target: near in time first, then the same season of earlier years.

    A season year is only used while the target has fewer than ``pool`` candidates so far. The
    result has the branch each candidate came from: 0 near in time, 1 + years back otherwise.
    """
    near = within_days_join(targets, candidates, site, window).where(
        days_between(F.col("day"), F.col("target_day")) >= buffer
    )
    near = near.select(site, target, "target_day", candidate, "day").withColumn("branch", F.lit(0))
    n_near = near.groupBy(target).agg(F.count(F.lit(1)).alias("_n"))
    short = targets.join(n_near, target, "left").where(F.coalesce("_n", F.lit(0)) < pool).drop("_n")
    back = short.select("*", F.explode(F.sequence(F.lit(0), F.lit(years))).alias("_back"))
    anchor = F.add_months("target_day", (-12 * F.col("_back")).cast("int"))
    cutoff = F.date_sub("target_day", buffer)
    windows = back.select(
        "*",
        F.date_sub(anchor, season).alias("_from"),
        F.when(F.col("_back") == 0, cutoff).otherwise(F.date_add(anchor, season)).alias("_to"),
    ).where("_to > _from")
    width = 2 * season + 1
    epoch = F.lit("1970-01-01").cast("date")
    slot = lambda c: F.floor(F.datediff(F.col(c), epoch) / width)
    spread = windows.select("*", F.explode(F.sequence(slot("_from"), slot("_to"))).alias("_slot"))
    seasonal = (
        spread.join(candidates.withColumn("_slot", slot("day")), [site, "_slot"])
        .where((F.col("day") >= F.col("_from")) & (F.col("day") <= F.col("_to")) & (F.col("day") < cutoff))
        .select(site, target, "target_day", candidate, "day", (F.col("_back") + 1).alias("branch"))
    )
    every = near.unionByName(seasonal).groupBy(site, target, "target_day", candidate, "day").agg(
        F.min("branch").alias("branch")
    )
    per_branch = every.groupBy(target, "branch").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(target).orderBy("branch").rowsBetween(Window.unboundedPreceding, -1)
    used = per_branch.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).where(
        (F.col("branch") == 0) | (F.col("_before") < pool)
    )
    return every.join(used.select(target, "branch"), [target, "branch"], "left_semi")


def snap_to_grid(value: Column, grid: Sequence[float]) -> Column:
    """Nearest value of a short grid; the smaller one on a tie, null for null."""
    marks = sorted(float(g) for g in grid)
    if len(marks) > 64:
        items = F.array(*[F.lit(g) for g in marks])
        return F.array_min(F.transform(items, lambda g: F.struct(F.abs(g - value).alias("d"), g.alias("g"))))["g"]
    out = F.when(value.isNull(), F.lit(None).cast("double"))
    for low, high in zip(marks, marks[1:]):
        out = out.when(value <= (low + high) / 2, F.lit(low))
    return out.otherwise(F.lit(marks[-1]))


def snap_to_grid_lookup(
    queries: DataFrame,
    bank: DataFrame,
    ident: str,
    n: int,
    tie: Column | None = None,
    seed: int = 0,
    max_grid: int = 10_000,
) -> DataFrame:
    """Bank rows on the grid wind and zenith nearest to a query, n closest in azimuth.

    ``queries`` has ident, wind, sza, raa; ``bank`` has id, wind, sza, raa. The grids are the few
    distinct wind and zenith values of the bank. Rows of one node are interchangeable, so at most n
    per node (by a seeded hash, or by ``tie``) take part; a ring has a bounded number of azimuths.
    """
    lists = {}
    for axis in ("wind", "sza"):
        found = bank.select(axis).distinct().limit(max_grid + 1).collect()
        if len(found) > max_grid:
            raise ValueError(f"{axis} of the bank is not on a grid")
        lists[axis] = [r[0] for r in found if r[0] is not None]
    q = queries.select(
        ident,
        F.col("raa").alias("_raa"),
        snap_to_grid(F.col("wind"), lists["wind"]).alias("wind"),
        snap_to_grid(F.col("sza"), lists["sza"]).alias("sza"),
    )
    order = F.xxhash64(F.col("id").cast("string"), F.lit(seed)) if tie is None else tie
    node = Window.partitionBy("wind", "sza", "raa").orderBy(order, "id")
    few = bank.withColumn("_tie", F.row_number().over(node)).where(F.col("_tie") <= n)
    # A query falls between two neighbouring azimuths of its ring; the n nearest are among the n on
    # either side. The arcs with their candidates are a table of the bank's size, not the queries'.
    ring = Window.partitionBy("wind", "sza")
    spots = bank.select("wind", "sza", "raa").distinct().select(
        "wind",
        "sza",
        "raa",
        (F.row_number().over(ring.orderBy("raa")) - 1).alias("_pos"),
        F.count(F.lit(1)).over(ring).alias("_m"),
        F.min("raa").over(ring).alias("_first"),
        F.lead("raa").over(ring.orderBy("raa")).alias("_next"),
    )
    arcs = spots.select(
        "wind", "sza", "_first", F.col("_pos").alias("_arc"), F.col("raa").alias("_lo"), F.coalesce("_next", F.col("_first") + 360.0).alias("_hi")
    )
    near = F.array_distinct(F.transform(F.sequence(F.lit(1 - n), F.lit(n)), lambda k: F.pmod(F.col("_pos") + k, F.col("_m"))))
    choices = (
        spots.select("wind", "sza", F.col("_pos").alias("_arc"), F.explode(near).alias("_pos"))
        .join(spots.select("wind", "sza", "_pos", "raa"), ["wind", "sza", "_pos"])
        .join(few, ["wind", "sza", "raa"])
        .drop("_pos")
    )
    around = F.pmod(F.col("_raa"), F.lit(360.0))
    turned = F.when(around < F.col("_first"), around + 360.0).otherwise(around)
    placed = q.join(arcs, ["wind", "sza"]).where((turned >= F.col("_lo")) & (turned < F.col("_hi")))
    joined = (
        placed.drop("_first", "_lo", "_hi")
        .join(choices, ["wind", "sza", "_arc"])
        .withColumn("gap", circular_diff(F.col("raa"), F.col("_raa")))
        .drop("_arc")
    )
    w = Window.partitionBy(ident).orderBy(F.round("gap", 9), "_tie", "id")
    return joined.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("_raa", "_tie")


def nearest_in_cells(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    dims: Sequence[str],
    distance: Column,
    k: int,
    start: float,
    extent: float,
    factor: float = 4.0,
) -> DataFrame:
    """Exact k nearest right items of every left point without comparing all with all.

    Left rows carry the coordinates in ``dims``; right rows carry a box ``<dim>_lo``, ``<dim>_hi``
    (equal for points). Both are cut into cells of growing size; a left point is settled once its
    k-th neighbour is no farther than the cell size, because everything that near lies in the
    neighbouring cells. A left point stays one row in its own cell, and right items come to the cells
    around theirs; pairs farther apart than the cell size settle nothing and are dropped at once. The
    loop ends when a cell spans the whole extent.
    """
    size = start
    open_rows = left
    settled = None
    while True:
        lc, rc = open_rows, right
        for dim in dims:
            lc = lc.withColumn(f"_c_{dim}", F.floor(F.col(dim) / size))
            low, high = F.floor(F.col(f"{dim}_lo") / size), F.floor(F.col(f"{dim}_hi") / size)
            rc = rc.withColumn(f"_c_{dim}", F.explode(F.sequence(low - 1, high + 1)))
        whole = size >= extent
        pairs = lc.join(rc, [f"_c_{d}" for d in dims])
        if not whole:
            pairs = pairs.where(distance <= size)
        pairs = pairs.groupBy(left_id, right_id).agg(F.min(distance).alias("distance"))
        w = Window.partitionBy(left_id).orderBy("distance", right_id)
        top = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        top = cut_lineage(top)
        if whole:
            fresh = top
        else:
            ready = top.groupBy(left_id).agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_d"))
            ready = ready.where((F.col("_n") >= k) & (F.col("_d") <= size)).select(left_id)
            fresh = top.join(ready, left_id, "left_semi")
        settled = fresh if settled is None else settled.unionByName(fresh)
        if whole:
            return settled
        open_rows = cut_lineage(open_rows.join(fresh.select(left_id).distinct(), left_id, "left_anti"))
        if open_rows.isEmpty():
            return settled
        size = size * factor


def knn_circular(queries: DataFrame, bank: DataFrame, ident: str, k: int) -> DataFrame:
    """k nearest bank nodes in standardised (zenith, sin and cos of azimuth, wind) space."""
    axes = {
        "z": F.col("sza"),
        "s": F.sin(F.radians("raa")),
        "c": F.cos(F.radians("raa")),
        "w": F.col("wind"),
    }
    stats = bank.agg(
        *[F.avg(e).alias(f"m_{n}") for n, e in axes.items()],
        *[F.stddev_pop(e).alias(f"s_{n}") for n, e in axes.items()],
    ).first()
    unit = {
        n: (e - F.lit(stats[f"m_{n}"])) / F.lit(stats[f"s_{n}"] if stats[f"s_{n}"] >= 1e-9 else 1.0)
        for n, e in axes.items()
    }
    q = queries.select(ident, *[e.alias(n) for n, e in unit.items()])
    nodes = bank.select("id", *[e.alias(f"{n}_lo") for n, e in unit.items()])
    nodes = nodes.select("*", *[F.col(f"{n}_lo").alias(f"{n}_hi") for n in axes])
    gap = F.sqrt(sum((F.pow(F.col(n) - F.col(f"{n}_lo"), 2) for n in axes), F.lit(0.0)))
    both = q.select(*axes).unionByName(nodes.select(*[F.col(f"{n}_lo").alias(n) for n in axes]))
    spans = both.agg(*[(F.max(n) - F.min(n)).alias(n) for n in axes]).first()
    extent = max([v for v in spans if v is not None], default=0.0)
    near = nearest_in_cells(q, nodes, ident, "id", list(axes), gap, k, start=0.75, extent=max(extent, 1.0))
    b = bank.select("id", F.col("sza").alias("_s"), F.col("raa").alias("_r"), F.col("wind").alias("_w"))
    out = near.join(b, "id").join(queries, ident)
    angle = F.hypot(circular_diff(F.col("_r"), F.col("raa")), F.col("_s") - F.col("sza"))
    return out.select(
        ident, "id", "rank", "distance", angle.alias("angular_gap"), F.abs(F.col("_w") - F.col("wind")).alias("wind_error")
    )


def _inside(ring: Column, lon: Column, lat: Column) -> Column:
    """Even-odd rule over the edges of one ring of (lon, lat) structs."""
    n = F.size(ring)

    def crossing(acc, i):
        p, q = F.get(ring, i), F.get(ring, (i + 1) % n)
        spans = (p["lat"] > lat) != (q["lat"] > lat)
        at = (q["lon"] - p["lon"]) * F.try_divide(lat - p["lat"], q["lat"] - p["lat"]) + p["lon"]
        return acc + F.when(spans & (lon < at), 1).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), crossing) % 2 == 1


def _ring_distance(ring: Column, lon: Column, lat: Column) -> Column:
    """Distance from a point to the nearest edge of a ring, in the unit of the coordinates."""
    n = F.size(ring)

    def edge(i):
        p, q = F.get(ring, i), F.get(ring, (i + 1) % n)
        dx, dy = q["lon"] - p["lon"], q["lat"] - p["lat"]
        t = F.coalesce(F.try_divide((lon - p["lon"]) * dx + (lat - p["lat"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        return F.hypot(lon - p["lon"] - t * dx, lat - p["lat"] - t * dy)

    return F.array_min(F.transform(F.sequence(F.lit(0), n - 1), edge))


def point_in_polygon_join(
    points: DataFrame, polygons: DataFrame, ident: str, name: str, cell: float = 10.0, extent: float = 360.0
) -> DataFrame:
    """Polygon that holds each point; the nearest polygon for points outside all of them.

    ``polygons`` has the name and ``ring array<struct<lon,lat>>``. Points and polygon boxes meet in
    grid cells; of several polygons the smallest name wins.
    """
    lons, lats = F.transform("ring", lambda p: p["lon"]), F.transform("ring", lambda p: p["lat"])
    boxes = polygons.select(
        name,
        "ring",
        F.array_min(lons).alias("lon_lo"),
        F.array_max(lons).alias("lon_hi"),
        F.array_min(lats).alias("lat_lo"),
        F.array_max(lats).alias("lat_hi"),
    )
    span = lambda d: F.explode(F.sequence(F.floor(F.col(f"{d}_lo") / cell), F.floor(F.col(f"{d}_hi") / cell)))
    tiles = boxes.withColumn("_cx", span("lon")).withColumn("_cy", span("lat"))
    placed = points.select(
        ident, "lon", "lat", F.floor(F.col("lon") / cell).alias("_cx"), F.floor(F.col("lat") / cell).alias("_cy")
    )
    in_box = (F.col("lon").between(F.col("lon_lo"), F.col("lon_hi"))) & (
        F.col("lat").between(F.col("lat_lo"), F.col("lat_hi"))
    )
    hits = (
        placed.join(tiles, ["_cx", "_cy"])
        .where(in_box)
        .where(_inside(F.col("ring"), F.col("lon"), F.col("lat")))
        .groupBy(ident)
        .agg(F.min(name).alias(name))
        .withColumn("distance", F.lit(0.0))
    )
    misses = points.select(ident, "lon", "lat").join(hits, ident, "left_anti")
    gap = _ring_distance(F.col("ring"), F.col("lon"), F.col("lat"))
    near = nearest_in_cells(misses, boxes, ident, name, ["lon", "lat"], gap, 1, cell, extent)
    return hits.unionByName(near.select(ident, name, "distance"))


def nearest_pixel_capped(
    sources: DataFrame, pixels: DataFrame, scene: str, source: str, cap: float = 0.05
) -> DataFrame:
    """Nearest pixel of a source in its scene when within the cap (degrees)."""
    around = sources.select(
        scene,
        source,
        F.col("lon").alias("_x"),
        F.col("lat").alias("_y"),
        F.explode(F.sequence(F.floor(F.col("lon") / cap) - 1, F.floor(F.col("lon") / cap) + 1)).alias("_cx"),
    ).withColumn("_cy", F.explode(F.sequence(F.floor(F.col("_y") / cap) - 1, F.floor(F.col("_y") / cap) + 1)))
    cells = pixels.withColumn("_cx", F.floor(F.col("lon") / cap)).withColumn("_cy", F.floor(F.col("lat") / cap))
    d2 = F.pow(F.col("lon") - F.col("_x"), 2) + F.pow(F.col("lat") - F.col("_y"), 2)
    joined = around.join(cells, [scene, "_cx", "_cy"]).withColumn("d2", d2).where(F.col("d2") <= cap * cap)
    best = F.min(F.struct("d2", "row", "col"))
    return joined.groupBy(scene, source).agg(best.alias("b")).select(scene, source, "b.row", "b.col", "b.d2")


def best_overlap(pairs: DataFrame, keys: Sequence[str], candidate: str) -> DataFrame:
    """Candidate with the largest IoU; the smallest id on ties."""
    top = F.min_by(F.struct(candidate, "iou"), F.struct(-F.col("iou"), F.col(candidate)))
    return pairs.groupBy(*keys).agg(top.alias("b")).select(*keys, f"b.{candidate}", "b.iou")


def bracket(axis: Column, x: Column) -> Column:
    """Linear interpolation along a short sorted array of (x, y) structs, clamped at the ends."""
    below = F.filter(axis, lambda p: p["x"] <= x)
    above = F.filter(axis, lambda p: p["x"] > x)
    lo, hi = F.try_element_at(below, F.lit(-1)), F.get(above, F.lit(0))
    f = (x - lo["x"]) / (hi["x"] - lo["x"])
    return F.when(lo.isNull(), hi["y"]).when(hi.isNull(), lo["y"]).otherwise(lo["y"] + f * (hi["y"] - lo["y"]))


def lut_bracket_join(df: DataFrame, lut: DataFrame, curve: Sequence[str], x: str, out: str) -> DataFrame:
    """Interpolate a look-up table of (curve..., x, y) at the x of every row, ends held.

    The table becomes segments; a row joins its curve by key and the one segment that holds its x.
    A curve has as many segments as its axis has steps, a few tens.
    """
    w = Window.partitionBy(*curve).orderBy("x")
    seg = lut.select(
        *curve,
        F.col("x").cast("double").alias("_x0"),
        F.col("y").cast("double").alias("_y0"),
        F.lead(F.col("x").cast("double")).over(w).alias("_x1"),
        F.lead(F.col("y").cast("double")).over(w).alias("_y1"),
        (F.row_number().over(w) == 1).alias("_first"),
    ).select(
        "*",
        F.when(F.col("_first"), F.lit(float("-inf"))).otherwise(F.col("_x0")).alias("_lo"),
        F.coalesce("_x1", F.lit(float("inf"))).alias("_hi"),
    )
    v = F.col(x).cast("double")
    held = F.least(F.greatest(v, F.col("_x0")), F.coalesce("_x1", "_x0"))
    slope = F.coalesce((F.col("_y1") - F.col("_y0")) / (F.col("_x1") - F.col("_x0")), F.lit(0.0))
    joined = df.join(seg, list(curve)).where((v >= F.col("_lo")) & (v < F.col("_hi")))
    return joined.withColumn(out, F.col("_y0") + (held - F.col("_x0")) * slope).drop(
        "_x0", "_y0", "_x1", "_y1", "_first", "_lo", "_hi"
    )


def hours_around(time: Column) -> tuple[Column, Column, Column]:
    """The hour before, the hour after and the fraction in between."""
    time = time.cast("timestamp")
    before = F.date_trunc("hour", time)
    after = before + F.expr("interval 1 hour")
    return before, after, (F.unix_micros(time) - F.unix_micros(before)) / F.lit(3.6e9)


def temporal_lerp(df: DataFrame, grid: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """Values interpolated between the two hourly rows around each time, with both neighbours kept."""
    before, after, frac = hours_around(F.col(time))
    base = df.select("*", before.alias("_h0"), after.alias("_h1"), frac.alias("frac"))
    g0 = grid.select(*keys, F.col("hour").alias("_h0"), *[F.col(v).alias(f"{v}_prev") for v in values])
    g1 = grid.select(*keys, F.col("hour").alias("_h1"), *[F.col(v).alias(f"{v}_next") for v in values])
    out = base.join(g0, [*keys, "_h0"]).join(g1, [*keys, "_h1"])
    for v in values:
        out = out.withColumn(v, F.col(f"{v}_prev") * (1 - F.col("frac")) + F.col(f"{v}_next") * F.col("frac"))
    return out.drop("_h0", "_h1")


def asof_variants(df: DataFrame, value: str, published: str) -> DataFrame:
    """Median absolute difference to a published value of four ways to pick the hour."""
    from plumeline.operators.spread import percentiles

    near = F.when(F.col("frac") < 0.5, F.col(f"{value}_prev")).otherwise(F.col(f"{value}_next"))
    ways = {"prev": F.col(f"{value}_prev"), "next": F.col(f"{value}_next"), "nearest": near, "interp": F.col(value)}
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("variant"), F.abs(c - F.col(published)).alias("gap")) for n, c in ways.items()])
        ).alias("v")
    ).select("v.*")
    return percentiles(long, ["variant"], "gap", {"median_gap": 0.5})


def key_date_lookup(df: DataFrame, table: DataFrame, ident: str, key: str, slots: Sequence[str], value: str) -> DataFrame:
    """Look a value up by (key, date) for every slot, back to one row per sample."""
    long = df.select(
        ident,
        key,
        F.explode(F.array(*[F.struct(F.lit(i + 1).alias("slot"), F.col(s).alias("day")) for i, s in enumerate(slots)])).alias("s"),
    ).select(ident, key, "s.*")
    hit = long.join(table.select(key, "day", value), [key, "day"], "left")
    return hit.groupBy(ident).agg(
        *[F.max(F.when(F.col("slot") == i + 1, F.col(value))).alias(f"{value}{i + 1}") for i in range(len(slots))]
    )


def slot_replacement(
    slots: DataFrame, candidates: DataFrame, ident: str, bad: Column, order: Sequence[Column]
) -> DataFrame:
    """Bad slots of a sample filled in slot order by its best ranked candidates, as many as it has."""
    ws = Window.partitionBy(ident).orderBy("slot")
    wc = Window.partitionBy(ident).orderBy(*order)
    need = slots.where(F.coalesce(bad, F.lit(False))).withColumn("_n", F.row_number().over(ws)).select(ident, "slot", "_n")
    have = candidates.withColumn("_n", F.row_number().over(wc))
    return need.join(have, [ident, "_n"]).drop("_n")


def pair_mates(pairs: DataFrame, scene: str, a: str, b: str) -> DataFrame:
    """Both directions of a pair list; ``entries`` above one marks a duplicate, an error upstream."""
    one = pairs.select(scene, F.lit("a").alias("side"), F.col(a).alias("plume"), F.lit("b").alias("mate_side"), F.col(b).alias("mate"))
    two = pairs.select(scene, F.lit("b").alias("side"), F.col(b).alias("plume"), F.lit("a").alias("mate_side"), F.col(a).alias("mate"))
    return one.unionByName(two).groupBy(scene, "side", "plume").agg(
        F.min("mate_side").alias("mate_side"), F.min("mate").alias("mate"), F.count(F.lit(1)).alias("entries")
    )


def pair_mate_join(plumes: DataFrame, mates: DataFrame, orphans: DataFrame, scene: str) -> DataFrame:
    """Pair, orphan or nothing for every plume, with its mate."""
    keys = [scene, "side", "plume"]
    marked = orphans.select(*keys).distinct().withColumn("_orphan", F.lit(True))
    out = plumes.join(mates, keys, "left").join(marked, keys, "left")
    kind = F.when(F.col("mate").isNotNull(), "pair").when(F.col("_orphan"), "orphan")
    return out.withColumn("match", kind).drop("_orphan", "entries")


def alignment_gaps(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys missing on either side; both zero when a key join replaces row positions safely."""
    keys = [key] if isinstance(key, str) else list(key)
    return a.select(*keys, F.lit(1).alias("s")).unionByName(b.select(*keys, F.lit(2).alias("s"))).groupBy(*keys).agg(
        F.bit_or("s").alias("c")
    ).agg(F.count_if(F.col("c") == 1).alias("only_a"), F.count_if(F.col("c") == 2).alias("only_b"))


def experiment_grid(df: DataFrame, axes: Mapping[str, Sequence]) -> DataFrame:
    """Every row of a table of cases with every combination of a few named settings."""
    for name, values in axes.items():
        df = df.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return df


def granule_metadata_lookup(df: DataFrame, scenes: DataFrame, group: Sequence[str], day: str, values: Sequence[str]) -> DataFrame:
    """Metadata by exact date, the scene table first cut to each group's date range."""
    spans = df.groupBy(*group).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    near = scenes.join(spans, list(group)).where(F.col(day).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    return df.join(near.select(*group, day, *values), [*group, day], "left")
