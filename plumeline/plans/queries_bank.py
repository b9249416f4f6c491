"""Simulated volumes over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import bank as B
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.registry import ORACLE, query
from plumeline.session import cut_lineage

# The fixture volumes: 51 rows, 40 columns, levels 1 to 7.
DOMAIN = B.Domain(ny=51, nx=40, nz=7, relax=2, window=10, interior_from=8, pixel_m=20.0)
COARSE = dict(shift_m=900.0)

NODES = """ring AS (SELECT i AS ring, degrees(atan(i * 900.0 / 330)) AS sza, CASE WHEN i = 0 THEN 1 ELSE CAST(round_even(360 / degrees(2 * asin(1 / (2.0 * i))), 0) AS INT) END AS n FROM range(0, {k}) t(i)),
  nodes AS (SELECT ring, sza, j * 360.0 / n AS raa, row_number() OVER (ORDER BY ring, j) - 1 AS node FROM ring, range(0, 60) u(j) WHERE j < n)""".format(k=3)


@query(
    "sun_nodes",
    """WITH r AS (SELECT i AS ring, degrees(atan(i * 60.0 / 330)) AS sza, CASE WHEN i = 0 THEN 1 ELSE CAST(round_even(360 / degrees(2 * asin(1 / (2.0 * i))), 0) AS INT) END AS n FROM range(0, 17) t(i))
    SELECT s_nationkey AS country, ring :: INTEGER AS ring, round(sza, 6) AS sza, sum(n) :: BIGINT AS nodes FROM supplier CROSS JOIN r GROUP BY s_nationkey, ring, sza""",
)
def sun_nodes(spark, d):
    n = B.with_sun_nodes(fx.table(spark, d, "supplier").select(F.col("s_nationkey").alias("country")))
    return n.groupBy("country", "ring", F.round("sza", 6).alias("sza")).agg(F.count("*").alias("nodes"))


@query(
    "cross_join_nodes",
    """WITH r AS (SELECT i AS ring, degrees(atan(i * 60.0 / 330)) AS sza, CASE WHEN i = 0 THEN 1 ELSE CAST(round_even(360 / degrees(2 * asin(1 / (2.0 * i))), 0) AS INT) END AS n FROM range(0, 17) t(i)),
      nd AS (SELECT ring, sza, j * 360.0 / n AS raa FROM r, range(0, 200) u(j) WHERE j < n)
    SELECT s_suppkey AS plume, count(*) AS rows, round(sum(sza), 4) AS sza, round(sum(raa), 4) AS raa FROM supplier CROSS JOIN nd GROUP BY 1""",
)
def cross_join_nodes(spark, d):
    n = B.with_sun_nodes(fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("plume")))
    return n.groupBy("plume").agg(
        F.count("*").alias("rows"), F.round(F.sum("sza"), 4).alias("sza"), F.round(F.sum("raa"), 4).alias("raa")
    )


@query(
    "source_box_center",
    """SELECT p_partkey, (p_size + p_size + p_partkey % 6) * 0.5 :: DOUBLE AS center_row, (p_size % 7 + p_size % 7 + 3) * 0.5 :: DOUBLE AS center_col, p_partkey % 6 + 1 AS height_px, 4 AS width_px FROM part""",
)
def source_box_center(spark, d):
    s, k = F.col("p_size"), F.col("p_partkey")
    t = fx.table(spark, d, "part").select("p_partkey", s.alias("r0"), (s + k % 6).alias("r1"), (s % 7).alias("c0"), (s % 7 + 3).alias("c1"))
    return B.source_box_center(t, "r0", "r1", "c0", "c1").drop("r0", "r1", "c0", "c1")


@query("volume_to_column", f"WITH {fx.VOXELS} SELECT volume, row, col, round(sum(ppb) * 0.5, 6) AS ppb FROM voxels GROUP BY ALL")
def volume_to_column(spark, d):
    return rounded(B.volume_to_column(fx.voxels(spark, d), F.lit(0.5)))


PROJECTED = f"""{fx.VOXELS}, {NODES}, sh AS (SELECT v.volume, node, sza, raa, v.row, v.col, ppb, level * tan(radians(sza)) * cos(radians(raa + 180)) AS x, level * tan(radians(sza)) * sin(radians(raa + 180)) AS y, 1 / cos(radians(sza)) AS a FROM voxels v CROSS JOIN nodes),
  pr AS (SELECT volume, node, sza, raa, row + floor(y) + dy AS row, col + floor(x) + dx AS col, ppb * a / (a + 1) * (CASE WHEN dx = 1 THEN x - floor(x) ELSE 1 - x + floor(x) END) * (CASE WHEN dy = 1 THEN y - floor(y) ELSE 1 - y + floor(y) END) AS v FROM sh, range(0, 2) t(dx), range(0, 2) u(dy)
    UNION ALL SELECT volume, node, sza, raa, row, col, ppb / (a + 1) FROM sh),
  maps AS (SELECT volume, node, sza, raa, CAST(row AS INT) AS row, CAST(col AS INT) AS col, sum(v) AS ppb FROM pr GROUP BY ALL)"""


def projected(spark, d):
    return B.project_volume(fx.voxels(spark, d), B.sun_nodes(spark, **COARSE), DOMAIN.nz)


@query(
    "project_volume",
    f"WITH {PROJECTED} SELECT volume, node, round(sum(ppb), 2) AS mass, round(sum(ppb * row), 0) AS row_moment, round(sum(ppb * col), 0) AS col_moment, round(max(ppb), 5) AS peak FROM maps GROUP BY volume, node",
)
def project_volume(spark, d):
    v = F.col("ppb")
    return projected(spark, d).groupBy("volume", F.col("node").cast("bigint").alias("node")).agg(
        F.round(F.sum(v), 2).alias("mass"),
        F.round(F.sum(v * F.col("row")), 0).alias("row_moment"),
        F.round(F.sum(v * F.col("col")), 0).alias("col_moment"),
        F.round(F.max(v), 5).alias("peak"),
    )


@query(
    "threshold_and_crop",
    f"""WITH {fx.VOXELS}, m AS (SELECT volume, row, col, sum(ppb) AS v FROM voxels GROUP BY ALL),
      c AS (SELECT volume, v, sum(v) OVER (PARTITION BY volume ORDER BY v) AS c, sum(v) OVER (PARTITION BY volume) AS t FROM m WHERE v > 0),
      t AS (SELECT volume, least(0.5 * max(v), min(CASE WHEN c > 0.05 * t THEN v END)) AS threshold FROM c GROUP BY volume)
    SELECT volume, round(threshold, 5) AS threshold, round(max(v), 5) AS peak, round(sum(v), 2) AS mass_before, round(sum(v) FILTER (v >= threshold), 2) AS mass_after,
      min(row) FILTER (v >= threshold) AS row0, max(row) FILTER (v >= threshold) AS row1, min(col) FILTER (v >= threshold) AS col0, max(col) FILTER (v >= threshold) AS col1 FROM m JOIN t USING (volume) GROUP BY volume, threshold""",
)
def threshold_and_crop(spark, d):
    column = B.volume_to_column(fx.voxels(spark, d))
    _, stats = B.threshold_and_crop(column, ["volume"], budget=0.05, cap=0.5)
    r = lambda c, n: F.round(c, n).alias(c)
    return stats.select("volume", r("threshold", 5), r("peak", 5), r("mass_before", 2), r("mass_after", 2), "row0", "row1", "col0", "col1")


SOURCES = """src AS (SELECT s_suppkey AS volume, 20.0 + s_suppkey % 9 AS center_row, 14.0 + s_suppkey % 5 AS center_col, 3 AS width_px FROM supplier WHERE s_suppkey < 10)"""


def sources(spark, d):
    """One source per volume; volumes are the distinct values of the voxel key."""
    v = fx.table(spark, d, "lineitem").select((F.col("l_suppkey") % 10).alias("volume")).distinct()
    k = F.col("volume")
    return v.select("volume", (20.0 + k % 9).alias("center_row"), (14.0 + k % 5).alias("center_col"), F.lit(3).alias("width_px"))


@query(
    "snapshot_measures",
    f"""WITH {fx.VOXELS}, {SOURCES}, a AS (SELECT volume, row, col, sum(ppb) AS v FROM voxels GROUP BY ALL),
      p AS (SELECT s.volume, s.center_col, c.col, coalesce(max(v), 0) AS top, count(*) FILTER (row BETWEEN 2 AND 48 AND c.col BETWEEN 2 AND 37 AND v > 50) AS wide, coalesce(sum(v) FILTER (row BETWEEN 2 AND 48 AND c.col BETWEEN 2 AND 37), 0) AS mass,
        coalesce(max(v) FILTER (row = 2), 0) AS lo, coalesce(max(v) FILTER (row = 48), 0) AS hi FROM src s CROSS JOIN range(0, 40) c(col) LEFT JOIN a ON a.volume = s.volume AND a.col = c.col GROUP BY ALL),
      h AS (SELECT volume, sum(level * 20.0 * m) / sum(m) AS z FROM (SELECT volume, level, sum(ppb) AS m FROM voxels WHERE row BETWEEN 2 AND 48 AND col BETWEEN 2 AND 37 GROUP BY ALL) GROUP BY volume)
    SELECT p.volume, round(max(top), 5) AS peak, round(max(top) FILTER (col = 2), 5) AS edge_upwind, round(max(top) FILTER (col = 37), 5) AS edge_downwind, round(max(lo) FILTER (col BETWEEN 2 AND 37), 5) AS edge_bottom,
      round(max(hi) FILTER (col BETWEEN 2 AND 37), 5) AS edge_top, round(min(top) FILTER (col >= 8 AND col < 28), 5) AS interior_min, round(regr_slope(ln(greatest(top, 1e-3)), col) FILTER (col BETWEEN 28 AND 37), 6) AS slope,
      max(wide) * 20.0 :: DOUBLE AS width_max_m, max(wide) FILTER (col = 37) * 20.0 :: DOUBLE AS width_edge_m,
      round(sum(mass) FILTER (col >= 2 AND col <= floor(center_col - 1.5 - 5)) / count(*) FILTER (col >= 2 AND col <= floor(center_col - 1.5 - 5)) * 36 / sum(mass), 6) AS foreign_share, round(any_value(z), 5) AS mean_height_m
    FROM p JOIN h USING (volume) GROUP BY p.volume""",
)
def snapshot_measures(spark, d):
    m = B.snapshot_measures(fx.voxels(spark, d), sources(spark, d), DOMAIN)
    six = ("slope", "foreign_share")
    return rounded(m.select(*[F.round(c, 6 if c in six else 5).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes]))


@query(
    "volume_criteria",
    f"""WITH m AS ({ORACLE['snapshot_measures']}), c AS (SELECT *, slope < 0 AND edge_downwind < interior_min AS fades_out, edge_upwind < 0.02 * peak AS entry_ok, edge_top < 0.02 * peak AND edge_bottom < 0.02 * peak AS lateral_ok,
      coalesce(foreign_share < 0.002, false) AS foreign_ok, width_edge_m <= 60 AS width_ok, greatest(edge_upwind, edge_downwind, edge_top, edge_bottom) / peak AS edge FROM m)
    SELECT volume, round(edge, 4) AS edge_share, round(edge_upwind / peak, 4) AS upwind_share, round(edge_downwind / peak, 4) AS downwind_share, edge > 0.05 AS touches_edge,
      fades_out, entry_ok, lateral_ok, foreign_ok, width_ok, fades_out AND entry_ok AND lateral_ok AND foreign_ok AND width_ok AS passes FROM c""",
)
def volume_criteria(spark, d):
    c = B.volume_criteria(B.snapshot_measures(fx.voxels(spark, d), sources(spark, d), DOMAIN))
    shares = [F.round(n, 4).alias(n) for n in ("edge_share", "upwind_share", "downwind_share")]
    return c.select("volume", *shares, "touches_edge", "fades_out", "entry_ok", "lateral_ok", "foreign_ok", "width_ok", "passes")


@query(
    "volume_metrics",
    f"""WITH {fx.VOXELS}, {SOURCES}, v AS (SELECT v.*, (col - center_col) * 20 AS x, (row - center_row) * 20 AS y, level * 20.0 - 10 AS z FROM voxels v JOIN src USING (volume) WHERE row BETWEEN 2 AND 48 AND col BETWEEN 2 AND 37),
      s AS (SELECT volume, sum(ppb) AS t, sum(ppb * x) / sum(ppb) AS cx, sum(ppb * y) / sum(ppb) AS cy, sum(ppb * z) / sum(ppb) AS cz, sum(ppb * x * x) / sum(ppb) AS x2, sum(ppb * z * z) / sum(ppb) AS z2, max(ppb) AS pk, arg_max(level, ppb) AS pl, arg_max(x, ppb) AS px, arg_max(y, ppb) AS py, count(*) AS n,
        max(z) FILTER (ppb > 50) - min(z) FILTER (ppb > 50) AS hz FROM v GROUP BY volume),
      c AS (SELECT volume, (max(col) - min(col)) * 20.0 :: DOUBLE AS len FROM (SELECT volume, row, col, sum(ppb) AS p FROM v GROUP BY ALL HAVING sum(ppb) > 50) GROUP BY volume)
    SELECT volume, round(cx, 4) AS center_downwind_m, round(cy, 4) AS center_crosswind_m, round(cz, 4) AS mean_height_m, round(sqrt(x2 - cx * cx), 4) AS sigma_downwind_m, round(sqrt(z2 - cz * cz), 4) AS sigma_vertical_m,
      len AS length_m, coalesce(hz + 20, 0) :: DOUBLE AS height_m, round(t, 3) AS ime_ppb_px, round(pk, 5) AS peak_voxel_ppb, pl AS peak_level, round(px, 4) AS peak_downwind_m, round(py, 4) AS peak_crosswind_m, round(t / 1e9 * 360550.0 * 400, 4) AS mass_total_mol, round(1 - n / (7.0 * 47 * 36), 8) AS zeros_share FROM s JOIN c USING (volume)""",
)
def volume_metrics(spark, d):
    v = fx.voxels(spark, d)
    heights = v.select("volume", "level").distinct().select("volume", "level", (F.col("level") * 20.0 - 10).alias("z"))
    m = B.volume_metrics(v, sources(spark, d), heights, DOMAIN)
    digits = {"ime_ppb_px": 3, "peak_voxel_ppb": 5, "zeros_share": 8}
    m = m.drop("sigma_crosswind_m")
    return m.select(*[F.round(c, digits.get(c, 4)).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


@query("snapshot_selection")
def snapshot_selection(spark, d):
    t = fx.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("run"), (F.col("l_quantity") + 60).cast("int").alias("snap"), "l_discount", "l_tax"
    )
    return B.snapshot_selection(t, ["run"], "snap", (F.col("l_discount") > 0.09) & (F.col("l_tax") == 0))


@query("bank_row_table")
def bank_row_table(spark, d):
    maps = cut_lineage(projected(spark, d))
    _, stats = B.threshold_and_crop(maps, ["volume", "node"])
    uid = F.format_string("a%d_w03.0_s080", F.col("volume") + 1)
    nodes = B.sun_nodes(spark, **COARSE)
    return rounded(B.bank_row_table(stats, sources(spark, d).withColumn("uid", uid), nodes, DOMAIN), 4)


@query(
    "snapshot_universe",
    """SELECT l_suppkey AS emitter, snap FROM (SELECT DISTINCT l_suppkey FROM lineitem) CROSS JOIN (SELECT unnest([60, 70, 80, 90, 100, 110]) AS snap)
       UNION SELECT l_suppkey, CAST(l_quantity AS INT) + 60 FROM lineitem""",
)
def snapshot_universe(spark, d):
    t = fx.table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "emitter")
    used = t.select("emitter", (F.col("l_quantity").cast("int") + 60).alias("snap"))
    return B.snapshot_universe(t.select("emitter").distinct(), list(range(60, 120, 10)), used)
