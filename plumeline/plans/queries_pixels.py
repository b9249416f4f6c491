"""Masks, windows and raster operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.operators import joins as J
from plumeline.operators import pixels as P
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import FILLED, filled, rounded
from plumeline.plans.queries_joins import matched
from plumeline.plans.queries_select import DRAW
from plumeline.plans.registry import query

SIDE = 12

GRIDPX = """gridpx AS (SELECT l_suppkey AS scene, CAST(l_partkey % 12 AS INT) AS row, CAST(l_quantity AS INT) % 12 AS col,
   max(CASE WHEN l_returnflag = 'A' AND l_discount > 0.08 THEN 1 ELSE 0 END) AS plume, max(CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN 1 ELSE 0 END) AS cloud,
   max(CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN 1 ELSE 0 END) AS nodata FROM lineitem GROUP BY ALL)"""


def gridpx(spark, d):
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    disc, tax = F.col("l_discount"), F.col("l_tax")
    return (
        fx.table(spark, d, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("scene"),
            (F.col("l_partkey") % 12).cast("int").alias("row"),
            (F.col("l_quantity").cast("int") % 12).alias("col"),
        )
        .agg(
            flag((F.col("l_returnflag") == "A") & (disc > 0.08)).alias("plume"),
            flag((disc == 0.1) & (tax == 0.08)).alias("cloud"),
            flag((F.col("l_linenumber") == 7) & (tax == 0)).alias("nodata"),
        )
    )


def shape(spark, d):
    return fx.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("scene"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width")
    )


@query("mask_nodata", f"WITH {FILLED} SELECT scene, band, l_quantity, CASE WHEN isnan(value) OR value <= -9990 THEN -9999.0 ELSE value END AS value FROM filled")
def mask_nodata(spark, d):
    return filled(spark, d).select("scene", "band", "l_quantity", P.mask_nodata(F.col("value")).alias("value"))


@query(
    "decode_bit",
    f"""WITH {fx.MASKS}, bits AS (SELECT scene, row, col, bit_or(CAST(1 AS BIGINT) << (plume - 1)) AS m FROM masks GROUP BY ALL)
    SELECT scene, row, col, (m >> 2) & 1 = 1 AS third, m < 0 AS last FROM bits""",
)
def decode_bit(spark, d):
    bits = fx.masks(spark, d).groupBy("scene", "row", "col").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(plume - 1 as int))")).alias("m")
    )
    return bits.select(
        "scene", "row", "col", P.decode_bit(F.col("m"), 3).alias("third"), P.decode_bit(F.col("m"), 64).alias("last")
    )


@query(
    "mask_union_dilate",
    f"""WITH {fx.MASKS}, m AS (SELECT DISTINCT scene, row, col FROM masks),
      o AS (SELECT a.i AS dr, b.i AS dc FROM range(-2, 3) a(i), range(-2, 3) b(i))
    SELECT DISTINCT scene, CAST(row + dr AS INT) AS row, CAST(col + dc AS INT) AS col FROM m CROSS JOIN o WHERE row + dr BETWEEN 0 AND 11 AND col + dc BETWEEN 0 AND 11""",
)
def mask_union_dilate(spark, d):
    m = fx.masks(spark, d)
    return P.mask_union_dilate([m.where("side = 'a'"), m.where("side = 'b'")], shape(spark, d), 2)


@query(
    "tile_grid",
    """WITH s AS (SELECT s_suppkey AS scene, 10 + s_suppkey % 7 AS h, 9 + s_suppkey % 5 AS w FROM supplier)
    SELECT scene, size, CAST(i * size AS INT) AS row_off, CAST(j * size AS INT) AS col_off FROM s, (SELECT unnest([4, 6]) AS size), range(0, 10) a(i), range(0, 10) b(j)
    WHERE i * size + size <= h AND j * size + size <= w""",
)
def tile_grid(spark, d):
    k = F.col("s_suppkey")
    s = fx.table(spark, d, "supplier").select(
        k.alias("scene"), (10 + k % 7).cast("int").alias("height"), (9 + k % 5).cast("int").alias("width")
    )
    return P.tile_grid(s, [4, 6])


TILES = f"""{GRIDPX}, tiles AS (SELECT scene, size, CAST(row // size * size AS INT) AS row_off, CAST(col // size * size AS INT) AS col_off, round_even(avg(plume), 4) AS plume_share, round_even(avg(cloud), 4) AS cloud_share,
   round_even(avg(nodata), 4) AS nodata_share FROM gridpx CROSS JOIN (SELECT unnest([2, 5]) AS size) WHERE row // size * size + size <= 12 AND col // size * size + size <= 12 GROUP BY ALL),
  valid AS (SELECT *, plume_share = 0 AND cloud_share = 0 AND nodata_share = 0 AS valid FROM tiles)"""


def tiles(spark, d):
    flags = {f"{n}_share": F.col(n) == 1 for n in ("plume", "cloud", "nodata")}
    return P.injectable_tiles(gridpx(spark, d), shape(spark, d), [2, 5], flags)


@query("injectable_tiles", f"WITH {TILES} SELECT * FROM valid")
def injectable_tiles(spark, d):
    return tiles(spark, d)


@query(
    "tile_windows_column",
    f"""WITH {TILES}, l AS (SELECT s_suppkey AS scene, size, list({{'col_off': col_off, 'row_off': row_off, 'width': size, 'height': size}} ORDER BY col_off, row_off) FILTER (valid) AS w FROM supplier LEFT JOIN valid ON scene = s_suppkey GROUP BY ALL)
    SELECT scene, coalesce(len(max(w) FILTER (size = 2)), 0) :: INTEGER AS n_windows_2, coalesce(len(max(w) FILTER (size = 5)), 0) :: INTEGER AS n_windows_5,
      coalesce(max(w) FILTER (size = 2)[1].col_off, -1) AS first_col, coalesce(max(w) FILTER (size = 2)[-1].row_off, -1) AS last_row FROM l GROUP BY scene""",
)
def tile_windows_column(spark, d):
    out = P.tile_windows_column(shape(spark, d), tiles(spark, d), [2, 5])
    return out.select(
        "scene",
        "n_windows_2",
        "n_windows_5",
        F.coalesce(F.get("windows_2", F.lit(0))["col_off"], F.lit(-1)).alias("first_col"),
        F.coalesce(F.try_element_at("windows_2", F.lit(-1))["row_off"], F.lit(-1)).alias("last_row"),
    )


BOXES = f"""{fx.MASKS}, lows AS (SELECT scene, plume, CAST(min(row) AS INT) * 3 AS row0, CAST(min(col) AS INT) * 3 AS col0 FROM masks WHERE side = 'a' GROUP BY scene, plume),
  boxes AS (SELECT *, row0 + 2 + plume AS row1, col0 + 3 + plume AS col1 FROM lows)"""


def boxes(spark, d):
    m = fx.masks(spark, d).where("side = 'a'").groupBy("scene", "plume").agg(
        (F.min("row") * 3).alias("row0"), (F.min("col") * 3).alias("col0")
    )
    return m.select("*", (F.col("row0") + 2 + F.col("plume")).alias("row1"), (F.col("col0") + 3 + F.col("plume")).alias("col1"))


@query(
    "aligned_plume_windows",
    f"""WITH {BOXES} SELECT scene, plume, row0, col0, row1, col1, 12 AS size, CAST(r AS INT) AS row_off, CAST(c AS INT) AS col_off FROM boxes, range(0, 37, 12) a(r), range(0, 37, 12) b(c)
    WHERE r + 12 <= 40 AND c + 12 <= 40 AND r <= row0 - 1 AND r + 11 >= row1 + 1 AND c <= col0 - 1 AND c + 11 >= col1 + 1""",
)
def aligned_plume_windows(spark, d):
    s = shape(spark, d).select("scene", F.lit(40).alias("height"), F.lit(40).alias("width"))
    return P.aligned_plume_windows(boxes(spark, d), s, 12, margin=1)


@query(
    "fraction_in_window",
    f"""WITH {GRIDPX}, w AS (SELECT p_partkey AS window, p_partkey % 100 AS scene, p_size % 8 AS r, p_size % 7 AS c, 3 + p_size % 2 AS h, 4 AS w FROM part)
    SELECT w.scene, w.window, round(avg(plume), 6) AS fraction FROM w JOIN gridpx g ON g.scene = w.scene AND g.row >= r AND g.row < r + h AND g.col >= c AND g.col < c + w GROUP BY ALL""",
)
def fraction_in_window(spark, d):
    s = F.col("p_size")
    w = fx.table(spark, d, "part").select(
        F.col("p_partkey").alias("window"),
        (F.col("p_partkey") % 100).alias("scene"),
        (s % 8).alias("row_off"),
        (s % 7).alias("col_off"),
        (3 + s % 2).alias("height"),
        F.lit(4).alias("width"),
    )
    return rounded(P.fraction_in_window(gridpx(spark, d), w, F.col("plume") == 1, cell=6))


@query(
    "random_patch_pick",
    f"WITH {TILES} SELECT scene, size, row_off, col_off FROM valid WHERE valid ORDER BY "
    + DRAW.format("concat_ws('-', scene, size, row_off, col_off, 4)")
    + ", scene, size, row_off, col_off LIMIT 7",
)
def random_patch_pick(spark, d):
    return P.random_patch_pick(tiles(spark, d), 4, 7).select("scene", "size", "row_off", "col_off")


@query(
    "chip_crop",
    f"""WITH {fx.MASKS} SELECT scene, greatest(min(row) - 2, 0) AS row0, least(max(row) + 3, 12) AS row1, greatest(min(col) - 2, 0) AS col0, least(max(col) + 3, 12) AS col1
    FROM (SELECT scene * 100 + plume AS scene, row, col FROM masks WHERE side = 'a') GROUP BY scene""",
)
def chip_crop(spark, d):
    # A chip per plume of side a.
    m = fx.masks(spark, d).where("side = 'a'").withColumn("plume_scene", F.col("scene") * 100 + F.col("plume"))
    shapes = m.select("scene", "plume_scene").distinct().join(shape(spark, d), "scene").drop("scene").withColumnRenamed("plume_scene", "scene")
    return P.chip_crop(m.drop("scene").withColumnRenamed("plume_scene", "scene"), shapes, 2)


@query(
    "paint_by_area",
    f"""WITH {fx.MASKS}, o AS (SELECT * FROM masks WHERE side = 'a'), ar AS (SELECT scene, plume, count(*) AS area FROM o GROUP BY ALL),
      b AS (SELECT scene, row, col, plume AS code FROM o JOIN ar USING (scene, plume) QUALIFY row_number() OVER (PARTITION BY scene, row, col ORDER BY area, plume DESC) = 1),
      z AS (SELECT DISTINCT x.scene, x.row, x.col FROM o x JOIN o y ON x.scene = y.scene AND x.row = y.row AND x.col = y.col AND x.plume = 1 AND y.plume = 2)
    SELECT scene, row, col, CASE WHEN z.scene IS NOT NULL THEN 9 ELSE code END AS code FROM b LEFT JOIN z USING (scene, row, col)""",
)
def paint_by_area(spark, d):
    o = fx.masks(spark, d).where("side = 'a'").drop("side")
    codes = o.select("scene", "plume").distinct().withColumn("code", F.col("plume"))
    zones = o.select("scene").distinct().select("scene", F.lit(1).alias("plume_a"), F.lit(2).alias("plume_b"), F.lit(9).alias("code"))
    return P.paint_by_area(o, codes, zones)


@query("instance_codes")
def instance_codes(spark, d):
    m = fx.masks(spark, d)
    a, b = m.where("side = 'a'"), m.where("side = 'b'")
    inner = lambda t: J.self_overlap_pairs(t).where("inter >= 4")
    names = lambda t: t.select("scene", "plume").distinct()
    return P.instance_codes(names(a), names(b), matched(spark, d), inner(a), inner(b))


@query(
    "alpha_to_mask",
    """SELECT l_orderkey AS scene, l_partkey AS row, l_suppkey AS col FROM lineitem WHERE l_linenumber = 4 AND l_quantity = 25""",
)
def alpha_to_mask(spark, d):
    t = fx.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("scene"),
        F.col("l_partkey").alias("row"),
        F.col("l_suppkey").alias("col"),
        F.col("l_linenumber").alias("band"),
        (F.col("l_quantity") + 230).alias("value"),
    )
    return P.alpha_to_mask(t)


@query(
    "pixel_iou",
    f"""WITH {fx.MASKS}, a AS (SELECT DISTINCT scene, (plume + 1) // 2 AS pair, row, col FROM masks WHERE side = 'a'), b AS (SELECT DISTINCT scene, plume AS pair, row, col FROM masks WHERE side = 'b')
    SELECT scene, pair, count(*) FILTER (a.row IS NOT NULL AND b.row IS NOT NULL) AS inter, count(*) AS union, count(a.row) AS area_a, count(b.row) AS area_b,
      round(count(*) FILTER (a.row IS NOT NULL AND b.row IS NOT NULL) / count(*), 8) AS iou
    FROM (SELECT *, row AS r, col AS c FROM a) a FULL JOIN (SELECT *, row AS r, col AS c FROM b) b USING (scene, pair, r, c) GROUP BY ALL""",
)
def pixel_iou(spark, d):
    m = fx.masks(spark, d).withColumnRenamed("plume", "code")
    pair = F.when(F.col("side") == "a", F.expr("cast((code + 1) div 2 as int)")).otherwise(F.col("code"))
    wanted = m.select("scene", "side", pair.alias("pair"), "code").distinct()
    return rounded(P.code_iou(m.where("side = 'a'").drop("side"), m.where("side = 'b'").drop("side"), wanted, fx.line_parts(spark, d)), 8)


@query(
    "ghost_sources",
    f"""WITH {fx.MASKS} SELECT DISTINCT scene, plume AS code FROM masks WHERE side = 'a' AND (scene, plume) NOT IN (SELECT (scene, plume) FROM masks WHERE side = 'b' AND row > 9 AND col > 6)""",
)
def ghost_sources(spark, d):
    m = fx.masks(spark, d).withColumnRenamed("plume", "code")
    return P.ghost_sources(m.where("side = 'a'"), m.where("side = 'b' and row > 9 and col > 6"))


@query(
    "bearing_plume_vs_wind",
    f"""WITH {fx.POINTS}, c AS (SELECT country AS scene, avg(lon) AS x, avg(lat) AS y, count(*) AS n FROM points GROUP BY 1),
      s AS (SELECT n_nationkey AS scene, n_nationkey * 3.1 - 40 AS lon, n_nationkey * 1.7 - 20 AS lat, 2.5 - n_nationkey % 6 AS u, n_nationkey % 4 - 1.3 AS v FROM nation),
      b AS (SELECT s.scene, (degrees(atan2((x - lon) * cos(radians(lat)), y - lat)) + 360) % 360 AS p, (degrees(atan2(u, v)) + 360) % 360 AS w FROM s JOIN c USING (scene) WHERE n >= 30)
    SELECT scene, round(p, 5) AS plume_bearing, round(w, 5) AS wind_bearing, round(least((p - w + 720) % 360, 360 - (p - w + 720) % 360), 5) AS difference FROM b""",
)
def bearing_plume_vs_wind(spark, d):
    n = F.col("n_nationkey")
    s = fx.table(spark, d, "nation").select(
        n.alias("scene"), (n * 3.1 - 40).alias("lon"), (n * 1.7 - 20).alias("lat"), (2.5 - n % 6).alias("u"), (n % 4 - 1.3).alias("v")
    )
    plume = fx.points(spark, d).select(F.col("country").alias("scene"), "lon", "lat")
    return rounded(P.plume_bearing(plume, s), 5)


GEO = f"""{fx.SPECTRA}, geo AS (SELECT scene, row, col, 10 + col * 0.01 + row * 0.002 + scene AS lon, 40 - row * 0.01 + col * 0.003 AS lat, spectrum[1] * 10 AS u, spectrum[2] * 10 AS v FROM spectra)"""


def geo(spark, d):
    r, c = F.col("row"), F.col("col")
    return fx.spectra(spark, d).select(
        "scene",
        "row",
        "col",
        (10 + c * F.lit(0.01) + r * F.lit(0.002) + F.col("scene")).alias("lon"),
        (40 - r * F.lit(0.01) + c * F.lit(0.003)).alias("lat"),
        (F.get("spectrum", F.lit(0)).cast("double") * 10).alias("u"),
        (F.get("spectrum", F.lit(1)).cast("double") * 10).alias("v"),
    )


@query(
    "rotate_wind_to_sensor",
    f"""WITH {GEO}, g AS (SELECT a.scene, avg(a.lat) AS lat, avg(b.lon - a.lon) AS cx, avg(b.lat - a.lat) AS cn, avg(c.lon - a.lon) AS rx, avg(c.lat - a.lat) AS rn, avg(a.u :: DOUBLE) AS u, avg(a.v :: DOUBLE) AS v
      FROM geo a LEFT JOIN geo b ON b.scene = a.scene AND b.row = a.row AND b.col = a.col + 1 LEFT JOIN geo c ON c.scene = a.scene AND c.col = a.col AND c.row = a.row + 1 GROUP BY a.scene),
      s AS (SELECT *, cx * cos(radians(lat)) AS ce, rx * cos(radians(lat)) AS re FROM g)
    SELECT scene, round((u * ce + v * cn) / sqrt(ce * ce + cn * cn), 5) AS along_col, round((u * re + v * rn) / sqrt(re * re + rn * rn), 5) AS along_row,
      round((degrees(atan2(ce, cn)) + 360) % 360, 5) AS col_bearing FROM s""",
)
def rotate_wind_to_sensor(spark, d):
    return rounded(P.rotate_wind_to_sensor(geo(spark, d)), 5)


@query(
    "resample_mean",
    f"WITH {fx.PIXELS} SELECT scene, band, CAST(row // 2 AS INT) AS row, CAST(col // 2 AS INT) AS col, round(avg(value), 6) AS value FROM pixels GROUP BY ALL",
)
def resample_mean(spark, d):
    return rounded(P.resample_mean(fx.pixels(spark, d), 2))


@query(
    "percentile_stretch",
    f"""WITH {fx.PIXELS}, m AS (SELECT scene, band, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM pixels GROUP BY ALL)
    SELECT scene, band, row, col, round(CASE WHEN hi > lo THEN least(greatest((value - lo) / (hi - lo), 0), 1) ELSE 0 END, 6) AS stretched FROM pixels JOIN m USING (scene, band)""",
)
def percentile_stretch(spark, d):
    out = P.percentile_stretch(fx.pixels(spark, d), ["scene", "band"], "value")
    return rounded(out.select("scene", "band", "row", "col", "stretched"))


NODES = """nodes AS (SELECT l_linenumber AS scene, CAST(l_quantity AS INT) % 5 AS gx, CAST(l_partkey % 6 AS INT) AS gy, avg(l_extendedprice) / 1000 AS value FROM lineitem GROUP BY ALL),
  asks AS (SELECT c_custkey AS id, CAST(1 + c_custkey % 7 AS INT) AS scene, c_custkey % 113 / 20.0 - 0.713 AS x, c_custkey % 131 / 20.0 - 0.907 AS y FROM customer),
  cl AS (SELECT id, scene, least(greatest(x, 0), 4) AS x, least(greatest(y, 0), 5) AS y FROM asks),
  cr AS (SELECT id, scene, CAST(least(floor(x) + a, 4) AS INT) AS gx, CAST(least(floor(y) + b, 5) AS INT) AS gy, (CASE WHEN a = 1 THEN x - floor(x) ELSE 1 - x + floor(x) END) * (CASE WHEN b = 1 THEN y - floor(y) ELSE 1 - y + floor(y) END) AS w
    FROM cl, range(0, 2) t(a), range(0, 2) u(b))"""


def _nodes(spark, d):
    return (
        fx.table(spark, d, "lineitem")
        .groupBy(
            F.col("l_linenumber").alias("scene"),
            (F.col("l_quantity").cast("int") % 5).alias("gx"),
            (F.col("l_partkey") % 6).cast("int").alias("gy"),
        )
        .agg((F.avg("l_extendedprice") / 1000).alias("value"))
    )


def _asks(spark, d):
    k = F.col("c_custkey")
    return fx.table(spark, d, "customer").select(
        k.alias("id"), (1 + k % 7).cast("int").alias("scene"), (k % 113 / F.lit(20.0) - 0.713).alias("x"), (k % 131 / F.lit(20.0) - 0.907).alias("y")
    )


@query("gather_bilinear", f"WITH {NODES} SELECT scene, id, round(sum(w * value), 6) AS value FROM cr LEFT JOIN nodes USING (scene, gx, gy) WHERE w > 0 GROUP BY ALL")
def gather_bilinear(spark, d):
    out = P.gather_bilinear(_asks(spark, d), _nodes(spark, d), ["scene"], ["id"], F.col("x"), F.col("y"), 5, 6)
    return rounded(out.select("scene", "id", "value"))


@query(
    "interp_nodes_to_pixels",
    f"""WITH {NODES}, h AS (SELECT scene, id, w, value FROM cr LEFT JOIN (SELECT * FROM nodes WHERE (gx + gy) % 5 > 0) USING (scene, gx, gy) WHERE w > 0)
    SELECT scene, id, round(CASE WHEN bool_and(value IS NOT NULL) THEN sum(w * value) ELSE arg_max(value, w) FILTER (value IS NOT NULL) END, 6) AS value FROM h GROUP BY ALL""",
)
def interp_nodes_to_pixels(spark, d):
    grid = _nodes(spark, d).where("(gx + gy) % 5 > 0")
    out = P.interp_nodes_to_pixels(_asks(spark, d), grid, ["scene"], ["id"], F.col("x"), F.col("y"), 5, 6)
    return rounded(out)


REFS = f"""{fx.SPECTRA}, refs AS (SELECT a.scene, a.row, a.col, a.mask, list_transform(a.spectrum, lambda x: x :: DOUBLE + 1) AS t, list_transform(b.spectrum, lambda x: x :: DOUBLE + 1) AS r
  FROM spectra a JOIN spectra b ON b.scene = (a.scene + 1) % 5 AND b.row = a.row AND b.col = a.col)"""


def refs(spark, d):
    """Target pixels with the pixel of the next scene as reference."""
    s = fx.spectra(spark, d)
    shift = lambda c: F.transform(c, lambda x: x.cast("double") + 1)
    t = s.select("scene", "row", "col", "mask", shift("spectrum").alias("t"))
    r = s.select(((F.col("scene") + 4) % 5).alias("scene"), "row", "col", shift("spectrum").alias("r"))
    return t.join(r, ["scene", "row", "col"])


@query(
    "band_ratio_pairs",
    f"""WITH {REFS}, q AS (SELECT scene, mask, CAST(i AS INT) AS i, CAST(j AS INT) AS j, t[i + 1] / t[j + 1] - r[i + 1] / r[j + 1] AS d, (t[i + 1] / t[j + 1]) / (r[i + 1] / r[j + 1]) AS q FROM refs, range(0, 64) a(i), range(0, 64) b(j) WHERE i <> j)
    SELECT scene, i, j, round(abs(avg(d) FILTER (mask = 1) - avg(d) FILTER (mask = 0)) / stddev_pop(d) FILTER (mask = 0), 6) AS raw,
      round(abs(avg(q) FILTER (mask = 1) - avg(q) FILTER (mask = 0)) / stddev_pop(q) FILTER (mask = 0), 6) AS normalised FROM q GROUP BY ALL""",
)
def band_ratio_pairs(spark, d):
    return rounded(P.band_ratio_pairs(refs(spark, d), "scene", "t", "r", F.col("mask") == 1, 64))


@query(
    "band_stat_contrast",
    f"""WITH {fx.PIXELS} SELECT scene, band, round(abs(avg(value) FILTER (mask = 1) - avg(value) FILTER (mask = 0)) / stddev_pop(value) FILTER (mask = 0), 6) AS snr,
      round(avg(value) FILTER (mask = 1) - avg(value) FILTER (mask = 0), 6) AS difference, count(*) FILTER (mask = 1) AS n_plume, count(*) FILTER (mask = 0) AS n_background FROM pixels GROUP BY ALL""",
)
def band_stat_contrast(spark, d):
    return rounded(P.band_stat_contrast(fx.pixels(spark, d), ["scene", "band"], F.col("value"), F.col("mask") == 1))


@query(
    "random_mask_control",
    f"""WITH {fx.PIXELS}, mk AS (SELECT DISTINCT scene, row, col FROM pixels WHERE row BETWEEN 1 AND 3 AND col BETWEEN 2 AND 4), hw AS (SELECT scene, max(row) + 1 AS h, max(col) + 1 AS w FROM pixels GROUP BY 1),
      bx AS (SELECT scene, min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM mk GROUP BY 1),
      sh AS (SELECT scene, k, -r0 + {DRAW.format("scene || '-' || k || '-r-8'")} % (h - r1 + r0) AS dy, -c0 + {DRAW.format("scene || '-' || k || '-c-8'")} % (w - c1 + c0) AS dx FROM bx JOIN hw USING (scene), range(0, 9) t(k)),
      mv AS (SELECT mk.scene, k, row + dy AS row, col + dx AS col FROM mk JOIN sh USING (scene)),
      st AS (SELECT p.scene, p.band, s.k, count(mv.row) AS np, count(*) - count(mv.row) AS nb, abs(avg(value) FILTER (mv.row IS NOT NULL) - avg(value) FILTER (mv.row IS NULL)) / stddev_pop(value) FILTER (mv.row IS NULL) AS snr
        FROM pixels p JOIN (SELECT DISTINCT scene, k FROM sh) s USING (scene) LEFT JOIN mv ON mv.scene = p.scene AND mv.k = s.k AND mv.row = p.row AND mv.col = p.col GROUP BY ALL)
    SELECT scene, band, count(*) AS n, round(min(snr), 6) AS lowest, round(max(snr), 6) AS highest, round(quantile_cont(snr, 0.5), 6) AS median FROM st WHERE np >= 5 AND nb >= 20 GROUP BY ALL""",
)
def random_mask_control(spark, d):
    p = fx.pixels(spark, d)
    mask = fx.spectra(spark, d).where("row between 1 and 3 and col between 2 and 4").select("scene", "row", "col").distinct()
    size = fx.spectra(spark, d).groupBy("scene").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))
    boxed = mask.groupBy("scene").agg(
        F.min("row").alias("row0"), F.max("row").alias("row1"), F.min("col").alias("col0"), F.max("col").alias("col1")
    )
    shifts = P.random_placements(boxed.join(size, "scene"), "height", "width", 9, 8)
    return rounded(P.random_mask_control(p, mask, shifts))


@query(
    "mask_hole_compare",
    f"""WITH RECURSIVE {fx.MASKS}, m AS (SELECT DISTINCT CAST(scene AS INT) AS scene, row, col FROM masks WHERE side = 'a'), b AS (SELECT scene, min(row) - 1 AS r0, max(row) + 1 AS r1, min(col) - 1 AS c0, max(col) + 1 AS c1 FROM m GROUP BY scene),
      g AS (SELECT scene, CAST(r AS INT) AS row, CAST(c AS INT) AS col, r = r0 OR r = r1 OR c = c0 OR c = c1 AS rim FROM b, range(-1, 13) x(r), range(-1, 13) y(c) WHERE r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1),
      e AS (SELECT g.* FROM g LEFT JOIN m USING (scene, row, col) WHERE m.scene IS NULL),
      f AS (SELECT scene, row, col FROM e WHERE rim UNION SELECT e.scene, e.row, e.col FROM f JOIN e ON e.scene = f.scene AND abs(e.row - f.row) + abs(e.col - f.col) = 1)
    SELECT b.scene, (SELECT count(*) FROM e WHERE e.scene = b.scene) - (SELECT count(*) FROM f WHERE f.scene = b.scene) AS hole_pixels FROM b""",
)
def mask_hole_compare(spark, d):
    m = fx.masks(spark, d).where("side = 'a'").select(F.col("scene").cast("int").alias("scene"), "row", "col").distinct()
    return P.mask_holes(m, ["scene"]).select("scene", "hole_pixels")


@query(
    "mask_bbox_scan_all_null",
    f"WITH {FILLED} SELECT scene, band, l_quantity FROM filled GROUP BY ALL HAVING bool_and(isnan(value) OR value <= -9990)",
)
def mask_bbox_scan_all_null(spark, d):
    return P.all_null_ids(filled(spark, d), ["scene", "band", "l_quantity"], "value")


@query(
    "empty_leaf_detect",
    """WITH s AS (SELECT l_orderkey AS leaf, min(l_discount) AS lo, max(l_discount) AS hi, 100.0 AS valid, sum(l_extendedprice) AS bytes FROM lineitem GROUP BY 1)
    SELECT leaf, (lo = 0 AND hi = 0 AND valid >= 99) OR bytes < 30000 AS empty FROM s""",
)
def empty_leaf_detect(spark, d):
    s = fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("leaf")).agg(
        F.min("l_discount").alias("lo"), F.max("l_discount").alias("hi"), F.sum("l_extendedprice").alias("bytes")
    )
    return s.select("leaf", P.empty_leaf(F.col("lo"), F.col("hi"), F.lit(100.0), F.col("bytes")).alias("empty"))


@query("coverage_fraction", f"WITH {FILLED} SELECT scene, band, round(avg(CASE WHEN isnan(value) THEN 0 ELSE 1 END), 8) AS coverage FROM filled GROUP BY ALL")
def coverage_fraction(spark, d):
    return rounded(P.coverage_fraction(filled(spark, d), ["scene", "band"], "value"), 8)
