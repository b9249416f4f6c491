"""Plume injection over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumeline.functions.angles import scale_to_rate
from plumeline.operators import inject as I
from plumeline.operators.spectral import CONFIGS
from plumeline.plans import fixtures as fx
from plumeline.plans.queries_aggs import rounded
from plumeline.plans.queries_joins import bank
from plumeline.plans.queries_pixels import GEO, geo
from plumeline.plans.queries_select import DRAW
from plumeline.plans.queries_spectral import TEMPLATE, WAVELENGTHS, cube
from plumeline.plans.registry import query


def patches(spark, d):
    k = F.col("s_suppkey")
    return fx.table(spark, d, "supplier").select(
        k.alias("patch"), (60 + k % 70).cast("int").alias("height"), (64 + k % 50).cast("int").alias("width"), (1 + k % 6).cast("int").alias("n")
    )


@query("place_sources")
def place_sources(spark, d):
    return I.place_sources(patches(spark, d), seed=2)


@query("resolve_wind")
def resolve_wind(spark, d):
    s = I.place_sources(patches(spark, d), seed=2)
    e = fx.table(spark, d, "events").groupBy((F.col("user_id") % 100).alias("patch")).agg(
        (F.avg("value") / 10).alias("u"), (F.avg(F.col("value") * (F.col("event_id") % 2)) / 10).alias("v")
    )
    spots = s.select("patch", "row", "col").distinct().withColumn("_k", F.pmod("patch", F.lit(100)))
    wind = spots.join(e.withColumnRenamed("patch", "_k"), "_k").select("patch", "row", "col", (F.col("u") + F.col("row") * 0.01).alias("u"), "v")
    sun = patches(spark, d).select("patch", (F.col("patch") % 60).cast("double").alias("sza"), (F.col("patch") * 3.3).alias("saa"))
    return rounded(I.resolve_wind(s, wind, sun, bank(spark, d)))


@query(
    "emission_rates",
    f"""SELECT l_orderkey, l_linenumber, round(500 + {DRAW.format("l_orderkey || '-' || l_linenumber || '-6'")} / 4294967296.0 * 9500, 6) AS rate, 10000.0 :: DOUBLE AS fixed FROM lineitem""",
)
def emission_rates(spark, d):
    key = [F.col("l_orderkey"), F.col("l_linenumber")]
    return rounded(
        fx.table(spark, d, "lineitem").select(
            *key, I.emission_rate(key, 6, 500.0, 10000.0).alias("rate"), I.emission_rate(key, 6, 500.0, 10000.0, fixed=25000.0).alias("fixed")
        )
    )


def _shape(spark, d):
    return fx.spectra(spark, d).groupBy("scene").agg((F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width"))


def _plumes(spark, d):
    """One plume per scene, its map one of the simulated volumes."""
    s = fx.spectra(spark, d).select("scene").distinct()
    return s.select(
        "scene",
        F.lit(0).alias("plume"),
        F.lit(3).alias("row"),
        F.lit(4).alias("col"),
        (F.col("scene") * 37.0 + 12).alias("direction"),
        F.col("scene").cast("bigint").alias("map"),
        F.lit(25.0).alias("source_row"),
        F.lit(10.0).alias("source_col"),
    )


def _maps(spark, d):
    v = fx.voxels(spark, d).groupBy(F.col("volume").alias("map"), "row", "col").agg(F.sum("ppb").alias("ppb"))
    return v


def _grid(spark, d):
    return geo(spark, d).select(
        "scene", "row", "col", (F.col("scene") + F.col("col") * F.lit(0.0006) + F.col("row") * F.lit(0.0001)).alias("lon"),
        (40 - F.col("row") * F.lit(0.0005) + F.col("col") * F.lit(0.0001)).alias("lat"),
    )


def _footprints(spark, d):
    return I.footprint_average(_grid(spark, d), _shape(spark, d), _plumes(spark, d), _maps(spark, d), n_sub=4)


@query("footprint_average")
def footprint_average(spark, d):
    return rounded(_footprints(spark, d), 4)


def _grad_sql(v, axis):
    return f"coalesce(({axis}n.{v} - {axis}p.{v}) / 2, {axis}n.{v} - g.{v}, g.{v} - {axis}p.{v})"


@query(
    "pixel_area",
    f"""WITH {GEO}, o AS (SELECT scene, avg(lon) AS x0, avg(lat) AS y0 FROM geo GROUP BY scene),
      g0 AS (SELECT scene, row, col, radians(lon - x0) * cos(radians((lat + y0) / 2)) * 6378137.0 / sqrt(1 - 0.00669437999014 * pow(sin(radians(y0)), 2)) AS e,
        radians(lat - y0) * 6378137.0 * (1 - 0.00669437999014) / pow(1 - 0.00669437999014 * pow(sin(radians(y0)), 2), 1.5) AS n FROM geo JOIN o USING (scene))
    SELECT g.scene, g.row, g.col, round(abs({_grad_sql('e', 'c')} * {_grad_sql('n', 'r')} - {_grad_sql('e', 'r')} * {_grad_sql('n', 'c')}), 2) AS area_m2 FROM g0 g
      LEFT JOIN g0 rn ON rn.scene = g.scene AND rn.col = g.col AND rn.row = g.row + 1 LEFT JOIN g0 rp ON rp.scene = g.scene AND rp.col = g.col AND rp.row = g.row - 1
      LEFT JOIN g0 cn ON cn.scene = g.scene AND cn.row = g.row AND cn.col = g.col + 1 LEFT JOIN g0 cp ON cp.scene = g.scene AND cp.row = g.row AND cp.col = g.col - 1""",
)
def pixel_area(spark, d):
    return rounded(I.pixel_area(geo(spark, d).select("scene", "row", "col", "lon", "lat")), 2)


@query(
    "inpaint_null",
    f"""WITH {fx.SPECTRA}, v AS (SELECT scene, row, col, CASE WHEN (row * 10 + col) % 4 > 0 OR col > 6 THEN spectrum[1] :: DOUBLE END AS v FROM spectra)
    SELECT a.scene, a.row, a.col, round(coalesce(any_value(a.v), avg(b.v)), 6) AS v FROM v a LEFT JOIN v b ON b.scene = a.scene AND abs(b.row - a.row) <= 1 AND abs(b.col - a.col) <= 1 AND b.v IS NOT NULL GROUP BY a.scene, a.row, a.col""",
)
def inpaint_null(spark, d):
    keep = ((F.col("row") * 10 + F.col("col")) % 4 > 0) | (F.col("col") > 6)
    v = fx.spectra(spark, d).select("scene", "row", "col", F.when(keep, F.get("spectrum", F.lit(0)).cast("double")).alias("v"))
    return rounded(I.inpaint_null(v, "v"))


@query(
    "accumulate_plumes",
    f"""WITH {fx.VOXELS}, r AS (SELECT DISTINCT volume % 3 AS scene, volume AS plume, 1000 + volume * 170.0 :: DOUBLE AS rate FROM voxels)
    SELECT volume % 3 AS scene, row, col, round(sum(ppb * rate / 3000), 3) AS ppb FROM voxels JOIN r ON plume = volume GROUP BY ALL""",
)
def accumulate_plumes(spark, d):
    v = fx.voxels(spark, d).select((F.col("volume") % 3).alias("scene"), F.col("volume").alias("plume"), "row", "col", "ppb")
    rates = v.select("scene", "plume").distinct().withColumn("rate", 1000 + F.col("plume") * 170.0)
    return rounded(I.accumulate_plumes(v, rates), 3)


LUT = """bands AS (SELECT DISTINCT p_size AS band, (2000 + p_size * 7.4) :: DOUBLE AS centre, 8.5 :: DOUBLE AS fwhm FROM part),
  lut AS (SELECT w AS k, (2010 + w * 0.9) :: DOUBLE AS wavelength, 0.9 :: DOUBLE AS step FROM range(0, 380) t(w))"""


def _bands(spark, d):
    b = fx.table(spark, d, "part").select(F.col("p_size").alias("band")).distinct()
    return b.select("band", (2000 + F.col("band") * F.lit(7.4)).alias("centre"), F.lit(8.5).alias("fwhm"))


def _lut_wavelengths(spark):
    return spark.range(380).select((2010 + F.col("id") * F.lit(0.9)).alias("wavelength"), F.lit(0.9).alias("step"))


@query(
    "srf_weights",
    f"""WITH {LUT}, s AS (SELECT *, 8.5 / (2 * sqrt(2 * ln(2.0))) AS sg FROM bands),
      w AS (SELECT band, wavelength, exp(-0.5 * pow((wavelength - centre) / sg, 2)) * step AS w FROM s JOIN lut ON wavelength >= centre - 5 * sg AND wavelength < centre + 5 * sg AND wavelength < 2010 + 379 * 0.9)
    SELECT band, round(wavelength, 4) AS wavelength, round(w / sum(w) OVER (PARTITION BY band), 8) AS weight FROM w""",
)
def srf_weights(spark, d):
    w = I.srf_weights(_bands(spark, d), _lut_wavelengths(spark))
    return w.select("band", F.round("wavelength", 4).alias("wavelength"), F.round("weight", 8).alias("weight"))


def _injected(spark, d):
    """Radiance of the pixel table after adding the simulated maps to every scene."""
    waves = _lut_wavelengths(spark)
    scenes = fx.spectra(spark, d).select("scene").distinct()
    ratios = F.array(*[F.lit(float(x)) for x in (0, 500, 1800, 2500, 4000, 8000)])
    depth = (1 + F.sin(F.col("wavelength") / 9.0)) * 2e-5 * (1 + F.col("scene") * 0.1)
    steps = F.explode(F.sequence(F.lit(0), F.lit(379)))
    lut = scenes.select("scene", steps.alias("k")).select("scene", (2010 + F.col("k") * F.lit(0.9)).alias("wavelength"))
    lut = lut.select("scene", "wavelength", F.explode(ratios).alias("mr")).withColumn("t", F.exp(-depth * F.col("mr")))
    background = scenes.withColumn("mr0", F.lit(1900.0))
    factors = I.band_factors(lut, I.srf_weights(_bands(spark, d), waves), background)
    radiance = fx.pixels(spark, d).select("scene", "row", "col", "band", "value")
    return I.inject_radiance(radiance, _footprints(spark, d), factors, background)


@query("inject_radiance")
def inject_radiance(spark, d):
    return rounded(_injected(spark, d), 6)


@query("retrieve_after_injection")
def retrieve_after_injection(spark, d):
    c = cube(spark, d).select("scene", "row", "col", "spectrum")
    changed = c.where("row between 1 and 4 and col between 2 and 5").withColumn(
        "spectrum", F.zip_with("spectrum", F.array(*[F.lit(t) for t in TEMPLATE]), lambda v, t: v * (1 + 0.02 * t))
    )
    patch = c.select("scene").distinct().select(
        "scene", F.lit(1).alias("row_off"), F.lit(2).alias("col_off"), F.lit(4).alias("height"), F.lit(4).alias("width")
    )
    out = I.retrieve_after_injection(c, changed, patch, TEMPLATE, list(CONFIGS), wavelengths=WAVELENGTHS, alpha=0.05)
    return out.select("method", "scene", "row", "col", F.round("enhancement", 3).alias("enhancement"))


@query(
    "truth_mask",
    f"""WITH {fx.VOXELS} SELECT volume, row, col, round(sum(ppb) * 1000 / 3000, 6) AS ppb FROM voxels GROUP BY ALL HAVING sum(ppb) * 1000 / 3000 >= 20""",
)
def truth_mask(spark, d):
    v = fx.voxels(spark, d).groupBy("volume", "row", "col").agg(scale_to_rate(F.sum("ppb"), F.lit(1000.0)).alias("ppb"))
    return rounded(I.truth_mask(v), 6)
