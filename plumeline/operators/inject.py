"""Putting simulated plumes into scenes: placement, wind, footprint, radiance."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.functions.angles import BANK_RATE_KG_H, relative_azimuth_math
from plumeline.functions.draws import draw, uniform
from plumeline.operators.aggs import is_fill
from plumeline.operators.joins import bracket, snap_to_grid_lookup
from plumeline.session import cut_lineage

# Fixed values.
EDGE_MARGIN = 10
MIN_SEPARATION = 15
MAX_ATTEMPTS = 1000
#: Tries per source in the first batch; each later batch has twice as many.
FIRST_TRIES = 4
TRUTH_PPB = 20.0
SRF_SIGMAS = 5.0
FWHM_TO_SIGMA = 1.0 / (2.0 * math.sqrt(2.0 * math.log(2.0)))
WGS84_A = 6_378_137.0
WGS84_E2 = 0.00669437999014


def place_sources(
    patches: DataFrame,
    seed: int,
    margin: int = EDGE_MARGIN,
    separation: float = MIN_SEPARATION,
    attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Random source pixels per patch (patch, height, width, n), kept apart and off the rim.

    Candidates come from a seeded digest and are taken in order while they keep the distance, so a
    patch may end with fewer sources than asked. At most ``n * attempts`` are tried.

    A candidate's fate hangs on earlier ones nearby only, so all places are decided at once: of the
    candidates still open, those without an earlier open one in reach are taken, what lies in their
    reach is dropped, and so on. Tries come in growing batches, each first held against the sources a
    patch already has, until every patch has its number. Neighbours meet in grid cells as wide as the
    separation; a crowded patch is never gathered.
    """
    inside = patches.where((F.col("height") > 2 * margin) & (F.col("width") > 2 * margin)).select("patch", "height", "width", "n")
    span = lambda size: (F.col(size) - 2 * margin).cast("bigint")
    place = lambda axis, size: (F.pmod(draw(F.col("patch"), F.col("i"), axis, seed), span(size)) + margin).cast("int")
    wanting, taken, done, step = inside.where("n > 0"), None, 0, FIRST_TRIES
    while done < attempts:
        last = min(done + step, attempts)
        tries = wanting.withColumn("i", F.explode(F.sequence(F.col("n").cast("bigint") * done + 1, F.col("n").cast("bigint") * last)))
        tries = tries.select("patch", "i", place("r", "height").alias("row"), place("c", "width").alias("col"))
        if taken is not None:
            tries = _clear_of(tries, taken, separation)
        found = _first_apart(tries, separation)
        taken = found if taken is None else cut_lineage(taken.unionByName(found))
        full = taken.groupBy("patch").agg(F.count(F.lit(1)).alias("_k"))
        wanting = cut_lineage(inside.join(full, "patch", "left").where(F.coalesce("_k", F.lit(0)) < F.col("n")).drop("_k"))
        if wanting.isEmpty():
            break
        done, step = last, 2 * step
    if taken is None:
        return inside.select("patch", F.lit(0).alias("source"), F.lit(0).alias("row"), F.lit(0).alias("col")).where("false")
    order = F.row_number().over(Window.partitionBy("patch").orderBy("i")) - 1
    ranked = taken.withColumn("source", order).join(inside.select("patch", "n"), "patch")
    return ranked.where(F.col("source") < F.col("n")).select("patch", "source", "row", "col")


def _clear_of(points: DataFrame, others: DataFrame, separation: float, earlier: bool = False) -> DataFrame:
    """The points without another of ``others`` in reach; with ``earlier``, of those tried before them."""
    size = math.ceil(separation)
    cell = lambda c: F.floor(F.col(c) / size)
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    near = others.select(F.col("patch").alias("_patch"), F.col("i").alias("_i"), F.col("row").alias("_row"), F.col("col").alias("_col"), F.explode(steps).alias("_s"))
    # Nine rows each, which the optimizer's sizes don't count: never whole in one task or at the driver.
    near = near.select("_patch", "_i", "_row", "_col", (cell("_row") + F.col("_s.a")).alias("_cr"), (cell("_col") + F.col("_s.b")).alias("_cc")).hint("merge")
    here = points.withColumn("_r", cell("row")).withColumn("_c", cell("col"))
    meet = (F.col("patch") == F.col("_patch")) & (F.col("_r") == F.col("_cr")) & (F.col("_c") == F.col("_cc"))
    close = F.hypot(F.col("row") - F.col("_row"), F.col("col") - F.col("_col")) < separation
    return here.join(near, meet & close & ((F.col("_i") < F.col("i")) if earlier else F.lit(True)), "left_anti").drop("_r", "_c")


def _first_apart(points: DataFrame, separation: float) -> DataFrame:
    """What a walk in the order of ``i`` would take: each point that keeps the distance to all taken before it."""
    taken, left = None, cut_lineage(points)
    while not left.isEmpty():
        first = cut_lineage(_clear_of(left, left, separation, earlier=True))
        taken = first if taken is None else taken.unionByName(first)
        left = cut_lineage(_clear_of(left, first, separation))
    return taken if taken is not None else left


def resolve_wind(sources: DataFrame, wind: DataFrame, sun: DataFrame, bank: DataFrame) -> DataFrame:
    """Wind at every source, its relative azimuth, and a different bank plume per source of a patch.

    ``sources`` has patch, source, row, col; ``wind`` patch, row, col, u, v; ``sun`` patch, sza, saa.
    Every source brings as many of its nearest bank rows as the fullest patch has sources; in source
    order each takes the first that is still free. Null only where its node has fewer rows than that.
    """
    most = sources.groupBy("patch").count().agg(F.max("count")).first()[0] or 1
    at = sources.join(wind, ["patch", "row", "col"]).join(sun, "patch")
    speed = F.hypot("u", "v")
    heading = F.pmod(F.degrees(F.atan2("v", "u")), F.lit(360.0))
    at = at.select("patch", "source", "row", "col", "sza", speed.alias("wind"), heading.alias("direction"),
                   relative_azimuth_math(F.col("saa"), heading).alias("raa"))
    q = at.withColumn("key", F.struct("patch", "source").cast("string")).select("key", "wind", "sza", "raa")
    near = snap_to_grid_lookup(q, bank, "key", most)
    lists = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("options"))
    ready = at.withColumn("key", F.struct("patch", "source").cast("string")).join(lists, "key")
    seq = F.array_sort(F.collect_list(F.struct("source", "options")))
    kind = ready.schema["options"].dataType.elementType["id"].dataType.simpleString()
    state = F.struct(F.array().cast(f"array<{kind}>").alias("ids"))

    def pick(s, x):
        free = F.filter(x["options"], lambda o: ~F.array_contains(s["ids"], o["id"]))
        return F.struct(F.concat(s["ids"], F.array(F.get(free, F.lit(0))["id"])).alias("ids"))

    chosen = ready.groupBy("patch").agg(F.array_sort(F.collect_list("source")).alias("_s"), F.aggregate(seq, state, pick)["ids"].alias("_i"))
    ids = chosen.select("patch", F.explode(F.arrays_zip("_s", "_i")).alias("z")).select("patch", F.col("z._s").alias("source"), F.col("z._i").alias("bank_id"))
    return at.join(ids, ["patch", "source"])


def emission_rate(key: Sequence[Column], seed: int, low: float, high: float, fixed: float | None = None) -> Column:
    """Fixed rate held under the maximum, or a uniform draw per plume."""
    if fixed is not None:
        return F.lit(min(fixed, high))
    return F.lit(low) + uniform(*key, seed) * (high - low)


def pixel_corners(grid: DataFrame, shape: DataFrame) -> DataFrame:
    """Corner grid (height + 1 by width + 1) from pixel centres (scene, row, col, lon, lat).

    An inner corner is the mean of its four centres; rim corners continue the two next to them.
    """
    spots = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in (0, 1) for b in (0, 1)])
    inner = (
        grid.select("scene", "row", "col", "lon", "lat", F.explode(spots).alias("s"))
        .groupBy("scene", (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"))
        .agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count(F.lit(1)).alias("_n"))
        .where("_n = 4")
        .drop("_n")
    )

    def extend(corners, axis, other, size):
        c = corners.join(shape.select("scene", F.col(size).alias("_h")), "scene")
        # With three or fewer inner lines one line can serve both ends.
        near_ends = F.array(*[F.when(F.col(axis) == 1, F.lit(0)), F.when(F.col(axis) == F.col("_h") - 1, F.col("_h"))])
        far_ends = F.array(*[F.when(F.col(axis) == 2, F.lit(0)), F.when(F.col(axis) == F.col("_h") - 2, F.col("_h"))])
        pick = lambda ends, tag: c.select(
            "scene", F.explode(ends).alias("_e"), other, F.col("lon").alias(f"lon{tag}"), F.col("lat").alias(f"lat{tag}")
        ).where("_e is not null")
        rim = pick(near_ends, 1).join(pick(far_ends, 2), ["scene", "_e", other])
        ext = rim.select(
            "scene",
            F.col("_e").alias(axis),
            other,
            (2 * F.col("lon1") - F.col("lon2")).alias("lon"),
            (2 * F.col("lat1") - F.col("lat2")).alias("lat"),
        )
        return corners.unionByName(ext.select(*corners.columns))

    return extend(extend(inner, "row", "col", "height"), "col", "row", "width")


def local_metres(lon: Column, lat: Column, lon0: Column, lat0: Column) -> tuple[Column, Column]:
    """East and north in metres from a nearby origin on the ellipsoid."""
    s = F.sin(F.radians(lat0))
    w = 1 - WGS84_E2 * s * s
    east = F.radians(lon - lon0) * F.cos(F.radians((lat + lat0) / 2)) * WGS84_A / F.sqrt(w)
    north = F.radians(lat - lat0) * WGS84_A * (1 - WGS84_E2) / F.pow(w, F.lit(1.5))
    return east, north


def footprint_average(
    grid: DataFrame, shape: DataFrame, plumes: DataFrame, bank: DataFrame, n_sub: int = 4, pixel_m: float = 20.0
) -> DataFrame:
    """Bank maps averaged over the footprint of every sensor pixel they touch.

    ``plumes`` has scene, plume, row, col (source pixel), direction (heading, counter-clockwise from
    east) and map, source_row, source_col of its bank map; ``bank`` has map, row, col, ppb. Each
    pixel is sampled at n_sub by n_sub places between its corners, turned into the map's frame, and
    interpolated between four map cells; places outside the map give zero. Negative means become 0.
    Only pixels whose footprint's box meets the map are sampled.
    """
    corners = pixel_corners(grid, shape)
    spots = F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in (0, 1) for b in (0, 1)])
    asks = grid.select("scene", "row", "col", F.explode(spots).alias("s")).select(
        "scene", F.col("row").alias("prow"), F.col("col").alias("pcol"), "s.dr", "s.dc",
        (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"),
    )
    met = asks.join(corners, ["scene", "row", "col"])
    quad = met.groupBy("scene", F.col("prow").alias("row"), F.col("pcol").alias("col")).agg(
        *[
            F.max(F.when((F.col("dr") == a) & (F.col("dc") == b), F.col(v))).alias(f"{v}{a}{b}")
            for a in (0, 1) for b in (0, 1) for v in ("lon", "lat")
        ],
        F.count(F.lit(1)).alias("_n"),
    ).where("_n = 4").drop("_n")
    origin = plumes.join(grid.select("scene", "row", "col", F.col("lon").alias("lon0"), F.col("lat").alias("lat0")), ["scene", "row", "col"])
    origin = origin.select("scene", "plume", "map", "source_row", "source_col", "lon0", "lat0", F.radians("direction").alias("turn"))
    size = bank.groupBy("map").agg(F.max("row").alias("_hr"), F.max("col").alias("_hc"))
    pairs = quad.join(origin.join(size, "map"), "scene")

    def to_map(lon, lat):
        east, north = local_metres(lon, lat, F.col("lon0"), F.col("lat0"))
        along = (east * F.cos("turn") + north * F.sin("turn")) / pixel_m
        across = (north * F.cos("turn") - east * F.sin("turn")) / pixel_m
        return F.col("source_row") - across, F.col("source_col") + along

    for a in (0, 1):
        for b in (0, 1):
            r, c = to_map(F.col(f"lon{a}{b}"), F.col(f"lat{a}{b}"))
            pairs = pairs.withColumn(f"r{a}{b}", r).withColumn(f"c{a}{b}", c)
    for n, last in (("r", "_hr"), ("c", "_hc")):
        ends = [F.col(f"{n}{a}{b}") for a in (0, 1) for b in (0, 1)]
        pairs = pairs.where((F.greatest(*ends) >= 0) & (F.least(*ends) <= F.col(last)))
    ticks = [(i + 0.5) / n_sub for i in range(n_sub)]
    blend = lambda n, s, t: (
        F.col(f"{n}00") * ((1 - s) * (1 - t)) + F.col(f"{n}01") * (s * (1 - t)) + F.col(f"{n}10") * ((1 - s) * t) + F.col(f"{n}11") * (s * t)
    )
    subs = F.array(*[F.struct(blend("r", s, t).alias("r"), blend("c", s, t).alias("c")) for t in ticks for s in ticks])
    at = pairs.select("scene", "plume", "map", "row", "col", "_hr", "_hc", F.explode(subs).alias("p"))
    at = at.where((F.col("p.r") >= 0) & (F.col("p.r") <= F.col("_hr")) & (F.col("p.c") >= 0) & (F.col("p.c") <= F.col("_hc")))
    fr, fc = F.col("p.r") - F.floor("p.r"), F.col("p.c") - F.floor("p.c")
    cells = F.array(
        *[
            F.struct(
                (F.floor("p.r") + a).cast("int").alias("br"),
                (F.floor("p.c") + b).cast("int").alias("bc"),
                ((fr if a else 1 - fr) * (fc if b else 1 - fc)).alias("w"),
            )
            for a in (0, 1) for b in (0, 1)
        ]
    )
    # Weights of one pixel on one map cell are added before the map is looked up.
    need = (
        at.select("scene", "plume", "map", "row", "col", F.explode(cells).alias("k"))
        .where("k.w > 0")
        .groupBy("scene", "plume", "map", "row", "col", "k.br", "k.bc")
        .agg((F.sum("k.w") / float(n_sub * n_sub)).alias("w"))
    )
    values = bank.select("map", F.col("row").alias("br"), F.col("col").alias("bc"), "ppb")
    return (
        need.join(values, ["map", "br", "bc"])
        .groupBy("scene", "plume", "row", "col")
        .agg(F.greatest(F.sum(F.col("w") * F.col("ppb")), F.lit(0.0)).alias("ppb"))
    )


def _gradient(grid: DataFrame, value: str, axis: str, out: str) -> DataFrame:
    """Central difference along an axis, one-sided at the ends."""
    shifted = lambda k, n: grid.select(
        "scene", *[(F.col(a) - k).alias(a) if a == axis else a for a in ("row", "col")], F.col(value).alias(n)
    )
    j = grid.join(shifted(1, "_n"), ["scene", "row", "col"], "left").join(shifted(-1, "_p"), ["scene", "row", "col"], "left")
    g = F.coalesce((F.col("_n") - F.col("_p")) / 2, F.col("_n") - F.col(value), F.col(value) - F.col("_p"))
    return j.withColumn(out, g).drop("_n", "_p")


def pixel_area(grid: DataFrame) -> DataFrame:
    """Area of every pixel from the Jacobian of its position (scene, row, col, lon, lat)."""
    origin = grid.groupBy("scene").agg(F.avg("lon").alias("_x"), F.avg("lat").alias("_y"))
    g = grid.join(origin, "scene")
    east, north = local_metres(F.col("lon"), F.col("lat"), F.col("_x"), F.col("_y"))
    g = g.select("scene", "row", "col", east.alias("e"), north.alias("n"))
    for v in ("e", "n"):
        for axis in ("row", "col"):
            g = _gradient(g, v, axis, f"{v}_{axis}")
    area = F.abs(F.col("e_col") * F.col("n_row") - F.col("e_row") * F.col("n_col"))
    return g.select("scene", "row", "col", area.alias("area_m2"))


def inpaint_null(df: DataFrame, value: str) -> DataFrame:
    """Nulls replaced, round by round, by the mean of their valid neighbours, until no hole has one."""
    known = df.where(F.col(value).isNotNull()).select("scene", "row", "col", value)
    holes = cut_lineage(df.where(F.col(value).isNull()).select("scene", "row", "col"))
    around = F.array(
        *[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)]
    )
    while not holes.isEmpty():
        asks = holes.select("scene", F.col("row").alias("r"), F.col("col").alias("c"), F.explode(around).alias("o")).select(
            "scene", "r", "c", (F.col("r") + F.col("o.dr")).alias("row"), (F.col("c") + F.col("o.dc")).alias("col")
        )
        filled = cut_lineage(
            asks.join(known, ["scene", "row", "col"]).groupBy("scene", F.col("r").alias("row"), F.col("c").alias("col")).agg(F.avg(value).alias(value))
        )
        if filled.isEmpty():
            break
        known = known.unionByName(filled)
        holes = cut_lineage(holes.join(filled, ["scene", "row", "col"], "left_anti"))
    return known.unionByName(holes.withColumn(value, F.lit(None).cast(df.schema[value].dataType)))


def accumulate_plumes(maps: DataFrame, rates: DataFrame) -> DataFrame:
    """Sum of the plume maps of a scene, each scaled to its emission rate."""
    j = maps.join(rates, ["scene", "plume"])
    return j.groupBy("scene", "row", "col").agg(F.sum(F.col("ppb") * F.col("rate") / BANK_RATE_KG_H).alias("ppb"))


def _erf(x: pd.Series) -> pd.Series:
    return x.map(math.erf)


def srf_weights(bands: DataFrame, lut: DataFrame, n_sigma: float = SRF_SIGMAS, cell: float = 25.0) -> DataFrame:
    """Normalised Gaussian response of every band on the table's wavelengths, with its coverage.

    ``bands`` has band, centre, fwhm; ``lut`` has wavelength, step. Both meet in wavelength cells.
    Coverage is the share of the response inside the table's range.
    """
    erf = F.pandas_udf(_erf, "double")
    ends = lut.agg(F.min("wavelength").alias("lo"), F.max("wavelength").alias("hi")).first()
    b = bands.withColumn("sigma", F.col("fwhm") * FWHM_TO_SIGMA)
    lo, hi = F.col("centre") - n_sigma * F.col("sigma"), F.col("centre") + n_sigma * F.col("sigma")
    s2 = F.col("sigma") * math.sqrt(2.0)
    part = lambda x: (x - F.col("centre")) / s2
    b = b.select(
        "band",
        "centre",
        "sigma",
        lo.alias("_lo"),
        hi.alias("_hi"),
        part(F.least(hi, F.lit(float(ends["hi"])))).alias("_b"),
        part(F.greatest(lo, F.lit(float(ends["lo"])))).alias("_a"),
        part(hi).alias("_d"),
        part(lo).alias("_c"),
    )
    b = b.withColumn("coverage", (erf("_b") - erf("_a")) / (erf("_d") - erf("_c")))
    wide = b.withColumn("_k", F.explode(F.sequence(F.floor(F.col("_lo") / cell), F.floor(F.col("_hi") / cell))))
    narrow = lut.withColumn("_k", F.floor(F.col("wavelength") / cell))
    hit = wide.join(narrow, "_k").where(
        (F.col("wavelength") >= F.col("_lo")) & (F.col("wavelength") < F.col("_hi")) & (F.col("wavelength") < float(ends["hi"]))
    )
    z = (F.col("wavelength") - F.col("centre")) / F.col("sigma")
    raw = hit.select("band", "wavelength", "coverage", (F.exp(-0.5 * z * z) * F.col("step")).alias("_w"))
    # A band touches a few hundred wavelengths at most.
    total = F.sum("_w").over(Window.partitionBy("band"))
    return raw.select("band", "wavelength", (F.col("_w") / total).alias("weight"), "coverage")


def band_factors(lut: DataFrame, weights: DataFrame, background: DataFrame) -> DataFrame:
    """Radiance factor of every band as a short curve over the mixing ratio, per scene.

    ``lut`` has scene, wavelength, mr, t; ``background`` scene, mr0. The factor of a pixel is linear
    between the table's mixing ratios, so convolving at those is enough and pixels never meet the
    wavelengths.
    """
    curves = lut.groupBy("scene", "wavelength").agg(F.array_sort(F.collect_list(F.struct(F.col("mr").alias("x"), F.col("t").alias("y")))).alias("_axis"))
    base = curves.join(background, "scene").select("scene", "wavelength", bracket(F.col("_axis"), F.col("mr0").cast("double")).alias("t0"))
    ratio = lut.join(base, ["scene", "wavelength"]).select("scene", "wavelength", "mr", (F.col("t") / F.col("t0")).alias("ratio"))
    node = ratio.join(weights, "wavelength").groupBy("scene", "band", "mr").agg(
        F.sum(F.col("ratio") * F.col("weight")).alias("_f"), F.max("coverage").alias("_c")
    )
    factor = F.col("_f") * F.col("_c") + (1 - F.col("_c"))
    return node.groupBy("scene", "band").agg(F.array_sort(F.collect_list(F.struct(F.col("mr").alias("x"), factor.alias("y")))).alias("axis"))


def inject_radiance(radiance: DataFrame, enhancement: DataFrame, factors: DataFrame, background: DataFrame) -> DataFrame:
    """Radiance of active pixels times the factor of its band; fill and other pixels stay as they are."""
    active = enhancement.where("ppb > 0").select("scene", "row", "col", "ppb")
    j = radiance.join(active, ["scene", "row", "col"], "left").join(factors, ["scene", "band"], "left").join(background, "scene", "left")
    total = F.col("mr0") + F.col("ppb")
    factor = bracket(F.col("axis"), total.cast("double"))
    touched = F.col("ppb").isNotNull() & F.col("axis").isNotNull() & ~is_fill(F.col("value"))
    return j.select(
        "scene", "row", "col", "band", F.when(touched, F.col("value") * factor).otherwise(F.col("value")).alias("value")
    )


def replace_patch(original: DataFrame, modified: DataFrame) -> DataFrame:
    """Spectra with the modified pixels put in their place."""
    new = modified.select("scene", "row", "col", F.col("spectrum").alias("_new"))
    return original.join(new, ["scene", "row", "col"], "left").withColumn("spectrum", F.coalesce("_new", "spectrum")).drop("_new")


def retrieve_after_injection(
    original: DataFrame, modified: DataFrame, patch: DataFrame, template: Sequence[float], methods: Sequence[str], **settings
) -> DataFrame:
    """Rerun retrievals on full detector columns with the patch put in, cut to the patch.

    ``patch`` has scene, row_off, col_off, height, width. Only detector columns of the patch are
    filtered again; their background needs every row of the column.
    """
    from plumeline.operators.spectral import retrieve

    columns = original.join(patch, "scene").where(
        (F.col("col") >= F.col("col_off")) & (F.col("col") < F.col("col_off") + F.col("width"))
    ).select(*original.columns)
    whole = replace_patch(columns, modified)
    out = None
    for method in methods:
        part = retrieve(whole, template, method, **settings).withColumn("method", F.lit(method))
        out = part if out is None else out.unionByName(part)
    return (
        out.join(patch, "scene")
        .where((F.col("row") >= F.col("row_off")) & (F.col("row") < F.col("row_off") + F.col("height")))
        .select("method", "scene", "row", "col", "enhancement", "albedo")
    )


def truth_mask(df: DataFrame, value: str = "ppb", limit: float = TRUTH_PPB) -> DataFrame:
    return df.where(F.col(value) >= limit)
