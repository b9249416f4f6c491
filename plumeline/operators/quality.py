"""Metadata assembly and the gates a collection passes before release."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline import schemas
from plumeline.operators import clean, spread


def build_level0(base: DataFrame, parts: Sequence[DataFrame], a: str = "a", b: str = "b") -> DataFrame:
    """One row per scene: parts keyed by id, left-joined, defaulted, rounded, in declared order."""
    out = base
    for part in parts:
        out = out.join(part, "id", "left")
    schema = schemas.level0_schema(a, b)
    counts = [f.name for f in schema.fields if isinstance(f.dataType, T.LongType) and ":n_" in f.name and f.name in out.columns]
    out = clean.null_policy(out, counts)
    digits = {c: n for c, n in schemas.level0_digits(a, b).items() if c in out.columns}
    return schemas.canonical(clean.round_columns(out, digits), schema)


def plume_wind_table(a: DataFrame, b: DataFrame) -> DataFrame:
    """Published wind per plume of two catalogues: components in one, speed and bearing in the other.

    ``a`` has granule, plume, u, v; ``b`` granule, plume, speed, direction (from).
    """
    left = a.select(
        F.lit("a").alias("catalog"), "granule", "plume", F.hypot("u", "v").alias("speed"), "u", "v",
        F.pmod(F.degrees(F.atan2(-F.col("u"), -F.col("v"))), F.lit(360.0)).alias("direction"),
    )
    right = b.select(
        F.lit("b").alias("catalog"), "granule", "plume", "speed",
        (-F.col("speed") * F.sin(F.radians("direction"))).alias("u"),
        (-F.col("speed") * F.cos(F.radians("direction"))).alias("v"),
        "direction",
    )
    return left.unionByName(right).where("speed is not null")


def per_plume_wind_json(winds: DataFrame, scene: str, plume: str, digits: int = 3, parts: int = 1) -> DataFrame:
    """Mean wind per plume as one JSON object per scene, and per ``part`` of its plumes; see ``with_parts``."""
    means = winds.groupBy(scene, plume).agg(F.avg("u").alias("u"), F.avg("v").alias("v"))
    r = lambda e, n: F.round(e, digits).alias(n)
    value = F.struct(r(F.col("u"), "u"), r(F.col("v"), "v"), r(F.hypot("u", "v"), "speed"))
    rows = spread.with_parts(means.withColumn("_w", value), plume, parts)
    entries = F.array_sort(F.collect_list(F.struct(F.col(plume).cast("string").alias("k"), F.col("_w").alias("v"))))
    return rows.groupBy(scene, "part").agg(F.to_json(F.map_from_entries(entries)).alias("winds"))


def proposal_table(samples: DataFrame, references: DataFrame, clouds: DataFrame, points: DataFrame) -> DataFrame:
    """Sample table with its reference slots, its cloud value and its emission point; complete rows only."""
    return samples.join(references, "id").join(clouds, "id", "left").join(points, "id", "left_semi")


def fill_rows(published: DataFrame, fresh: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """New rows taken from another table by a column map, nulls where nothing is known."""
    out = []
    for f in published.schema.fields:
        source = aliases.get(f.name, f.name)
        c = F.col(f"`{source}`").try_cast(f.dataType) if source in fresh.columns else F.lit(None).cast(f.dataType)
        out.append(c.alias(f.name))
    return published.unionByName(fresh.select(*out))


def overlay(published: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """New values of some columns laid over the published ones, keeping old where there is no new."""
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    j = published.join(new, key, "left")
    return j.select(
        *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in published.columns]
    )


def schema_order_check(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Whether columns equal the declared list, with what is missing, extra or first out of place."""
    actual = df.columns
    wrong = next((a for a, b in zip(actual, declared) if a != b), None)
    row = (
        actual == list(declared),
        sorted(set(declared) - set(actual)),
        sorted(set(actual) - set(declared)),
        wrong,
    )
    schema = "ok boolean, missing array<string>, extra array<string>, first_wrong string"
    return df.sparkSession.createDataFrame([row], schema)


def unique_id_check(df: DataFrame, ident: str, group: str | None = None) -> DataFrame:
    """Rows, distinct ids and ids seen more than once, per group if one is named."""
    keys = [group] if group else []
    per = df.groupBy(*keys, ident).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy(*keys).agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("ids"), F.count_if(F.col("_n") > 1).alias("repeated")
    )


def range_checks(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Failures of every rule in one pass; a null verdict is a failure."""
    bad = [F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *bad)
    items = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in rules])
    return wide.select("_rows", F.explode(items).alias("r")).select(
        "r.rule", "r.failures", F.col("_rows").alias("rows"), (F.col("r.failures") == 0).alias("ok")
    )


def recompute_compare(stored: DataFrame, fresh: DataFrame, key: str | Sequence[str], column: str) -> DataFrame:
    """Relative deviation of recomputed values: median, p90, share above ten percent."""
    keys = [key] if isinstance(key, str) else list(key)
    j = stored.select(*keys, F.col(column).alias("_a")).join(fresh.select(*keys, F.col(column).alias("_b")), keys)
    j = j.withColumn("_d", F.abs(F.col("_a") - F.col("_b")) / F.greatest(F.abs("_a"), F.lit(1e-12)))
    share = F.avg((F.col("_d") > 0.1).cast("double"))
    return spread.summary(j, [], [F.count("_d").alias("n"), share.alias("above_10pct")], "_d", {"median": 0.5, "p90": 0.9})


def layer_verification(layers: DataFrame, expected: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Problems of every scene from its layer aggregates (scene, layer, rows, cols, ...)."""
    shape = F.struct("rows", "cols")
    checked = layers.withColumn(
        "_p",
        F.filter(
            F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.concat("layer", F.lit(f":{n}"))) for n, c in rules.items()]),
            lambda x: x.isNotNull(),
        ),
    )
    # A scene has a handful of layers.
    g = checked.groupBy("scene").agg(
        F.collect_set("layer").alias("_l"),
        F.count_distinct(shape).alias("_shapes"),
        F.array_sort(F.flatten(F.collect_list("_p"))).alias("_p"),
    )
    missing = F.transform(
        F.array_sort(F.array_except(F.array(*[F.lit(x) for x in expected]), F.col("_l"))), lambda x: F.concat(x, F.lit(":missing"))
    )
    shapes = F.when(F.col("_shapes") > 1, F.array(F.lit("shapes differ"))).otherwise(F.array().cast("array<string>"))
    problems = F.concat(missing, F.col("_p"), shapes)
    return g.select("scene", (F.size(problems) == 0).alias("ok"), F.array_join(problems, "; ").alias("problems"))


def hash_diff_gate(before: DataFrame, after: DataFrame, allowed: DataFrame, key: str, content: str) -> DataFrame:
    """Identical, expected and unexpected changes between two versions by digest of their content."""
    digest = lambda df, n: df.select(key, F.sha2(F.col(content).cast("binary"), 256).alias(n))
    listed = allowed.select(key).distinct().withColumn("_ok", F.lit(True))
    j = digest(before, "_a").join(digest(after, "_b"), key, "full").join(listed, key, "left")
    same = F.col("_a").eqNullSafe(F.col("_b"))
    return j.select(key, F.when(same, "identical").when(F.col("_ok"), "expected").otherwise("unexpected").alias("change"))


def id_set_equality(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids on one side only; the sets are equal when both counts are zero."""
    from plumeline.operators.joins import alignment_gaps

    return alignment_gaps(a, b, key).withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def manifest_diff(local: DataFrame, remote: DataFrame, path: str = "path", size: str = "size") -> DataFrame:
    """Files missing or extra on the remote side, or of another size."""
    j = local.select(path, F.col(size).alias("local_size")).join(remote.select(path, F.col(size).alias("remote_size")), path, "full")
    state = F.when(F.col("remote_size").isNull(), "missing").when(F.col("local_size").isNull(), "extra").otherwise("size")
    return j.where(~F.col("local_size").eqNullSafe(F.col("remote_size"))).withColumn("state", state)


def table_equality(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Largest numeric difference and number of differing values per column of two tables."""
    columns = [f for f in a.schema.fields if f.name != key]
    left = a.select(key, *[F.col(f"`{f.name}`").alias(f"a{i}") for i, f in enumerate(columns)], F.lit(1).alias("_a"))
    right = b.select(key, *[F.col(f"`{f.name}`").alias(f"b{i}") for i, f in enumerate(columns)], F.lit(1).alias("_b"))
    j = left.join(right, key, "full")
    aggs = []
    for i, f in enumerate(columns):
        x, y = F.col(f"a{i}"), F.col(f"b{i}")
        aggs.append(F.count_if(~x.eqNullSafe(y)).alias(f"d{i}"))
        gap = F.max(F.abs(x.cast("double") - y.cast("double"))) if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")
        aggs.append(gap.alias(f"g{i}"))
    wide = j.agg(*aggs)
    items = [
        F.struct(F.lit(f.name).alias("column"), F.col(f"d{i}").alias("differing"), F.col(f"g{i}").alias("largest_gap"))
        for i, f in enumerate(columns)
    ]
    return wide.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def leaf_completeness(leaves: DataFrame, ident: str, leaf: str, position: str, expected: Sequence[str]) -> DataFrame:
    """Samples whose leaves are not exactly the expected ones in order; empty when all are complete.

    Leaves beyond the expected number are counted, not gathered.
    """
    w = F.lit(len(expected))
    g = leaves.groupBy(ident).agg(
        F.count(F.lit(1)).alias("leaves"),
        F.array_sort(F.collect_list(F.when(F.col(position) <= w, F.struct(position, leaf)))).alias("_l"),
    )
    names = F.transform("_l", lambda s: s[leaf])
    want = F.array(*[F.lit(x) for x in expected])
    return g.where((F.col("leaves") != len(expected)) | (names != want)).select(ident, "leaves", F.array_join(names, ",").alias("found"))


def plume_index(plumes: DataFrame, bits: DataFrame, matches: DataFrame) -> DataFrame:
    """One feature per plume with bit, flux, match kind and mate; ``problem`` names what is wrong.

    ``plumes`` has scene, side, plume, lon, lat, flux; ``bits`` scene, side, plume, bit; ``matches``
    scene, side, plume, match, mate_side, mate.
    """
    keys = ["scene", "side", "plume"]
    mate_bits = bits.select("scene", F.col("side").alias("mate_side"), F.col("plume").alias("mate"), F.col("bit").alias("mate_bit"))
    one = plumes.groupBy(*keys).agg(F.min_by(F.struct("lon", "lat", "flux"), F.struct("lon", "lat")).alias("p"))
    j = one.select(*keys, "p.*").join(bits, keys, "left").join(matches, keys, "left").join(mate_bits, ["scene", "mate_side", "mate"], "left")
    problem = F.when(F.col("bit").isNull(), "no bit").when(F.col("mate").isNotNull() & F.col("mate_bit").isNull(), "mate without bit")
    return j.select(*keys, "lon", "lat", "flux", "bit", "match", "mate_side", "mate", "mate_bit", problem.alias("problem"))
