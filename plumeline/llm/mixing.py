"""Mixing sources to target weights: blocks of equal size, apportioned by highest quotients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.llm.common import written

#: Words of a block, rows of a shard (about), and the seed of the order in a shard.
BLOCK, SHARD_ROWS, SEED = 64, 4_000, "mix"
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def reshared_targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Each source's target: ``share`` of all sizes by weight, none above ``most`` times its size.

    What a source can't take is shared again by weight. That ends at min(cap, weight x level); with
    the sources in order of cap / weight, the level is the largest of (rest of the total) / (rest of
    the weights), so no loop is needed. One row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int")).cast("double")
    every = Window.partitionBy()
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    df = sources.withColumn("number", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    df = df.withColumn("level", level)
    return df.withColumn("target", F.least("cap", F.col("weight") * F.max("level").over(every))).drop("weight", "cap", "level")


def apportion(df: DataFrame, group: Sequence[str], item: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë: ``seats`` of each group go to the items with the highest votes / (2 s + 1).

    An item's seats are near its exact share; the divisor's shift moves each by at most its share of
    half the number of items. Only quotients within that distance are listed, the seats below are
    certain, and the rest is handed out in order of quotient, ties to the first item. Adds ``quota``.
    """
    every = Window.partitionBy(*group)
    some = df.where(F.col(votes) > 0)
    part = F.col(votes) / F.sum(votes).over(every)
    some = some.withColumn("_part", part).withColumn("_items", F.count(F.lit(1)).over(every))
    some = some.withColumn("_slack", F.ceil(F.col("_part") * F.col("_items") / 2) + 1)
    some = some.withColumn("_sure", F.greatest(F.floor(F.col("_part") * F.col(seats)) - F.col("_slack"), F.lit(0)))
    some = some.withColumn("_left", F.col(seats) - F.sum("_sure").over(every))
    listed = some.withColumn("_seat", F.explode(F.sequence("_sure", F.col("_sure") + 2 * F.col("_slack") + 2)))
    by_quotient = every.orderBy((F.col(votes) / (2 * F.col("_seat") + 1)).desc(), item)
    won = listed.withColumn("_rank", F.row_number().over(by_quotient)).groupBy(*group, item).agg(
        (F.first("_sure") + F.count_if(F.col("_rank") <= F.col("_left"))).alias("quota")
    )
    return df.join(won, [*group, item], "left").withColumn("quota", F.coalesce("quota", F.lit(0)))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = BLOCK,
    shard_rows: int = SHARD_ROWS, seed: str = SEED, key: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """How many words the mix takes of every document: (key, size, source_size, target, taken).

    Sources in order of code point, null last, have ``weights`` in turn and share ``share`` of all
    words; see ``reshared_targets``. The total is cut into blocks of ``block`` words, whole blocks are
    apportioned to sources and within a source to its shards (rows by a seeded hash of their key).
    In a shard the documents lie in a seeded order, and the mix takes its blocks along that order,
    starting again at the end, so that no document is taken more than ``most`` times.

    A null text has size 0 and takes nothing. Rows with a null key are one more key; repeated rows are
    documents of their own. Other columns are ignored. An empty table gives no rows. Equal tables
    give equal mixes.
    """
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(docs[key].cast("string"), F.lit("null"))))
    sizes = written(docs.select(docs[key].alias("key"), docs[source].alias("source"), words_in(docs[text]).alias("size"), digest.alias("order")), "sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = reshared_targets(sources, weights, share, most).withColumn("shards", F.ceil(F.col("rows") / shard_rows))
    total = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    quotas = written(apportion(sources.withColumn("seats", total).withColumn("all", F.lit(0)), ["all"], "number", "target", "seats"), "quotas")
    quotas = quotas.select("source", "number", "source_size", "target", "shards", F.col("quota").alias("source_quota"))
    shard = F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * F.col("shards"), 32)
    dealt = sizes.join(quotas, sizes["source"].eqNullSafe(quotas["source"])).drop(quotas["source"]).withColumn("shard", shard)
    held = dealt.groupBy("number", "shard").agg(F.sum("size").alias("words"), F.first("source_quota").alias("seats"))
    held = apportion(held, ["number"], "shard", "words", "seats").select("number", "shard", "words", F.least(F.col("quota") * block, F.floor(F.col("words") * most)).alias("want"))
    before = Window.partitionBy("number", "shard").orderBy("order", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).join(held, ["number", "shard"])
    times, rest = F.expr("want div greatest(words, 1)"), F.col("want") % F.greatest("words", F.lit(1))
    taken = F.when(F.col("words") > 0, times * F.col("size") + F.greatest(F.least(F.col("size"), rest - F.col("before")), F.lit(0))).otherwise(0)
    return placed.select(F.col("key").alias(key), "size", "source_size", "target", taken.cast("long").alias("taken"))


#: What op8 returns, for DuckDB.
SQL = f"""
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
         md5('{SEED}:' || coalesce(doc_id::varchar, 'null')) as ord from documents),
sums as (select source, sum(size)::bigint as source_size, count(*) as n from sizes group by source),
numbered as (select *, row_number() over (order by source nulls last) - 1 as number from sums),
weighed as (select *, ([5.0, 2.0, 1.0])[(number % 3 + 1)::int]::double as weight, 2.0::double * source_size as cap from numbered),
levels as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over w, 0)) / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as lvl
  from weighed window w as (order by cap / weight, number rows between unbounded preceding and 1 preceding)),
targets as (select source, number, source_size, n, least(cap, weight * max(lvl) over ()) as target, ceil(n / {SHARD_ROWS}.0)::bigint as shards from levels),
seats as (select *, round(sum(target) over () / {BLOCK})::bigint as seats from targets),
share1 as (select *, target / sum(target) over () as part, count(*) over () as items from seats where target > 0),
sure1 as (select *, (ceil(part * items / 2) + 1)::bigint as slack, greatest(floor(part * seats)::bigint - (ceil(part * items / 2) + 1)::bigint, 0) as sure from share1),
left1 as (select *, seats - sum(sure) over () as rest from sure1),
list1 as (select *, unnest(range(sure, sure + 2 * slack + 3)) as seat from left1),
rank1 as (select *, row_number() over (order by target / (2 * seat + 1) desc, number) as rk from list1),
quota1 as (select number, any_value(sure) + count(*) filter (rk <= rest) as quota from rank1 group by number),
sources as (select t.*, coalesce(quota, 0) as source_quota from targets t left join quota1 q using (number)),
dealt as (
  select s.doc_id, s.size, s.ord, q.number, q.source_size, q.target, q.source_quota, (('0x' || substr(ord, 1, 8))::bigint * q.shards) >> 32 as shard
  from sizes s join sources q on s.source is not distinct from q.source),
held as (select number, shard, sum(size)::bigint as words, any_value(source_quota) as seats from dealt group by number, shard),
share2 as (select *, words / sum(words) over (partition by number) as part, count(*) over (partition by number) as items from held where words > 0),
sure2 as (select *, (ceil(part * items / 2) + 1)::bigint as slack, greatest(floor(part * seats)::bigint - (ceil(part * items / 2) + 1)::bigint, 0) as sure from share2),
left2 as (select *, seats - sum(sure) over (partition by number) as rest from sure2),
list2 as (select *, unnest(range(sure, sure + 2 * slack + 3)) as seat from left2),
rank2 as (select *, row_number() over (partition by number order by words / (2 * seat + 1) desc, shard) as rk from list2),
quota2 as (select number, shard, any_value(sure) + count(*) filter (rk <= rest) as quota from rank2 group by number, shard),
wanted as (select h.number, h.shard, h.words, least(coalesce(quota, 0) * {BLOCK}, 2 * h.words)::bigint as want from held h left join quota2 using (number, shard)),
placed as (
  select d.*, w.words, w.want, coalesce(sum(d.size) over (partition by d.number, d.shard order by d.ord, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0)::bigint as pos
  from dealt d join wanted w on d.number = w.number and d.shard = w.shard)
select doc_id, size, source_size, target,
       (case when words > 0 then (want // words) * size + greatest(least(size, want % words - pos), 0) else 0 end)::bigint as taken from placed
"""
