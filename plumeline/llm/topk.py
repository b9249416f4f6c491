"""Exact top-k inner products: every query against every row, one dimension at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Queries and candidates of a block; a block of scores is QUERIES x CANDIDATES integers at most.
QUERIES, CANDIDATES = 256, 4096
#: Rows whose products with a block of queries are made at once.
STEP = 1024
#: Blocks of a partition. A task holds one partition's blocks of queries and goes through those of rows.
BLOCKS = 4
#: Tasks of a search, which the driver keeps account of; beyond, partitions have more blocks.
TASKS = 10_000


def scaled(vector: Column, factor: int = 256) -> Column:
    """Components as floor(factor * x), x as double; null where a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(v * factor).cast("long")))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of integers as a matrix; shorter rows end in zeros."""
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(size.max()) if len(size) else 0), np.int64)
    out[np.repeat(np.arange(len(column)), size), np.concatenate([np.arange(n) for n in size]).astype(int) if len(size) else []] = column.flatten().to_numpy()
    return out


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same numbers in the fewest bytes each that hold them all."""
    low, high = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    return matrix.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of all queries with all rows, term at a time.

    A term's postings are the rows with a weight there. Each query with a weight there scatters its
    products into its dense row of scores; terms without weight on either side cost nothing.
    """
    terms = min(queries.shape[1], rows.shape[1])
    most = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    # Where no sum can pass 32 bits, products take half the room; they are made a few rows at a time, to stay in the cache.
    kind = np.int32 if max(terms, 1) * max(most(queries), 1) * max(most(rows), 1) < 2**31 else np.int64
    weights, columns = np.ascontiguousarray(queries.T, kind), np.ascontiguousarray(rows.T, kind)
    asked = [np.flatnonzero(w) for w in weights[:terms]]
    scores = np.empty((len(queries), len(rows)), np.int64)
    for at in range(0, len(rows), STEP):
        part = columns[:terms, at : at + STEP]
        total, products = (np.zeros((len(queries), part.shape[1]), kind) for _ in range(2))
        for term, asking in enumerate(asked):
            posting = np.flatnonzero(part[term])
            if len(posting) == 0 or len(asking) == 0:
                continue
            # A few zeros among the weights cost less than places picked out one by one.
            if 4 * len(posting) * len(asking) >= total.size:
                total += np.multiply.outer(weights[term], part[term], out=products)
            else:
                total[np.ix_(asking, posting)] += np.multiply.outer(weights[term, asking], part[term, posting])
        scores[:, at : at + STEP] = total
    return scores


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query number, row number) of each query's k best: higher score, then smaller id; never its own id."""
    allowed = ids[None, :] != own[:, None]
    floor = np.iinfo(np.int64).min
    scores = np.where(allowed, scores, floor)
    n = min(k, scores.shape[1])
    edge = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n] if n else np.zeros(len(scores))
    q, r = np.nonzero((scores >= edge[:, None]) & allowed)
    order = np.lexsort((ids[r], -scores[q, r], q))
    q, r = q[order], r[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], r[rank < k]


def merged(best: tuple[np.ndarray, ...] | None, fresh: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """(query number, row id, score) of each query's k best of both lists: higher score, then smaller id."""
    q, ids, scores = fresh if best is None else (np.concatenate(x) for x in zip(best, fresh))
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[first], ids[first], scores[first]


def blocks(df: DataFrame, size: int, parts: int, name: str) -> DataFrame:
    """(name, name_ids, name_vectors, name_kind): up to ``size`` rows as bytes, dealt to so many partitions."""
    fields = [T.StructField(name, T.LongType()), T.StructField(f"{name}_ids", T.BinaryType()), T.StructField(f"{name}_vectors", T.BinaryType()), T.StructField(f"{name}_kind", T.StringType())]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            ids, vectors = table.column("id").to_numpy().astype("<i8"), _narrow(_matrix(table.column("vector").combine_chunks()))
            number = pa.array([0], pa.int64())
            return pa.RecordBatch.from_arrays([number, pa.array([ids.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary()), pa.array([vectors.dtype.str])], [f.name for f in fields])

        for batch in batches:
            kept.append(batch)
            held += batch.num_rows
            while held >= size:
                table = pa.Table.from_batches(kept)
                yield block(table.slice(0, size))
                kept, held = table.slice(size).to_batches(), held - size
        if held:
            yield block(pa.Table.from_batches(kept))

    # Each block's number tells it from the others of its partition.
    packed = df.select("id", "vector").repartition(parts).mapInArrow(pack, T.StructType(fields))
    return packed.withColumn(name, F.monotonically_increasing_id())


def search(queries: DataFrame, rows: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest inner product for each query.

    Both inputs have (id long, vector array<long>); null vectors and null ids take no part. Vectors
    of other lengths count as ending in zeros. Ties go to the smaller id; a query never finds its own
    id. Repeated queries are asked once; repeated rows are found as often as they come. Products must
    fit in 64 bits. An empty side gives no rows.

    Queries and rows are packed into blocks of bounded size, a few to a partition. Each pair of partitions is one
    piece of work that reads both where they were dealt and keeps k rows per query, so neither side is held
    whole anywhere, sent to the driver or written once per block of the other.
    """
    queries, rows = (x.select("id", "vector").where("id is not null and vector is not null") for x in (queries.dropDuplicates(["id", "vector"]), rows))
    parts = lambda df, size, most: min(max(-(-df.count() // (size * BLOCKS)), 1), most)
    q_parts = parts(queries, QUERIES, TASKS)
    asked = blocks(queries, QUERIES, q_parts, "q")
    found = blocks(rows, CANDIDATES, parts(rows, CANDIDATES, max(TASKS // q_parts, 1)), "r")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, owns = {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                q, q_ids, q_vectors, q_kind, ids, vectors, kind = (batch.column(c)[i].as_py() for c in ("q", "q_ids", "q_vectors", "q_kind", "r_ids", "r_vectors", "r_kind"))
                own, names = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                asking, held = (np.frombuffer(v, t).reshape(len(n), -1).astype(np.int64) for v, t, n in ((q_vectors, q_kind, own), (vectors, kind, names)))
                scores = accumulate(asking, held)
                a, b = best_of(scores, names, own, k)
                owns[q], best[q] = own, merged(best.get(q), (a, names[b], scores[a, b]), k)
        for q, (a, ids, scores) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(owns[q][a]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])
    # Every block of queries meets every block of rows: nothing is broadcast, whatever the sizes look like.
    pairs = found.crossJoin(asked.hint("shuffle_replicate_nl")).drop("r")
    partial = pairs.mapInArrow(score, schema)
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: What op5 returns, for DuckDB.
SQL = """
with w as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and vec_id is not null),
s as (
  select q.vec_id as query_id, r.vec_id as vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::bigint as score
  from w q join w r on q.vec_id % 50 = 0 and r.vec_id <> q.vec_id),
k as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::integer as rank, vec_id, score from k where rank <= 5
"""
