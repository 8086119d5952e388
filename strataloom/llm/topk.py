"""Exact top-k by inner product without random access: sorted lists, bounds, early stop, resolution.

Components become floor(1024 x). A block of candidates has one sorted list a dimension; a
query reads the list of a dimension from its high end where its own component is positive
and from its low end where it is negative, entry after entry. What a step reads is added to the sums of
the candidates that stand there; nothing else of a candidate is looked at. Its score lies
between that sum with the far ends of the lists where it has not come up yet, and that sum with the places
the lists have been read to. A candidate, or one that has not come up anywhere, whose upper bound is below
the k-th best lower bound cannot qualify and is left; reading stops once few are left, and those are resolved to exact scores.

In many dimensions without skew nearly all of the lists is read before the bounds close (see the README): that is
the method's cost, and a plain product would be cheaper there.

Queries go in blocks against blocks of all rows; a task holds one of each, and hands on k
rows a query. The best k of a query are then taken from its tasks.

Rows: vectors that are null, empty or hold null or non-finite components, and rows without an id, take no
part. Only vectors of one length are compared. A query's own row is every row of its id.
Repeated rows of another id count each. Ties go to the smaller id. Scores beyond a long are held at its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.llm.common import cut, table

K, SCALE = 10, 1024
QUERIES, CANDIDATES = 64, 16384
#: Parts of the lists that are read before bounds are taken; candidates a query may have left when it stops.
DEPTHS, LEFT = (1 / 8, 1 / 2, 1.0), 64
_EXACT = 2.0**53


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, x) to (vec_id, size, ints): components as whole numbers in double precision; what takes no part goes."""
    for batch in batches:
        column = batch.column(1)
        values, offsets = column.values, column.offsets.to_numpy()
        null = values.is_null().to_numpy(zero_copy_only=False)
        flat = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
        bad = np.concatenate([[0], np.cumsum(null | ~np.isfinite(flat))])
        with np.errstate(over="ignore", invalid="ignore"):
            ints = np.clip(np.floor(SCALE * flat), -1e300, 1e300)
        known = column.is_valid().to_numpy(zero_copy_only=False) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        keep = np.flatnonzero(known & (offsets[1:] > offsets[:-1]) & (bad[offsets[1:]] == bad[offsets[:-1]]))
        raw = [ints[offsets[i] : offsets[i + 1]].tobytes() for i in keep]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array([len(r) // 8 for r in raw], pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "size", "ints"])


def _pack(group: pa.Table) -> pa.Table:
    """A block of rows as one row: ids and components of all, in order of id."""
    ids = group.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    raw = [x.as_buffer().to_pybytes() for chunk in group.column("ints").chunks for x in chunk]
    block = pa.array([b"".join(raw[i] for i in order)], pa.binary())
    return pa.table({"size": group.column("size")[:1], "block": group.column("block")[:1], "ids": pa.array([ids[order].tobytes()], pa.binary()), "rows": block})


def best(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int = K, read: list[int] | None = None) -> list[tuple[np.ndarray, list[int]]]:
    """For each query: places of its k best rows (not of its own id) and their scores; ids ascend, so ties go to the first.

    The number of list entries that a query read is appended to `read`.
    """
    n, d = rows.shape
    if float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * d >= _EXACT:
        return _best_large(queries, own, rows, ids, k)
    order = np.argsort(rows, axis=0, kind="stable")
    lists, dims = np.take_along_axis(rows, order, 0), np.arange(d)
    # What has not come up yet from the high and from the low ends of the lists, and each query's sums of what has.
    unread, sums = np.ones((2, n, d)), np.zeros((len(queries), n))
    out: list[tuple[np.ndarray, list[int]] | None] = [None] * len(queries)
    live, alive, done = np.arange(len(queries)), np.arange(n), 0
    for share in DEPTHS:
        t = min(n, max(1, int(np.ceil(share * n))))
        q = queries[live]
        signed = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], 1)
        # The entries of this step, each at its row, go to the sums of those queries that read from that end.
        step = np.zeros((2, n, d))
        for end, part in enumerate((slice(n - t, n - done), slice(done, t))):
            step[end, order[part], dims] = lists[part]
            unread[end, order[part], dims] = 0
        done = t
        sums = sums + signed @ np.concatenate([step[0, alive], step[1, alive]], 1).T
        mine = own[live][:, None] == ids[alive][None, :]
        if t < n:
            rest = np.concatenate([unread[0, alive], unread[1, alive]], 1).T
            upper = sums + (signed * np.concatenate([lists[n - t], lists[t - 1]])) @ rest
            lower = sums + (signed * np.concatenate([lists[0], lists[n - 1]])) @ rest
        else:
            upper, lower = sums.copy(), sums.copy()
        lower[mine], upper[mine] = -np.inf, -np.inf
        limit = np.partition(lower, len(alive) - k, axis=1)[:, len(alive) - k] if len(alive) > k else np.full(len(live), -np.inf)
        keep = (upper >= limit[:, None]) & ~mine
        ready = (keep.sum(1) <= max(LEFT, k)) | (t == n)
        for i in np.flatnonzero(ready):
            out[live[i]] = _resolve(q[i], alive[keep[i]], rows, k)
            if read is not None:
                read.append(t * d)
        live, keep, sums = live[~ready], keep[~ready], sums[~ready]
        if not len(live):
            break
        some = keep.any(0)
        alive, sums = alive[some], sums[:, some]
    return out


def _resolve(q: np.ndarray, places: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    score = (rows[places] @ q).astype(np.int64)
    order = np.lexsort((places, -score))[:k]
    return places[order], score[order].tolist()


def _best_large(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, list[int]]]:
    """best() where a double cannot hold all sums: bounds from products with their rounding, then whole numbers for what is left."""
    ends = float(2**63)
    with np.errstate(over="ignore", invalid="ignore"):
        near = queries @ rows.T
        wrong = (np.abs(queries) @ np.abs(rows).T) * ((rows.shape[1] + 2) * 2.0**-52)
        lower, upper = np.clip(near - wrong, -ends, ends), np.clip(near + wrong, -ends, ends)
    lower[np.isnan(lower)], upper[np.isnan(upper)] = -ends, ends
    out = []
    for i, q in enumerate(queries):
        others = np.flatnonzero(ids != own[i])
        limit = np.partition(lower[i, others], len(others) - k)[len(others) - k] if len(others) > k else -ends
        places = others[upper[i, others] >= limit]
        # Every score as a whole number, all at once.
        exact = np.array([[int(x) for x in r] for r in rows[places].tolist()], object).reshape(len(places), -1) @ np.array([int(x) for x in q.tolist()], object)
        score = [max(-(2**63), min(2**63 - 1, int(x))) for x in exact]
        order = sorted(range(len(places)), key=lambda j: (-score[j], places[j]))[:k]  # noqa: B023
        out.append((places[order], [score[j] for j in order]))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score); is_query is over the column vec_id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).mapInArrow(_whole, "vec_id long, size int, ints binary")
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    sums = rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"))
    parts = cut(sums.select("size", F.ceil(F.col("n") / CANDIDATES).cast("int").alias("parts"), F.greatest(F.ceil(F.col("q") / QUERIES), F.lit(1)).cast("int").alias("q_parts")))
    schema = "size int, block int, ids binary, rows binary"
    dealt = rows.join(F.broadcast(parts) if parts.count() <= 10_000 else parts, "size")
    blocks = dealt.withColumn("block", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).select("vec_id", "size", "ints", "block").groupBy("size", "block").applyInArrow(_pack, schema)
    asked = dealt.where(is_query).withColumn("block", F.pmod(F.xxhash64("row"), F.col("q_parts")).cast("int")).select("vec_id", "size", "ints", "block").groupBy("size", "block").applyInArrow(_pack, schema)
    asked = asked.join(parts, "size").select("size", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"))
    met = asked.join(blocks, ["size", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                size = batch.column("size")[i].as_py()
                own, q, ids, x = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("q_ids", np.int64), ("q_rows", np.float64), ("ids", np.int64), ("rows", np.float64)))
                found = best(q.reshape(-1, size), own, x.reshape(-1, size), ids, k)
                n = [len(p) for p, _ in found]
                place = np.concatenate([p for p, _ in found]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, n)), pa.array(ids[place]), pa.array([s for _, x in found for s in x], pa.int64())], ["query_id", "vec_id", "score"])

    found = met.select("size", "q_ids", "q_rows", "ids", "rows").mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows of every hundredth id."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
