"""Exact top-k by inner product with multi-resolution segment statistics.

Every vector is cut into segments whose means and deviations give a lower bound of the distance of two vectors, and, as
2 q.x = |q|^2 + |x|^2 - d^2, an upper bound of their inner product. Bounds of a few segments are taken for all pairs of a block,
those of more segments for the pairs that survive, exact products for the survivors of the last level. A query's threshold is
the least exact product of k different ids with the best coarse bounds, so nothing of the result can be cut off.

Queries and candidates meet in blocks: candidates are dealt into slices and queries into blocks of bounded size, every pair of
a slice and a block is one group, and only its k best ids per query leave it.

Components become floor(scale * x), so products are whole numbers, counted exactly; beyond 64 bits they count as the nearest 64-bit number. Defined
results: vectors that are null or hold null or non-finite components take no part, nor do rows with a null id; only vectors of equal length are
compared; a row is never its own candidate, and rows that share its id aren't either; an id with several vectors counts
with its best product; ties go to the smaller id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.llm.common import exact_products, usable, vectors, whole

SCALE = 1024
LEVELS = (4, 16)
QUERY_BLOCK = 1024
SLICE = 8192


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment the mean and the deviation, times the root of its length: their inner products bound x.y from above."""
    n, d = x.shape
    segments = min(segments, d)
    if not segments:
        return np.zeros((n, 1))
    starts = (np.arange(segments) * d) // segments
    length = np.diff(np.r_[starts, d])
    mean = np.add.reduceat(x, starts, axis=1) / length
    spread = np.add.reduceat((x - np.repeat(mean, length, axis=1)) ** 2, starts, axis=1)
    return np.hstack([mean * np.sqrt(length), np.sqrt(spread)])


def best_products(queries: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, levels=LEVELS):
    """(query row, candidate row, product) of the k best candidates of every query, ties to the smaller id."""
    if not len(queries) or not len(x):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    largest = np.abs(x).max(axis=1, initial=0)
    features = [(segment_features(queries, s), segment_features(x, s)) for s in levels]
    # Rounding of a bound, far below one unit of a product unless the numbers are huge.
    norm = np.sqrt((x**2).sum(axis=1).max(initial=0))
    slack = 0.5 + 1e-9 * norm * np.sqrt((queries**2).sum(axis=1))
    repeated = len(np.unique(x_ids)) < len(x_ids)
    rows, cols, values = [], [], []
    for begin in range(0, len(queries), 128):
        part = slice(begin, begin + 128)
        coarse = features[0][0][part] @ features[0][1].T
        for r, bound in enumerate(coarse, start=begin):
            own = x_ids == q_ids[r]
            bound[own] = -np.inf
            others = len(x) - int(own.sum())
            if not others:
                continue
            alive = np.arange(len(x))
            if others > k:
                seeds = _seeds(bound, x_ids, k) if repeated else np.argpartition(bound, -k)[-k:]
                least = exact_products(x[seeds], queries[r], largest[seeds]).min() - slack[r] if len(seeds) >= k else -np.inf
                alive = np.flatnonzero(bound >= least)
                for f_q, f_x in features[1:]:
                    alive = alive[f_x[alive] @ f_q[r] >= least]
            alive = alive[~own[alive]]
            score = exact_products(x[alive], queries[r], largest[alive])
            order = np.lexsort((x_ids[alive], ~score))  # -score may not fit
            if repeated:
                order = order[np.sort(np.unique(x_ids[alive][order], return_index=True)[1])]
            order = order[:k]
            rows.append(np.full(len(order), r))
            cols.append(alive[order])
            values.append(score[order])
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(values)


def _seeds(bound: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k ids with the best bounds, one each; fewer where there are fewer ids."""
    m, rows = k, int((bound > -np.inf).sum())
    while True:
        m = min(4 * m, rows)
        some = np.argpartition(bound, -m)[-m:]
        some = some[np.argsort(-bound[some], kind="stable")]
        first = np.sort(np.unique(ids[some], return_index=True)[1])[:k]
        if len(first) == k or m == rows:
            return some[first]


def _group(scale: float, k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        q, x = whole(vectors(left["vector"]), scale), whole(vectors(right["vector"]), scale)
        q_ids, x_ids = left["id"].to_numpy(), right["id"].to_numpy()
        r, c, v = best_products(q, q_ids, x, x_ids, k)
        return pa.table({"query_id": q_ids[r], "vec_id": x_ids[c], "score": v})

    return run


def dealt(df: DataFrame, id_col: str, vector_col: str, pick_queries, nonzero: bool = False):
    """Usable rows as (id, vector, length), and the queries among them."""
    rows = df.where(usable(vector_col, nonzero) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.size(vector_col).alias("length")
    )
    return rows, rows.where(pick_queries(F.col("id")))


def top_products(
    df: DataFrame, pick_queries, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE
) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest products of every query. ``pick_queries`` is a condition on the id."""
    rows, queries = dealt(df, id_col, vector_col, pick_queries)
    queries = queries.distinct()
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(pick_queries(F.col("id"))).alias("q")).head()
    blocks, slices = max(1, -(-sizes["q"] // QUERY_BLOCK)), max(1, -(-sizes["n"] // SLICE))
    # Rows are dealt by their place, so that neither a frequent id nor a frequent vector fills a slice.
    place = F.monotonically_increasing_id() + F.spark_partition_id()
    left = queries.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int")).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    )
    right = rows.withColumn("slice", F.pmod(place, F.lit(slices)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    keys = ("length", "block", "slice")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _group(scale, k), "query_id long, vec_id long, score long"
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
