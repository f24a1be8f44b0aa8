"""Approximate nearest neighbours by cosine in a forest of random-projection trees.

Equal vectors are one entry of the index, with the k + 1 smallest of their ids: no query can return more of them, so this is exact
and a vector that many rows share fills no leaf. Trees are fitted on at most ``MAX_SAMPLE`` different vectors chosen by a hash (the
documented bound; every vector is indexed): each node splits its rows at the median of a projection on the difference of two of them. A query walks all trees through one priority queue,
nearest hyperplane first, to a leaf of every tree at least and until the leaves it has met hold enough different vectors, by the exact
leaf counts. The rows of these leaves are the candidates; exact cosines in double precision rank them.

How many rows are enough is measured in the table itself: the true neighbours of at most ``CALIBRATION`` queries are found by brute force
over all rows, and the budget is the least with which the walk meets ``RECALL`` of them. Vectors of each length have a forest of their own.

Queries meet the rows of neighbouring leaves in groups of bounded size: a leaf with many rows is dealt into slices
by place, and its queries go to each of them. Only the k best ids per query leave a group.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id; only vectors
of equal length are compared; a row is never its own candidate, and rows that share its id aren't
either; ties go to the smaller id; with few rows all are candidates; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.llm.common import saved, vectors
from flowwarden.llm.topk import dealt

MAX_SAMPLE = 20_000
TREES = 12
#: Rows of the table, not of the sample, that a leaf should hold.
LEAF_ROWS = 96
#: Share of the true neighbours that the budget must meet, above the 0.9 that is asked for, and the queries it is measured with.
RECALL = 0.95
CALIBRATION = 100
#: Rows of neighbouring leaves that make a group, about, and queries of one matrix product.
SLICE = 8192
CHUNK = 256
#: Queries of a task, at least, that walk the forest.
WALKS = 64


@dataclass
class Tree:
    """Inner nodes with a normal, an offset and two children; a child below 0 is leaf -1 - child."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        if not len(self.normals):
            return np.zeros(len(x), dtype=np.int64)
        at = np.zeros(len(x), dtype=np.int64)
        inner = np.arange(len(x))
        while len(inner):
            node = at[inner]
            side = np.einsum("ij,ij->i", x[inner], self.normals[node]) > self.offsets[node]
            at[inner] = self.children[node, side.astype(np.int64)]
            inner = inner[at[inner] >= 0]
        return -1 - at


def grow(sample: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    normals, offsets, children = [], [], []
    leaves = 0
    stack = [(np.arange(len(sample)), -1, 0)]
    while stack:
        rows, parent, side = stack.pop()
        split = None
        if len(rows) > max(2, leaf_rows):
            for _ in range(3):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                normal = a - b
                length = np.linalg.norm(normal)
                if length < 1e-9:
                    continue
                along = sample[rows] @ (normal / length)
                middle = np.median(along)
                right = along > middle
                if right.any() and not right.all():
                    split = normal / length, middle, right
                    break
        if split is None:  # few rows, or rows that no hyperplane tells apart
            here, leaves = -1 - leaves, leaves + 1
        else:
            here = len(normals)
            normals.append(split[0])
            offsets.append(split[1])
            children.append([0, 0])
            stack += [(rows[split[2]], here, 1), (rows[~split[2]], here, 0)]
        if parent >= 0:
            children[parent][side] = here
    d = sample.shape[1]
    return Tree(np.array(normals).reshape(-1, d), np.array(offsets), np.array(children, dtype=np.int64).reshape(-1, 2), leaves)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, also where squares would overflow or vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def walk(forest: list[Tree], query: np.ndarray) -> Iterator[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue."""
    margins = [t.normals @ query - t.offsets for t in forest]
    queue = [(-np.inf, i, 0 if len(t.normals) else -1) for i, t in enumerate(forest)]
    heapq.heapify(queue)
    while queue:
        loss, i, node = heapq.heappop(queue)
        while node >= 0:  # the near side at once, the far side into the queue
            margin = margins[i][node]
            near, far = forest[i].children[node, ::-1] if margin > 0 else forest[i].children[node]
            heapq.heappush(queue, (max(loss, abs(margin)), i, int(far)))
            node = int(near)
        yield i, -1 - node


def visit(forest: list[Tree], counts: list[np.ndarray], query: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """The leaves of a walk until they hold ``enough`` rows; the first of every tree in any case."""
    met, rows = [], 0
    for i, leaf in walk(forest, query):  # begins with one leaf of every tree
        if rows >= enough and len(met) >= len(forest):
            break
        met.append((i, leaf))
        rows += int(counts[i][leaf])
    return met


def needed(forest: list[Tree], counts: list[np.ndarray], query: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For every row of ``near`` the least budget with which ``visit`` meets it."""
    open_rows: dict[tuple[int, int], list[int]] = {}
    for i, t in enumerate(forest):
        for j, leaf in enumerate(t.leaf_of(near)):
            open_rows.setdefault((i, int(leaf)), []).append(j)
    budget, rows = np.zeros(len(near), dtype=np.int64), 0
    for i, leaf in walk(forest, query):
        for j in open_rows.get((i, leaf), ()):
            budget[j] = budget[j] or rows + 1
        if budget.all():
            break
        rows += int(counts[i][leaf])
    return budget


def collapsed(rows: DataFrame, k: int) -> DataFrame:
    """id, vector, nth: the k + 1 smallest ids of every vector, numbered from 1. Tasks keep k + 1 rows a vector before they shuffle."""
    by_vector = Window.partitionBy("h", "vector").orderBy("id")
    hashed = rows.select("id", "vector").distinct().withColumn("h", F.xxhash64("vector"))
    return hashed.withColumn("nth", F.row_number().over(by_vector)).where(F.col("nth") <= k + 1).drop("h")


def _leaves(forest):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(vectors(batch.column("vector")))
            found = np.stack([t.leaf_of(x) for t in forest.value], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.int32()))],
                [*batch.schema.names, "leaves"],
            )

    return run


def _probes(forest, counts, parts, enough):
    """A query once for every part of a tree in which its walk meets leaves, with these leaves."""

    def run(batches):
        for batch in batches:
            for r, q in enumerate(unit(vectors(batch.column("vector"))) if batch.num_rows else ()):
                met: dict[tuple[int, int], list[int]] = {}
                for t, leaf in visit(forest.value, counts.value, q, enough):
                    met.setdefault((t, int(parts.value[t][leaf])), []).append(leaf)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("id")[r].as_py()] * len(met), pa.int64()), pa.array([t for t, _ in met], pa.int32()),
                        pa.array([p for _, p in met], pa.int32()), pa.array(list(met.values()), pa.list_(pa.int32())),
                        batch.column("vector").take(pa.array([r] * len(met), pa.int64())),
                    ],
                    ["id", "tree", "part", "leaves", "vector"],
                )

    return run


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row in the same order of additions, so equal vectors get equal cosines."""
    return (x * q).sum(axis=1)


def best(near: np.ndarray, q: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the k best ids of one query and their exact cosines; ``near`` has cosines up to rounding, -inf for no candidate."""
    some, m = np.flatnonzero(near > -np.inf), k
    while len(some) > m:
        least = np.partition(near[some], -m)[-m]
        if len(np.unique(x_ids[some[near[some] >= least]])) >= k:
            some = some[near[some] >= least - 1e-9]  # all that may tie with the k-th
            break
        m *= 4
    score = cosines(x[some], q)
    order = np.lexsort((x_ids[some], -score))
    order = order[np.sort(np.unique(x_ids[some][order], return_index=True)[1])[:k]]
    return some[order], score[order]


def _group(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_x, out_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if left.num_rows and right.num_rows:
            order = np.argsort(right["leaf"].to_numpy(), kind="stable")
            x, x_ids, leaf = unit(vectors(right["vector"]))[order], right["id"].to_numpy()[order], right["leaf"].to_numpy()[order]
            here, starts = np.unique(leaf, return_index=True)
            ends = np.r_[starts[1:], len(x)]
            lanes, unique = -(-len(x) // 32), len(np.unique(x_ids)) == len(x)
        for begin in range(0, left.num_rows if right.num_rows else 0, CHUNK):
            part = left.slice(begin, CHUNK)
            q, q_ids = unit(vectors(part["vector"])), part["id"].to_numpy()
            lists = part["leaves"].combine_chunks()
            row, met = lists.value_parent_indices().to_numpy(), lists.flatten().to_numpy()
            near = np.full((len(q), 32 * lanes), -np.inf)
            for one, start, end in zip(here, starts, ends):
                some = row[met == one]
                near[some, start:end] = q[some] @ x[start:end].T
            near[:, : len(x)][q_ids[:, None] == x_ids] = -np.inf
            # The k-th best of the best of every lane is no more than the k-th best of all, where ids don't repeat.
            if lanes > k and unique:
                tops = near.reshape(len(q), 32, lanes).max(axis=1)
                near[near < np.partition(tops, -k, axis=1)[:, -k, None] - 1e-9] = -np.inf
            for r in range(len(q)):
                found, score = best(near[r], q[r], x, x_ids, k)
                out_q.append(np.full(len(found), q_ids[r]))
                out_x.append(x_ids[found])
                out_s.append(score)
        return pa.table({"query_id": np.concatenate(out_q).astype(np.int64), "vec_id": np.concatenate(out_x).astype(np.int64), "score": np.concatenate(out_s)})

    return run


def _truth(ids: np.ndarray, q: np.ndarray, k: int):
    """The k best rows of a task for every query, by brute force."""

    def run(batches):
        kept = [(np.empty(0, np.int64), np.empty(0), np.empty((0, q.shape[1])))] * len(q)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, x_ids = unit(vectors(batch.column("vector"))), batch.column("id").to_numpy()
            near = q @ x.T
            near[ids[:, None] == x_ids] = -np.inf
            for r, (old_ids, old_scores, old) in enumerate(kept):
                if len(old_ids) == k:
                    near[r, near[r] < old_scores[-1] - 1e-9] = -np.inf
                some = np.flatnonzero(near[r] > -np.inf)
                if len(some):
                    rows, row_ids = np.vstack([old, x[some]]), np.r_[old_ids, x_ids[some]]
                    found, score = best(rows @ q[r], q[r], rows, row_ids, k)
                    kept[r] = row_ids[found], score, rows[found]
        n = [len(i) for i, *_ in kept]
        rows = np.vstack([v for *_, v in kept])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(q), dtype=np.int32), n)), pa.array(np.concatenate([i for i, *_ in kept])),
                pa.array(np.concatenate([s for _, s, _ in kept])),
                pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), q.shape[1]).cast(pa.list_(pa.float64())),
            ],
            ["query", "id", "score", "vector"],
        )

    return run


def budget(rows: DataFrame, queries: DataFrame, forest: list[Tree], counts: list[np.ndarray], k: int) -> tuple[int, float]:
    """The least budget that meets ``RECALL`` of the true neighbours of some queries, and the rows that a query then looks at on average."""
    asked = queries.groupBy("vector").agg(F.min("id").alias("id")).orderBy(F.xxhash64("vector"), "vector").limit(CALIBRATION).toArrow()
    if not asked.num_rows:
        return 1, 0.0
    q = unit(vectors(asked["vector"]))
    true = rows.select("id", "vector").mapInArrow(_truth(asked["id"].to_numpy(), q, k), "query int, id long, score double, vector array<double>")
    true = true.groupBy("query", "id").agg(F.max("score").alias("score"), F.max_by("vector", "score").alias("vector"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    true = true.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "vector").toArrow()
    if not true.num_rows:
        return 1, 0.0
    near, of = vectors(true["vector"]), true["query"].to_numpy()
    least = np.sort(np.concatenate([needed(forest, counts, q[r], near[of == r]) for r in np.unique(of)]))
    enough = int(least[math.ceil(RECALL * len(least)) - 1])
    return enough, float(np.mean([sum(int(counts[t][leaf]) for t, leaf in visit(forest, counts, one, enough)) for one in q]))


def nearest(
    df: DataFrame, pick_queries, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, search_rows: int | None = None, leaf_rows: int = LEAF_ROWS, max_sample: int = MAX_SAMPLE, seed: int = 5,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every query. ``pick_queries`` is a condition on the id."""
    rows, queries = dealt(df, id_col, vector_col, pick_queries, nonzero=True)
    # As many rows as there are different lengths. Lengths without a query have nothing to search for.
    lengths = [r["length"] for r in queries.select("length").distinct().orderBy("length").collect()]
    found = [
        _nearest(*(d.where(F.col("length") == n).select("id", "vector") for d in (rows, queries)), n, k, trees, search_rows, leaf_rows, max_sample, seed)
        for n in lengths
    ]
    if not found:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionAll, found)


def _nearest(
    rows: DataFrame, queries: DataFrame, length: int, k: int, trees: int, search_rows: int | None, leaf_rows: int, max_sample: int, seed: int
) -> DataFrame:
    """The search among vectors of one length."""
    spark = rows.sparkSession
    rows, queries = saved(collapsed(rows, k), "vectors"), saved(queries.distinct(), "queries")
    different = rows.where("nth = 1")
    n = different.count()
    # About max_sample vectors, whatever the table's size.
    chance = F.pmod(F.xxhash64("vector"), F.lit(1_000_000)) < int(1e6 * min(1.0, max_sample / n))
    sample = unit(vectors(different.where(chance).orderBy("id", "vector").select("vector").toArrow()["vector"]).reshape(-1, length))
    if not len(sample):
        sample = np.eye(1, length)
    rng = np.random.default_rng(seed)
    in_leaf = max(8, int(leaf_rows * len(sample) / n))
    forest = [grow(sample, in_leaf, rng) for _ in range(trees)]
    everywhere = spark.sparkContext.broadcast
    placed = saved(rows.mapInArrow(_leaves(everywhere(forest)), f"id long, {_vector(rows)}, nth int, leaves array<int>"), "leaves")
    counts = [np.zeros(t.leaves, dtype=np.int64) for t in forest]  # different vectors
    held = [np.zeros(t.leaves, dtype=np.int64) for t in forest]  # rows
    # As many rows as the forest has leaves, which the sample bounds.
    by_leaf = placed.select("nth", F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf")
    for r in by_leaf.agg(F.count("*").alias("rows"), F.count_if(F.col("nth") == 1).alias("different")).collect():
        counts[r["tree"]][r["leaf"]], held[r["tree"]][r["leaf"]] = r["different"], r["rows"]
    if search_rows is None:
        search_rows, _ = budget(placed, queries, forest, counts, k)
    # Leaves are numbered from left to right, so those of a part are neighbours.
    parts = [(np.cumsum(c) - c) // SLICE for c in held]
    # Walks are work for the processor, so queries are dealt by number, not by bytes.
    tasks = min(1 + queries.count() // WALKS, 4 * spark.sparkContext.defaultParallelism)
    probes = queries.repartition(tasks, "id").mapInArrow(
        _probes(everywhere(forest), everywhere(counts), everywhere(parts), search_rows),
        f"id long, tree int, part int, leaves array<int>, {_vector(rows)}",
    )
    in_part = [np.bincount(p, weights=c) for p, c in zip(parts, held)]
    split = [
        (t, leaf, int(p), max(1, -(-int(in_part[t][p]) // (2 * SLICE)))) for t, of in enumerate(parts) for leaf, p in enumerate(of)
    ]
    slices = F.broadcast(spark.createDataFrame(split, "tree int, leaf int, part int, slices int"))
    left = probes.join(F.broadcast(spark.createDataFrame(sorted({(t, p, s) for t, _, p, s in split}), "tree int, part int, slices int")), ["tree", "part"])
    left = left.withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    right = placed.select("id", "vector", F.posexplode("leaves").alias("tree", "leaf")).join(slices, ["tree", "leaf"])
    right = right.withColumn("slice", F.expr("cast(pmod(monotonically_increasing_id(), slices) as int)"))
    keys = ("tree", "part", "slice")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_group(k), "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _vector(rows: DataFrame) -> str:
    return f"vector {rows.schema['vector'].dataType.simpleString()}"
