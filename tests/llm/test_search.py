import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flowwarden.llm import ann, topk
from flowwarden.llm.common import ready, table, vectors

VECTORS = "vec_id long, embedding array<float>, score string, slice int, length int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)


def usable(v, nonzero=False):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (not nonzero or any(v))


def brute_products(rows, every, k):
    rows = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        best = {}
        for i, v in rows:
            for j, w in rows:
                if i == q and j != q and len(v) == len(w):
                    score = min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(v, w))))
                    best[j] = max(best.get(j, score), score)
        out += [(q, r + 1, j, s) for r, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


@pytest.fixture
def odd_rows():
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(120)]
    rows += [(500 + i, [0.5, 0.25, 0.0, -0.5, 0.1, 0.9]) for i in range(40)]  # ties
    rows += [(300, [0.0] * 6), (301, None), (302, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (303, [math.nan] * 6), (304, [math.inf] + [0.0] * 5)]
    rows += [(305, []), (310, [1.0, 2.0]), (320, [2.0, 1.0]), (None, [0.1] * 6), (40, [0.2] * 6), (40, [0.2] * 6), (330, [1e30] * 6)]
    return rows


def test_products_on_edges(spark, odd_rows):
    ready(spark)
    got = topk.top_products(frame(spark, odd_rows), lambda i: i % 10 == 0, k=7).collect()
    assert sorted(map(tuple, got)) == brute_products(odd_rows, 10, 7)
    assert topk.top_products(frame(spark, []), lambda i: i % 10 == 0).collect() == []


def test_products_in_many_blocks(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "SLICE", 16)
    fine = [r for r in odd_rows if r[0] != 330]
    got = topk.top_products(frame(spark, fine), lambda i: i % 10 == 0, k=7).collect()
    assert sorted(map(tuple, got)) == brute_products(fine, 10, 7)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    q, x = rng.normal(size=(20, 37)), rng.normal(size=(30, 37)) * 3
    for segments in (1, 4, 16, 37, 50):
        bound = topk.segment_features(q, segments) @ topk.segment_features(x, segments).T
        assert (bound >= q @ x.T - 1e-9).all()


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**27), 2**27, (50, 8)).astype(float)
    r, c, v = topk.best_products(x[:5], np.arange(5), x, np.arange(50), 3)
    whole = x.astype(np.int64).astype(object)
    for q in range(5):
        want = sorted(((-int(whole[q] @ whole[j]), j) for j in range(50) if j != q))[:3]
        assert [(-int(s), int(j)) for j, s in zip(c[r == q], v[r == q])] == want


def brute_cosines(rows, every, k):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and usable(v, True)]
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        best = {}
        for i, v in rows:
            for j, w in rows:
                if i == q and j != q and len(v) == len(w):
                    best[j] = max(best.get(j, -2.0), float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)))
        out += [(q, r + 1, j, round(s, 9)) for r, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k])]
    return sorted(out)


def test_neighbours_on_edges(spark, odd_rows):
    got = ann.nearest(frame(spark, odd_rows), lambda i: i % 10 == 0).collect()
    assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in got) == brute_cosines(odd_rows, 10, 5)
    assert ann.nearest(frame(spark, []), lambda i: i % 10 == 0).collect() == []
    assert ann.nearest(frame(spark, [(10, [0.0, 0.0])]), lambda i: i % 10 == 0).collect() == []


def test_one_vector_holds_a_third(spark, monkeypatch):
    monkeypatch.setattr(ann, "SLICE", 32)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)] + [(1000 + i, [0.3, 0.1, -0.2, 0.4, 0.0, 0.7]) for i in range(100)]
    got = ann.nearest(frame(spark, rows), lambda i: i % 50 == 0, trees=3, leaf_rows=20).collect()
    hot = {q: [r[2] for r in sorted(got, key=lambda r: r[1]) if r[0] == q] for q in (1000, 1050)}
    assert hot == {1000: [1001, 1002, 1003, 1004, 1005], 1050: [1000, 1001, 1002, 1003, 1004]}


def exact_nearest(df, pick_queries, k=5):
    """(query_id, vec_id) by brute force."""
    rows = df.select("vec_id", "embedding").toArrow()
    ids, x = rows["vec_id"].to_numpy(), ann.unit(vectors(rows["embedding"]))
    picked = {r[0] for r in df.where(pick_queries(F.col("vec_id"))).select("vec_id").collect()}
    out = []
    for i in range(len(ids)):
        if ids[i] in picked:
            order = [j for j in np.lexsort((ids, -ann.cosines(x, x[i]))) if ids[j] != ids[i]][:k]
            out += [(int(ids[i]), int(ids[j])) for j in order]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_small_tables_go_through_the_forest(spark, sf):
    df = table(ready(spark), f"/root/testdata/{sf}", "embeddings")
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(df, lambda i: i % 50 == 0).collect()}
    want = set(exact_nearest(df, lambda i: i % 50 == 0))
    assert 0.9 * len(want) <= len(got & want) and len(got) == len(want)


def test_every_length_is_searched(spark):
    rows = [(50, [1.0, 0.0, 0.0]), (51, [0.9, 0.1, 0.0]), *((100 + i, [1.0, i / 10]) for i in range(12)), (200, [1.0])]
    got = ann.nearest(frame(ready(spark), rows), lambda i: i % 50 == 0).collect()
    assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in got) == brute_cosines(rows, 50, 5)


def test_large_components_take_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [300000.0, 1.0]), (2, [3.0, 4.0]), (10, [-3e30, 1.0]), (11, [3e38, 3e38]), (20, [1e9, -1e9])]
    got = {(r[0], r[2]): r[3] for r in topk.top_products(frame(ready(spark), rows), lambda i: i % 10 == 0).collect()}
    exact = {i: [math.floor(1024 * float(np.float32(c))) for c in v] for i, v in rows}
    clip = lambda s: min(2**63 - 1, max(-(2**63), s))
    assert got == {(q, j): clip(sum(a * b for a, b in zip(exact[q], exact[j]))) for q in (0, 10, 20) for j in exact if j != q}


def test_recall(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(df, lambda i: i % 50 == 0).collect()}
    want = set(exact_nearest(df, lambda i: i % 50 == 0))
    assert len(got & want) >= 0.9 * len(want)
    few = {(r["query_id"], r["vec_id"]) for r in ann.nearest(df, lambda i: i % 50 == 0, search_rows=1500).collect()}
    assert 0.3 * len(want) < len(few & want) < len(want)  # the forest, not a scan, gives the candidates


def many_vectors(spark, tmp_path, x):
    column = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": column}), tmp_path / "many.parquet", row_group_size=25_000)
    return spark.read.parquet(str(tmp_path / "many.parquet"))


def recall(df, x, queries, k=5):
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(df, lambda i: i.isin(queries), k=k).collect()}
    u, found = ann.unit(x.astype(float)), 0
    for q in queries:
        score = ann.cosines(u, u[q])
        score[q] = -2
        found += sum((q, int(j)) in got for j in np.lexsort((np.arange(len(x)), -score))[:k])
    return found / (k * len(queries))


def test_recall_on_many_vectors(spark, tmp_path, monkeypatch):
    measured, budget = [], ann.budget
    monkeypatch.setattr(ann, "budget", lambda *a: measured.append(budget(*a)) or measured[-1])
    x = np.random.default_rng(7).normal(size=(200_000, 64)).astype(np.float32)
    assert recall(many_vectors(ready(spark), tmp_path, x), x, list(range(0, 200_000, 2985))) >= 0.9
    assert 0 < measured[0][1] < 0.6 * len(x)  # rows looked at: no scan


def test_recall_of_the_others_when_a_third_is_equal(spark, tmp_path, monkeypatch):
    measured, budget = [], ann.budget
    monkeypatch.setattr(ann, "budget", lambda *a: measured.append(budget(*a)) or measured[-1])
    x = np.random.default_rng(8).normal(size=(200_000, 64)).astype(np.float32)
    x[2::3] = x[2]
    assert recall(many_vectors(ready(spark), tmp_path, x), x, list(range(0, 200_000, 4998))) >= 0.9
    assert 0 < measured[0][1] < 0.6 * len(x)


def test_every_tree_is_descended():
    sample = np.random.default_rng(9).normal(size=(500, 8))
    forest = [ann.grow(sample, 50, np.random.default_rng(i)) for i in range(6)]
    counts = [np.full(t.leaves, 1000) for t in forest]
    assert [t for t, _ in ann.visit(forest, counts, sample[0], 1)] == list(range(6))


@pytest.fixture
def one_id_many_times():
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(60)]
    rows += [(77, rows[0][1])] * 12 + [(78, (np.array(rows[0][1]) + rng.normal(0, 0.01, 6)).tolist()) for _ in range(30)]
    return rows + [(20, (np.array(rows[20][1]) * s).tolist()) for s in (1.1, 1.2, 1.3, 1.4, 1.5, 1.6, 1.7, 1.8)]


def test_products_with_one_id_many_times(spark, one_id_many_times):
    got = topk.top_products(frame(ready(spark), one_id_many_times), lambda i: i % 10 == 0, k=7).collect()
    assert sorted(map(tuple, got)) == brute_products(one_id_many_times, 10, 7)


def test_seeds_are_different_ids():
    rng = np.random.default_rng(11)
    x = rng.normal(0, 300, (2000, 64)).round()
    ids = np.arange(2000)
    x[100:150], ids[100:150] = (x[0] + rng.normal(0, 3, (50, 64))).round(), 100
    r, c, v = topk.best_products(x[:1], ids[:1], x, ids, 10)
    whole = {}
    for j, s in zip(ids[1:], x[1:] @ x[0]):
        whole[int(j)] = max(whole.get(int(j), -(10**18)), int(s))
    want = sorted(whole.items(), key=lambda p: (-p[1], p[0]))[:10]
    assert [(int(ids[j]), int(s)) for j, s in zip(c, v)] == want


def test_neighbours_with_one_id_many_times(spark, one_id_many_times):
    got = ann.nearest(frame(ready(spark), one_id_many_times), lambda i: i % 10 == 0).collect()
    assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in got) == brute_cosines(one_id_many_times, 10, 5)


def test_queries_are_rows_of_the_table(spark, sf):
    df = table(spark, sf, "embeddings")
    got = topk.top_products(df, lambda i: i % 100 == 0).groupBy("query_id").count().collect()
    assert {r[0] for r in got} == {r[0] for r in df.where(F.col("vec_id") % 100 == 0).select("vec_id").collect()} and {r[1] for r in got} == {10}
