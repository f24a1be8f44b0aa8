"""Hard negatives against SQL on the tables, and against plain Python on small awkward ones."""

import numpy as np
import pytest

from flowwarden.llm import negatives
from flowwarden.llm.common import exact_products, ready
from tests.oracle import differences


def test_same_as_sql_on_a_larger_table(spark):
    assert differences(spark, "op11_hard_negatives", "/root/testdata/sf0.01") == []


def plain(rows, pick, k=10, positives=5, low=30, high=90, scale=256):
    usable = [
        (i, label, [int(np.floor(scale * float(x))) for x in v]) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    clip = lambda s: min(2**63 - 1, max(-(2**63), s))
    same, other = {}, {}
    for i, label, q in usable:
        if not pick(i):
            continue
        for j, label_j, x in usable:
            if i != j and len(x) == len(q):
                s = clip(sum(a * b for a, b in zip(q, x)))
                (same if label == label_j else other).setdefault(i, {}).setdefault(j, []).append(s)
    out = []
    for i, found in same.items():
        for j, s in sorted(((j, max(s)) for j, s in found.items()), key=lambda p: (-p[1], p[0]))[:positives]:
            fits = {n: [t for t in of if low * s <= 100 * t <= high * s] for n, of in other.get(i, {}).items()}
            fits = [(n, max(t)) for n, t in fits.items() if t]
            fits = sorted(fits, key=lambda p: (-p[1], p[0]))[:k]
            out += [(i, j, r, n, s, t) for r, (n, t) in enumerate(fits, 1)]
    return sorted(out)


def mined(df, **kw):
    got = negatives.hard_negatives(df, lambda i: i % 3 == 0, **kw)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


SCHEMA = "vec_id long, label int, embedding array<double>"


def _rows(seed, n=150, d=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(3, d))
    rows = []
    for i in range(n):
        v = (centres[rng.integers(3)] + rng.normal(size=d) * rng.choice([0.05, 1])).tolist()
        rows.append((i, int(rng.integers(4)), v))
    return rows


ODD = [
    (900, 1, None), (901, 1, [1.0, None, 0.0, 0.0]), (902, 1, [float("nan"), 0.0, 0.0, 1.0]), (903, None, [1.0] * 4), (None, 1, [1.0] * 4),
    (906, 1, [0.0] * 4), (907, 2, [0.0] * 4), (909, 1, [1.0, 2.0]), (912, 1, [2.0, 1.0]), (913, 2, [1.0, 1.0]), (915, 1, []), (918, 1, []), (919, 0, []),
    (921, 1, [float("inf"), 1.0, 1.0, 1.0]), (924, 1, [3e5, 1.0, 0.0, 0.0]), (925, 2, [2e5, 1.0, 0.0, 0.0]), (927, 1, [1e9, 1e9, 1.0, 0.0]),
    (928, 2, [1e9, -1e9, 1.0, 0.0]), (930, 1, [3e200, 1.0, 0.0, 0.0]), (931, 2, [1e-200, 1.0, 0.0, 0.0]),
]


@pytest.mark.parametrize(("slice_rows", "block_rows", "seed"), [(8192, 1024, 1), (16, 8, 2), (1, 1, 3)])
def test_awkward_rows_in_packs_of_any_size(spark, monkeypatch, slice_rows, block_rows, seed):
    monkeypatch.setattr(negatives, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block_rows)
    rows = _rows(seed, 150 if slice_rows > 1 else 40)
    rows += rows[:20] + [(6, 0, [0.1] * 4), (6, 2, [0.2] * 4)] + [r for r in ODD if r[0] != 930]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows, lambda i: i % 3 == 0)


def test_huge_components_are_ordered(spark):
    rows = [r for r in _rows(4, 30)] + [r for r in ODD if r[0] is not None and r[0] >= 924]
    got = mined(spark.createDataFrame(rows, SCHEMA))
    assert got == plain(rows, lambda i: i % 3 == 0)


def test_hot_vector_and_label(spark):
    rows = [(i, 0, [1.0, 0.5, 0.0, 0.25]) for i in range(300)] + [(1000 + i, 1 + i % 3, v) for i, _, v in _rows(5, 200)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows, lambda i: i % 3 == 0)


def test_clashing_columns_and_empty_table(spark):
    ready(spark)
    rows = [(*r, "x", 1, 2) for r in _rows(6, 40)]
    df = spark.createDataFrame(rows, SCHEMA + ", id string, length int, cell int")
    assert mined(df) == plain([r[:3] for r in rows], lambda i: i % 3 == 0)
    assert mined(df.limit(0)) == []


def test_bounds_hold_every_score():
    rng = np.random.default_rng(7)
    for spread in (1, 1e-3, 1e6, 1e40):
        q = np.floor(rng.normal(size=(200, 6)) * 100 * spread) + np.floor(rng.normal(size=6) * 300)
        norms, stored = negatives.angles(q, negatives.directions(q))
        stored = stored.astype(float)
        for i in range(20):
            near, far = negatives.between(stored, stored[i])
            low, high = negatives.score_bounds(norms * norms[i], near, far)
            true = [sum(int(a) * int(b) for a, b in zip(x, q[i])) for x in q]
            assert all(a <= t <= b for a, t, b in zip(low, true, high))


def test_exact_products():
    x = np.array([[2.0**40, 1, 3], [2.0**31, 5, 7], [1e150, -1e150, 1], [1, 2, 3]])
    y = np.array([2.0**33, 3.0, 1.0])
    true = [min(2**63 - 1, max(-(2**63), sum(int(a) * int(b) for a, b in zip(r, y)))) for r in x]
    assert exact_products(x, y).tolist() == true
