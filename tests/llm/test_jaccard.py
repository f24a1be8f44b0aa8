import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from flowwarden.llm import jaccard
from flowwarden.llm.common import ready, table, text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id, size, component id of every row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 3 * min(len(a), len(b)) >= 2 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                parent[top(i)] = top(j)
    ids = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[top(i)].append(doc)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((doc, len(sets[i]), least[top(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)


def planted(seed):
    """Copies with more and more edits of short and long texts, chains among them, and a passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    common = " ".join(word() for _ in range(60))
    rows = []
    for length in (4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 300):
        base = [word() for _ in range(length)]
        for k in range(14):
            words = list(base)
            for _ in range(k // 2):
                words[rng.randrange(length)] = word()
            rows.append(" ".join(words).title() if k == 3 else " ".join(words))
        rows.append(" ".join(base[: length * 4 // 5]))
    chain = [word() for _ in range(100)]
    for k in range(12):  # each links with the next only
        rows.append(" ".join(chain))
        chain[8 * k : 8 * k + 2] = [word(), word()]
    rows += [common + " " + " ".join(word() for _ in range(rng.randint(2, 40))) for _ in range(40)]
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("boundary", [None, 0, 9, 40])
def test_planted_groups(spark, monkeypatch, boundary):
    ready(spark)
    if boundary is not None:
        monkeypatch.setattr(jaccard, "best_boundary", lambda *a, **k: boundary)
    rows = planted(3)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("boundary", [0, 40])
def test_lists_in_parts(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "best_boundary", lambda *a, **k: boundary)
    rows = planted(11)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.jaccard_components(df, list_rows=2).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_documents(spark, sf):
    df = table(ready(spark), sf, "documents")
    assert got(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_edges(edges, nothing):
    assert got(edges) == brute([(r["doc_id"], r["text"]) for r in edges.collect()])
    assert got(nothing) == [] and jaccard.one_per_component(nothing).collect() == []


def test_many_near_copies_need_few_comparisons(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = f"e{rng.random()}"
        rows.append((i, " ".join(words)))
    compared = []
    kept = jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda docs, pairs, *a: compared.append(pairs.count()) or kept(docs, pairs, *a))
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert sum(compared) < 400 * 399 / 2 / 8


def test_one_row_of_each_group_stays(spark, edges):
    rows = planted(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in jaccard.one_per_component(df).collect()}
    assert kept == {c for _, _, c in brute(rows)}
    left = jaccard.one_per_component(edges).collect()
    assert sorted(str(r["doc_id"]) for r in left) == sorted(["1", "2", "3", "4", "6", "7", "9", "10", "11", "None"])
    assert left[0].__fields__ == edges.columns


def test_shingles_by_hand():
    texts = ["A b c d e f", "a  b\tc d E", "a b", "a b", "b a", "", None, "x\u00a0y z", "same same same same same same same"]
    data, offsets = text_bytes(pa.array(texts))
    sets, bounds = jaccard.shingle_sets(data, offsets)
    mine = [frozenset(sets[bounds[i] : bounds[i + 1]].tolist()) for i in range(len(texts))]
    want = [shingles(t) for t in texts]
    assert [len(s) for s in mine] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(mine[i] & mine[j]) == len(want[i] & want[j])
    prints = jaccard.fingerprints(sets, bounds)
    assert prints[2] == prints[3] != prints[4] and prints[5] == prints[6] == 0


def test_prefixes_hold_common_members():
    rng = np.random.default_rng(1)
    for _ in range(2000):
        n = int(rng.integers(2, 60))
        m = int(rng.integers(n, max(n + 1, n * 4 // 3 + 1)))
        need = jaccard.overlap(n, m)
        if need > n:
            continue
        tokens = rng.permutation(n + m - need)
        a, b = np.sort(tokens[:n]), np.sort(np.r_[tokens[n - need : n], tokens[n:]])
        assert len(np.intersect1d(a, b)) == need
        assert len(np.intersect1d(a[: jaccard.heavy_prefix(n)], b[: jaccard.heavy_prefix(m)])) >= 1
        if need > 1:
            assert len(np.intersect1d(a[: jaccard.light_prefix(n)], b[: jaccard.light_prefix(m)])) >= 2
