import collections

from flowwarden.llm import mixing
from flowwarden.llm.common import table


def by_source(rows, sources):
    size, taken, target, largest = collections.Counter(), collections.Counter(), {}, collections.Counter()
    for r, s in zip(rows, sources):
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
    return size, taken, target, largest


def targets(size):
    """Sharing by hand: give every source its share, cap, share the rest among the others."""
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, free = {}, set(names)
    while True:
        rest = sum(size.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * size[s]}
        if not over or over == free:
            return {**fixed, **{s: min(share[s], 3 * size[s]) for s in free}}
        fixed.update({s: 3 * size[s] for s in over})
        free -= over


def check(df):
    rows = mixing.mix_sources(df, with_rows=True).collect()
    assert len(rows) == df.count()
    sources = [r["row"]["source"] for r in rows]
    size, taken, target, largest = by_source(rows, sources)
    want = targets(size)
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= max(largest[s] * 2, 1)
    for r in rows:
        assert r["source_size"] == size[r["row"]["source"]] and r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        assert r["size"] == len((r["row"]["text"] or "").translate({c: " " for c in range(9, 14)}).split(" ")) - (r["row"]["text"] or "").translate({c: " " for c in range(9, 14)}).split(" ").count("")
    return rows


def test_documents_and_reruns(spark, sf):
    df = table(spark, sf, "documents")
    first = check(df)
    again = mixing.mix_sources(df.repartition(5), with_rows=True).collect()
    assert sorted(first, key=str) == sorted(again, key=str)


def test_edges(edges, nothing):
    check(edges)
    assert mixing.mix_sources(nothing).collect() == []
    assert mixing.mixed_documents(nothing).collect() == []


def test_rows_come_as_often_as_taken(edges):
    want = collections.Counter()
    for r in mixing.mix_sources(edges, with_rows=True).collect():
        want[r["row"]] += r["copies"]
    got = collections.Counter(mixing.mixed_documents(edges).collect())
    assert got == +want


def test_one_source_holds_a_third(spark):
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 == 0 else f"s{i}") for i in range(300)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"))
