import collections
import zlib

import pytest
from pyspark.sql import functions as F

from flowwarden.llm import sharding
from flowwarden.llm.common import table


def check(rows, docs, shards):
    want = collections.Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))


@pytest.mark.parametrize("shards", [1, 24])
def test_documents(spark, sf, shards):
    docs = table(spark, sf, "documents")
    check(sharding.shards(docs, shards).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], shards)


def test_edges(edges, nothing):
    check(sharding.shards(edges, 5).collect(), [tuple(r) for r in edges.select("doc_id", "text").collect()], 5)
    assert sharding.shards(nothing, 5).collect() == []


def test_place_does_not_depend_on_partitions(spark, sf):
    docs = table(spark, sf, "documents")
    a = sharding.shards(docs, 24).collect()
    b = sharding.shards(docs.repartition(7), 24).collect()
    assert sorted(a) == sorted(b)
    order = [r["row_number"] for r in sorted(a, key=lambda r: (r["shard"], r["slot"]))]
    assert order != sorted(order)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 97, 1000, 4099])
def test_permutation_hits_every_number_once(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 17)).collect()]
    assert sorted(got) == list(range(n))
