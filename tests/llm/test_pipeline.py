"""The pipeline against the same decisions made without Spark."""

import collections

import duckdb
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from flowwarden.llm import jaccard, toxicity
from flowwarden.llm.common import ready, table
from flowwarden.llm.queries import ORACLES, held_out
from tests.llm.test_jaccard import brute


def test_rows(spark, sf):
    docs = table(ready(spark), sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels").where(~held_out()))
    rows = docs.collect()
    odds = model.log_odds(pa.array([r["text"] for r in rows], pa.string()))
    rows = [r for r, o in zip(rows, odds) if 1 / (1 + 2.718281828459045**-o) < 0.3]
    assert 0 < len(rows) < docs.count()
    component = {d: c for d, _, c in brute([(r["doc_id"], r["text"]) for r in rows])}
    rows = [r for r in rows if component[r["doc_id"]] == r["doc_id"]]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in rows]))
    copies = {}
    for doc, size, _, _, taken in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLES['op2_source_mixing']})").fetchall():
        copies[doc] = taken // size if size else None
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in rows:
        if copies[r["doc_id"]]:
            ids = tuple(library.encode(r["text"], add_special_tokens=False).ids)
            want[(r["doc_id"], r["source"], len(ids), ids)] += copies[r["doc_id"]]
    got = collections.Counter((r["doc_id"], r["source"], r["n_tokens"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, sf).collect() if r["n_tokens"])
    assert got == want


def test_stages_keep_the_columns(spark, sf):
    docs = table(spark, sf, "documents").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "source_mixing", "bpe"]
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_rows_are_decided_by_themselves(spark):
    """Equal ids, equal rows, rows without words or ids, and columns named like helpers."""
    long = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [
        (1, "one two three four five six", "a"), (1, "quite another text of seven words here", "b"), (2, long, "c"), (3, long, "d"),
        (3, "unlinked words that belong to nobody else at all", "e"), (4, "", "f"), (4, "", "f"), (5, None, "g"), (None, None, "h"), (None, long, "i"),
        (None, "only this one has no id and its own words", "j"), (6, "twice the very same row with words", "k"), (6, "twice the very same row with words", "k"),
    ]
    df = ready(spark).createDataFrame(
        [(*r, "x", True, 1, "y", "z") for r in rows], "doc_id long, text string, _rank string, _mark string, _key boolean, key int, row string, rank string"
    )
    kept = sorted(((r.doc_id, r.text, r._rank) for r in jaccard.one_per_component(df).collect()), key=str)
    assert kept == sorted([r for i, r in enumerate(rows) if i not in (3, 9, 12)], key=str)
    docs = df.withColumn("_id", F.lit("s")).withColumn("_label", F.lit("t"))
    labels = df.select("doc_id", (F.col("doc_id") == 1).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    assert toxicity.keep_clean(docs, model).columns == docs.columns
