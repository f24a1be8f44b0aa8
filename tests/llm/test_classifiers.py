import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowwarden.llm import toxicity, url_filter
from flowwarden.llm.common import ready, table
from flowwarden.llm.queries import QUERIES, held_out

RULES = dict(url_filter.RULES)


def by_hand(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]) if found else ("", "")
    fits = [r for r in RULES if (host + "/").endswith("." + r.split("/")[0] + "/") or host == r.split("/")[0]]
    fits = [r for r in fits if path.startswith(r[r.index("/") :])]
    return host, path, max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "http://ORG/", "http://a.org", "http://a.org/x?y#z", "https://example.org/es/1", "http://x.example.org/en/1?a=1",
    "http://x.example.org/en/2", "http://myorg/", "http://a.com/fr/", "http://a.com/de/9", "http://acom/de/", "x://y://z/q", "http://É.Org/É", "http://a.org:80/x",
    "http://a.com?u=http://b.org/", "http://a.net/" + "x/" * 20_000, "http://a.org/", "http://a.org/",
]


def test_rules(spark):
    rows = [(i, u, "h", "v") for i, u in enumerate(URLS)]
    df = ready(spark).createDataFrame(rows, "page_id long, url string, host string, verdict string")
    model = url_filter.train(url_filter.rule_labels(df))
    got = {r["page_id"]: r for r in url_filter.judge(df, model).collect()}
    for i, u in enumerate(URLS):
        host, path, rule = by_hand(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == RULES[rule] if rule else got[i]["verdict"] in ("allow", "block")
    none = df.where("false")
    assert url_filter.judge(none, url_filter.train(url_filter.rule_labels(none))).collect() == []
    unlabelled = url_filter.train(url_filter.rule_labels(df.where("url is null")))
    assert {r["verdict"] for r in url_filter.judge(df, unlabelled).where("rule is null").collect()} == {"allow"}


def test_trees_learn_unseen_urls(spark):
    pages = table(ready(spark), "/root/testdata/sf0.1", "pages").select("page_id", "url")
    bad = F.col("url").rlike(r"cheap-pills|free-bets|ads-track|\?.*&.*=")
    rows = pages.withColumn("blocked", bad.cast("int")).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(4)))
    model = url_filter.train(rows.where("fold > 0"))
    test = model.block_scores(rows.where("fold = 0")).select("blocked", "block_score").toPandas()
    assert ((test["block_score"] >= 0.5) == (test["blocked"] == 1)).mean() > 0.95


def test_entropy(spark):
    rows = [("aaaa", 0.0), ("abab", 1.0), ("", 0.0), ("abcd", 2.0)]
    df = spark.createDataFrame(rows, "url string, want double")
    for r in url_filter.lexical(df).collect():
        assert r["_entropy"] == pytest.approx(r["want"])


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r[0]: r[1] for r in table(spark, sf, "labels").select("doc_id", "toxic").collect()}
    rows = [r for r in QUERIES["op3_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    hit = [r["predicted"] for r in rows if labels[r["doc_id"]]]
    wrong = [r["predicted"] for r in rows if not labels[r["doc_id"]]]
    assert np.mean(hit) > 0.7 and np.mean(wrong) < 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    sf = "/root/testdata/sf0.1"
    return toxicity.train(table(ready(spark), sf, "documents"), table(spark, sf, "labels").where(~held_out()))


def test_misspellings_and_position(model):
    plain = "of the and to in this it " * 300
    texts = [plain, plain + "idiot moron trash", "scum loser " + plain, "stupid idiot " * 2, "idiott moronn sstupid trashh", ""]
    odds = model.log_odds(pa.array(texts))
    assert odds[0] < -1 and (odds[1:4] > 0).all() and odds[4] > odds[0] + 1 and odds[5] == model.prior


def test_toxicity_edges(edges, nothing, model):
    got = toxicity.score(edges, model, ("doc_id", "score", "n")).collect()
    assert len(got) == edges.count()
    clean = [str(r["doc_id"]) for r in toxicity.score(edges, model).where("predicted = 0").collect()]
    assert sorted(str(r["doc_id"]) for r in toxicity.keep_clean(edges, model).collect()) == sorted(clean)
    assert toxicity.score(nothing, model).collect() == [] and toxicity.keep_clean(nothing, model).collect() == []
    labels = nothing.select("doc_id", F.lit(1).alias("toxic"))
    assert {r["predicted"] for r in toxicity.score(edges, toxicity.train(edges, labels)).collect()} == {0}
    ones = edges.select("doc_id", F.lit(1).alias("toxic"))
    assert {r["predicted"] for r in toxicity.score(edges, toxicity.train(edges, ones)).collect()} == {1}


def test_score_ignores_other_columns(spark, model):
    rows = [(1, "idiot trash", "src0", "en"), (2, "idiot trash", "src9", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    assert len({r["score"] for r in toxicity.score(df, model).collect()}) == 1


def test_place_of_a_phrase_changes_nothing(model):
    odds = model.log_odds(pa.array(["idiot trash of", "the idiot trash of", "a the idiot trash of", "of a the idiot trash of"]))
    assert (odds[1:] >= odds[0] - 1e-9).all() and odds[0] > 0
    assert abs(odds[2] - odds[3]) < 1e-9


def test_one_id_on_many_rows_keeps_both_classes(spark, monkeypatch):
    """Rows are sampled one by one: a repeated id neither fills the sample nor leaves it."""
    ready(spark)
    docs = spark.range(6000).select(
        F.when(F.col("id") < 5000, 1).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("stupid idiot number "), "id").alias("text"), "id"
    )
    docs = docs.withColumn("text", F.when(F.col("id") < 5000, F.col("text")).otherwise(F.concat(F.lit("the clear day "), "id"))).withColumnRenamed("id", "_id")
    labels = docs.select("doc_id", (F.col("doc_id") == 1).cast("int").alias("toxic")).distinct()
    seen = []
    monkeypatch.setattr(toxicity, "MAX_TRAIN", 500)
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, prior: seen.append((len(texts), labels.sum())))
    toxicity.train(docs, labels)
    rows, bad = seen[0]
    assert 350 < bad < 650 and 350 < rows - bad < 650
    monkeypatch.setattr(toxicity, "MAX_TRAIN_BYTES", 10)
    toxicity.train(docs, labels)
    assert 2 <= seen[1][0] < 10 and 1 <= seen[1][1] < seen[1][0]
