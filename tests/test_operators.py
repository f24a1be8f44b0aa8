import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowwarden.operators import labels, metrics, quantiles, ranking, sampling
from flowwarden.plans import features, score, train


@pytest.mark.parametrize("kind", ["even", "ties", "tail", "constant", "two"])
def test_exact_quantiles_by_brackets(spark, kind):
    """Whatever a bracket may hold, the quantiles equal numpy's; nulls and NaN are left out."""
    draw = random.Random(7)
    make = {
        "two": lambda: float(draw.random() < 0.5),
        "even": lambda: draw.random(),
        "ties": lambda: 5.0 if draw.random() < 0.4 else draw.random() * 10,
        "tail": lambda: draw.paretovariate(0.5),
        "constant": lambda: 3.0,
    }[kind]
    values = [make() for _ in range(20_000)]
    rows = [(v, -v) for v in values] + [(None, float("nan"))] * 10
    df = spark.createDataFrame(rows, "a double, b double").repartition(6).cache()
    probs = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    for limit in (quantiles.BRACKET_ROWS, 50, 1):
        got = quantiles.exact_quantiles(df, ["a", "b"], probs, bracket_rows=limit)
        assert got["a"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
        assert got["b"] == pytest.approx(list(np.quantile([-v for v in values], probs)), rel=1e-12)
    df.unpersist()


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    for limit in (100, 1):
        assert quantiles.exact_quantiles(df, ["a", "b"], [0.5], limit) == {"a": [1.5], "b": [None]}
    assert quantiles.exact_quantiles(df, [], [0.5]) == {}


def test_quantiles_take_three_scans(spark, monkeypatch):
    """However many columns and quantiles, unless a bracket stays too large for one task; a wrong sketch costs one more."""
    scans, narrow, pick = [], quantiles._narrow, quantiles._pick
    monkeypatch.setattr(quantiles, "_narrow", lambda *a: scans.append("narrow") or narrow(*a))
    monkeypatch.setattr(quantiles, "_pick", lambda df, v, t: scans.append("pick") or pick(df, v, t))
    df = spark.range(50_000).select(((F.col("id") * 7919) % 50_021).alias("a"), (F.col("id") % 3).alias("b"), F.lit(None).cast("int").alias("c d"))
    want = {"a": sorted(i * 7919 % 50_021 for i in range(50_000)), "b": sorted(i % 3 for i in range(50_000))}
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    want = {**{c: list(np.quantile(v, probs)) for c, v in want.items()}, "c d": [None] * 5}
    assert quantiles.exact_quantiles(df, ["a", "b", "c d"], probs) == want
    assert scans == ["narrow", "pick"]
    scans.clear()
    monkeypatch.setattr(quantiles, "MARGIN", 1e-9)  # as if the sketches were far off
    monkeypatch.setattr(quantiles, "SKETCH", 8)
    assert quantiles.exact_quantiles(df, ["a", "b", "c d"], probs) == want
    assert scans.count("pick") <= 2


def test_top_n_of_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"),
        ((F.col("id") * 7919) % 30_011).alias("rank"),
    ).repartition(16)
    got = ranking.top_n_per_key(df, ["key"], [F.col("rank").asc()], 5, salts=4)
    pdf = df.toPandas()
    want = pdf.sort_values("rank").groupby("key").head(5)
    key = lambda frame: sorted(map(tuple, frame[["key", "rank"]].itertuples(index=False, name=None)))
    assert key(got.toPandas()) == key(want)


def test_top_n_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), "id")
    plan = ranking.top_n_per_key(df, ["key"], [F.col("id").asc()], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_last_write(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "k int, seq int, v string")
    assert sorted(map(tuple, ranking.last_write(df, ["k"], ["seq"]).collect())) == [(1, 3, "c"), (2, 1, "z")]


def test_type_filter_keeps_exact_count(spark):
    rows = [(i, f"2026-01-01 00:{i:02d}:00", "DoS" if i % 10 == 0 else "Worms") for i in range(60)]
    df = spark.createDataFrame(rows, "alert_id int, alert_time string, attack_type string")
    assert [r.alert_id for r in ranking.latest_of_type(df, "dos", 4).collect()] == [50, 40, 30, 20]
    assert [r.alert_id for r in ranking.latest_of_type_bounded(df, "DOS", 4).collect()] == [50, 40]


def test_sort_for_display(spark):
    rows = [("1", "t", "0.5", "b"), ("2", "t", "bad", "A"), ("3", "t", None, None)]
    df = spark.createDataFrame(rows, "alert_id string, alert_time string, binary_probability string, severity string")
    ids = lambda d: [r.alert_id for r in d.collect()]
    assert ids(ranking.sort_for_display(df, "binary_probability", False)) == ["1", "2", "3"]
    assert ids(ranking.sort_for_display(df, "severity", True)) == ["3", "2", "1"]


def test_label_codes(spark):
    df = spark.range(2000).select(F.concat(F.lit("v"), ((F.col("id") * 31) % 400).cast("string")).alias("c"))
    codes = {r.c: r.code for r in labels.label_codes(df, "c").collect()}
    assert codes == {v: i for i, v in enumerate(sorted(codes))} and len(codes) == 400
    assert labels.label_codes(df.where("false"), "c").collect() == []


def test_fallback_codes(spark):
    df = spark.createDataFrame([("tcp", None), (None, "ssh"), ("none such", "-")], "proto string, service string")
    rows = labels.with_fallback_codes(df, ["proto", "service", "state"]).collect()
    assert {(r.proto_code, r.service_code, r.state_code) for r in rows} == {(1.0, 0.0, 0.0), (0.0, 7.0, 0.0), (0.0, 1.0, 0.0)}


def test_encode_keeps_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    encoded, _ = labels.encode_labels(df, "c", "code")
    assert {r.c: r.code for r in encoded.collect()} == {"a": 0, "b": 1, None: None}


def test_exact_split(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 == 0, "rare").when(F.col("id") % 7 > 1, "common").alias("s"))
    train, test = sampling.split_train_test(df, "id", "s", 0.2)
    counts = {r.s: r["count"] for r in test.groupBy("s").count().collect()}
    assert counts == {"rare": 143, "common": 714, None: 143}
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert sampling.split_train_test(df, "id", "absent", 0.2)[1].count() == 1000
    assert sampling.split_train_test(df.where("false"), "id", "s", 0.2)[1].count() == 0


def test_equal_hashes_split_by_key(spark, monkeypatch):
    monkeypatch.setattr(sampling, "hash_rank", lambda key: F.lit(7).cast("bigint"))
    df = spark.range(100).select("id", (F.col("id") % 2).alias("s"))
    test = sampling.split_train_test(df, "id", "s", 0.2)[1]
    assert sorted(r.id for r in test.collect()) == list(range(20))


def test_many_strata(spark):
    df = spark.range(6000).select("id", (F.col("id") % 2000).alias("s"))
    assert sampling.split_train_test(df, "id", "s", 0.2)[1].count() == 1200


def test_strata_sizes_add_up(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 3), ("c", 5)], "s string, n bigint")
    assert {r.s: r.wanted for r in sampling.strata_test_sizes(counts, 0.2).collect()} == {"a": 1, "b": 1, "c": 1}


def test_last_by_order(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y"), (None, 4, "u"), (None, 5, "v")], "k string, seq bigint, v string")
    assert sorted(r.v for r in ranking.last_by_order(df, ["k"], "seq").collect()) == ["v", "y", "z"]


def test_attack_filters(spark):
    rows = [(0, 0.1, None), (1, 0.95, "DoS"), (1, 0.88, "Exploits"), (0, 0.2, None), (1, 0.76, "Fuzzers")]
    df = spark.createDataFrame(rows, "binary_prediction int, binary_probability double, attack_type string")
    assert score.attacks(df).count() == 3
    assert score.normals(df).count() == 2
    assert score.high_confidence(df).count() == 2


def test_metrics_by_hand(spark):
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(2.0, 1.0)]
    matrix = metrics.confusion(spark.createDataFrame(pairs, "label double, prediction double"))
    one = metrics.positive_f1(matrix).first()
    assert one.precision == 0.5 and one.recall == 1.0 and one.binary_f1 == pytest.approx(2 / 3)
    assert metrics.overall_metrics(matrix).first().accuracy == pytest.approx(8 / 11)
    report = {r["class"]: r for r in metrics.class_report(matrix).collect()}
    assert report[2.0].support == 1 and report[2.0].f1 == 0.0


@pytest.mark.parametrize("kind", ["few scores", "all different", "one score", "no negatives", "no rows"])
def test_areas_equal_the_trapezoids(spark, kind):
    draw = random.Random(11)
    rows = [(float(draw.random() < 0.3), round(draw.random(), 1 if kind == "few scores" else 9)) for _ in range(3000)]
    rows = {"one score": [(y, 0.5) for y, _ in rows], "no negatives": [(1.0, s) for _, s in rows], "no rows": []}.get(kind, rows)
    df = spark.createDataFrame(rows, "label double, score double").repartition(7)
    got = metrics.areas(df)
    tp = fp = roc = pr = 0
    p, q, last = sum(y for y, _ in rows), sum(1 - y for y, _ in rows), None
    for s in sorted({s for _, s in rows}, reverse=True):
        pos, neg = sum(1 for y, t in rows if t == s and y), sum(1 for y, t in rows if t == s and not y)
        roc += neg * (2 * tp + pos) / 2
        tp, fp = tp + pos, fp + neg
        pr += pos * (tp / (tp + fp) + (tp / (tp + fp) if last is None else last)) / 2
        last = tp / (tp + fp)
    assert got["auc_roc"] == pytest.approx(roc / p / q if p and q else 0.0)
    assert got["auc_pr"] == pytest.approx(pr / p if p else 0.0)


def test_sampled_rows_keep_every_class(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") < 30, 2.0).when(F.col("id") < 4000, 1.0).otherwise(0.0).alias("label"), "id", F.lit(1.0).alias("weight")
    )
    got = {r.label: (r.n, r.w) for r in train.sampled(rows, "label", "weight", 1000).groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert got[2.0][0] == 30 and abs(got[1.0][0] - 198) < 60 and abs(got[0.0][0] - 800) < 120
    assert got[2.0][1] == pytest.approx(1.5) and got[1.0][1] == got[1.0][0]
    assert train.sampled(rows, "label", None, None).count() == 20_000


def test_index_by_frequency_like_the_fitted_indexer(spark):
    """Hot values, ties, nulls and values that the training rows lack."""
    rows = spark.range(9000).select(
        F.when(F.col("id") < 4000, "hot").when(F.col("id") < 6000, "warm").when(F.col("id") >= 8990, F.lit(None))
        .otherwise(F.concat(F.lit("v"), (F.col("id") % 700).cast("string"))).alias("proto"), "id",
    )
    some = rows.where("proto is null or proto <> 'v3'")
    want = {r.id: r.proto_idx for r in features.indexer(["proto"]).fit(some).transform(rows).collect()}
    codes = labels.frequency_codes(some, "proto")
    got, _ = labels.index_by_frequency(rows, "proto", "idx", codes)
    assert got.columns == ["proto", "id", "idx"] and {r.id: r.idx for r in got.collect()} == want
    assert labels.index_by_frequency(rows.limit(0), "proto", "idx")[0].count() == 0


def test_rules_decide_rows_at_one_half_in_one_order(spark):
    """The linear part of these rows is zero but for rounding: the bias comes last in the columns, in numpy and in the SQL."""
    values = [(272.0, 1.0, 335.0), (278.0, 1.0, 344.0), (280.0, 1.0, 347.0), (300.0, 1.0, 20.0), (0.0, 40.0, 0.0)]
    weights = [score.RULE_WEIGHTS[c] for c in score.RULE_FEATURES]
    expected = [int(1 / (1 + np.exp(-(r * weights[0] + s * weights[1] + d * weights[2] + score.RULE_BIAS))) >= 0.5) for r, s, d in values]
    rows = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, rate double, sbytes double, dur double")
    found = score.rule_scores(rows, include_normal=True).orderBy("i").collect()
    assert [r.binary_prediction for r in found] == expected == [0, 0, 0, 1, 1]
    for size in (1, 2, len(values)):
        parts = [score.NumpyRules()(np.array(values[i : i + size])) for i in range(0, len(values), size)]
        assert [int(p >= 0.5) for part in parts for p in part["binary_probability"]] == expected
