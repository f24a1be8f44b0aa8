import pytest
from pyspark.sql import functions as F

from flowwarden.plans import features, forests, score, train
from flowwarden.session import work_path


@pytest.fixture(scope="module")
def flows(spark):
    noise = F.xxhash64("id") % 100 / 100.0
    return spark.range(600).select(
        (F.col("id") % 10).cast("double").alias("dur"), noise.alias("rate"),
        F.when(F.col("id") % 3 == 0, "tcp").when(F.col("id") % 3 == 1, "udp").alias("proto"),
        F.lit("-").alias("service"), F.lit("FIN").alias("state"),
        (F.col("id") % 10 >= 5).cast("double").alias("binary_label"),
        F.when(F.col("id") % 10 < 5, 0.0).when(F.col("id") % 10 < 8, 1.0).otherwise(2.0).alias("class_label"),
    ).cache()


def test_cascade_from_saved_models(spark, flows):
    names = ["dur", "rate", "absent"]
    rows = flows.withColumn("absent", F.lit(0.0))
    small = {"numTrees": 3, "maxDepth": 3}
    binary = train.fit_binary_forest(rows, rows, names, params=small)
    category = train.fit_category_forest(rows, rows, names, grid=[small])
    assert binary.metrics["accuracy"] > 0.95 and category.metrics["accuracy"] > 0.95
    paths = {n: work_path(spark, n) for n in ("binary", "category")}
    train.save(binary.model, paths["binary"])
    train.save(category.model, paths["category"])
    models = train.load_models(paths)
    dirty = flows.withColumn("dur", F.when(F.col("dur") == 9, float("nan")).otherwise(F.col("dur")))
    only = score.cascade(dirty, models["binary"], models["category"], names, {1: "DoS"})
    everything = score.cascade(dirty, models["binary"], models["category"], names, {1: "DoS"}, include_normal=True)
    assert everything.count() == 600
    found = {r.attack_type: r["count"] for r in only.groupBy("attack_type").count().collect()}
    assert set(found) == {"DoS", "Unknown"}
    kinds = {(r.binary_prediction, r.attack_type) for r in everything.select("binary_prediction", "attack_type").distinct().collect()}
    assert kinds == {(0.0, "Normal"), (1.0, "DoS"), (1.0, "Unknown")}
    alerts = score.to_alerts(only)
    assert len(alerts.columns) == 13 and {r.severity for r in alerts.collect()} == {"high", "medium"}


def test_missing_models_are_named(spark):
    with pytest.raises(FileNotFoundError, match="binary.*category"):
        train.load_models({"binary": "/none/such", "category": "/none/such-either"})


def test_first_of_equal_scores_wins(flows):
    grid = [{"maxIter": 1, "maxDepth": 4}, {"maxIter": 1, "maxDepth": 5}]
    rows = flows.select("dur", "binary_label")
    assert train.fit_binary_gbt(rows, rows, ["dur"], grid=grid).params == grid[0]


def test_bins_hold_unseen_values(flows):
    fitted = features.indexer().fit(flows)
    assert features.required_bins(fitted) == 3


def test_feature_names_fall_back_to_positions(spark, flows):
    model = train.fit_binary_forest(flows, flows, ["dur", "rate"], params={"numTrees": 2, "maxDepth": 2}).model
    assert train.top_features(spark, model, ["dur", "rate"]).first().feature == "dur"
    assert train.top_features(spark, model, ["only-one"]).first().feature == "feature_0"


@pytest.mark.parametrize("depth, trees", [(2, 3), (12, 150)])
def test_packed_forests_vote_as_spark_does(spark, depth, trees):
    """Bit by bit, with more leaves than a word has, splits on categories, one value in no split and values on thresholds."""
    h = lambda s, m: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(m)).cast("double")
    rows = spark.range(3000).select(
        h(1, 1000).alias("dur"), (h(2, 7) / 3).alias("rate"), h(3, 40).alias("sload"),
        *[F.concat(F.lit("v"), h(i, n).cast("int").cast("string")).alias(c) for i, (c, n) in enumerate({"proto": 9, "service": 4, "state": 1}.items(), 4)],
    ).withColumn("class_label", F.pmod(F.floor(F.col("dur") / 90) + F.length("proto") + F.col("sload").cast("int"), F.lit(11)).cast("double"))
    grid = [{"numTrees": trees, "maxDepth": depth, "maxBins": 64}]
    model = train.fit_category_forest(rows, rows, ["dur", "rate", "sload"], grid=grid).model
    unseen = rows.withColumn("proto", F.when(F.col("dur") < 300, "new").otherwise(F.col("proto")))
    plain, packed = (m.select("category_probs", "category_prediction").collect() for m in (model.transform(unseen), forests.transform(model, unseen)))
    assert plain == packed
    assert depth == 2 or forests.packed(model.stages[-1], spark).blocks[0][0].shape[2] > 1


def test_packed_forest_of_single_leaves(spark, flows):
    rows = flows.withColumn("absent", F.lit(0.0))
    one = train.fit_binary_forest(rows, rows, ["absent"], params={"numTrees": 2, "maxDepth": 1}).model
    plain, packed = (m.select("binary_probs", "binary_prediction").collect() for m in (one.transform(rows), forests.transform(one, rows)))
    assert plain == packed


def test_models_fit_on_rows_that_are_written_once(spark, sf):
    from flowwarden.operators import sampling
    from flowwarden.plans import bindings
    from flowwarden.queries import models

    first, again = models._splits(spark, sf), models._splits(spark, sf)
    read = [set(part.inputFiles()) for part in (*first, *again)]
    assert all(files == read[0] for files in read) and not any(sf in f for f in read[0])
    raw = bindings.raw_flows(spark, sf)
    direct = sampling.split_by_hash(raw.withColumn("_key", F.xxhash64(*raw.columns)), "_key", models.TEST_SHARE)
    assert [p.count() for p in first] == [p.count() for p in direct]
    assert first[1].agg(F.sum("sbytes")).first() == direct[1].agg(F.sum("sbytes")).first()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_forests_take_numbers_and_no_vectors(spark, flows):
    """Vectors are a call per row and stage; they are made where somebody reads them only, and give the same scores."""
    rows = flows.withColumn("dur", F.when(F.col("dur") == 9, float("nan")).when(F.col("dur") == 8, None).otherwise(F.col("dur")))
    small = {"numTrees": 5, "maxDepth": 4}
    binary = train.fit_binary_forest(flows, flows, ["dur", "rate"], params=small).model
    category = train.fit_category_forest(flows, flows, ["dur", "rate"], grid=[small]).model
    scored = score.score_binary(rows, binary, ["dur", "rate"])
    assert "UDF(" not in _plan(scored.groupBy("binary_prediction").agg(F.sum("binary_probability")))
    both = score.cascade(rows, binary, category, ["dur", "rate"])
    assert "features_vec" in both.columns and "UDF(named_struct" not in _plan(both.select("attack_type", "binary_probability"))
    plain = binary.transform(score.clean_features(rows, ["dur", "rate"])).select("binary_probs", "binary_prediction", "features_vec").collect()
    ours = scored.select("binary_probability", "binary_prediction", "features_vec").collect()
    assert [(r[0][1], r[1], r[2]) for r in plain] == [tuple(r) for r in ours]


def test_other_models_score_through_spark(spark, flows):
    model = train.fit_binary_gbt(flows, flows, ["dur", "rate"], grid=[{"maxIter": 2, "maxDepth": 2}]).model
    plain = model.transform(flows).select("binary_probs", "binary_prediction").collect()
    ours = score.score_binary(flows, model, ["dur", "rate"]).select("binary_probability", "binary_prediction").collect()
    assert [(r[0][1], r[1]) for r in plain] == [tuple(r) for r in ours]


@pytest.mark.parametrize("depth, words", [(3, 1), (14, 2)])
def test_two_classes_vote_as_spark_does(spark, depth, words):
    """Bit by bit, and blocks of trees work with as many words of masks as their own leaves need."""
    h = lambda s, m: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(m)).cast("double")
    rows = spark.range(5000).select(h(1, 1000).alias("dur"), (h(2, 700) / 3).alias("rate"), h(3, 2).alias("binary_label"))
    model = train.fit_binary_forest(rows, rows, ["dur", "rate"], params={"numTrees": 40, "maxDepth": depth, "maxBins": 64}).model
    plain, packed = (m.select("binary_probs", "binary_prediction").collect() for m in (model.transform(rows), forests.transform(model, rows)))
    assert plain == packed
    planes = forests.packed(model.stages[-1], spark).planes
    assert len(planes) == 3 and all((len(block) > 1) == (words > 1) for block in planes)
    assert all(table.ndim == 2 and table.flags.c_contiguous for block in planes for tables in block for table in tables)


def test_preparation_is_fitted_from_plain_columns(spark, flows):
    """The same preparation as by vectors, for several columns, one that is constant and the categories."""
    rows = flows.withColumns({"absent": F.lit(3.0), "big": 1e6 + F.col("rate")})
    stages = features.category_stages(["dur", "rate", "absent", "big"])
    plain, ours = stages.fit(rows), features.fit_stages(stages, rows)
    for of in ("mean", "std"):
        assert getattr(ours.stages[1], of).toArray() == pytest.approx(getattr(plain.stages[1], of).toArray(), rel=1e-9, abs=1e-12)
    assert ours.stages[1].std[2] == 0 and ours.stages[2].labelsArray == plain.stages[2].labelsArray
    one = features.fit_stages(features.binary_stages(["dur"]), rows.limit(1))
    assert one.stages[1].std[0] == 0


def test_written_rows_hold_what_fits_use(spark, sf):
    from flowwarden.queries import models

    used = {"binary_label", "class_label", "proto", "service", "state", *models.FLOW_FEATURES}
    assert all(set(part.columns) == used for part in models._splits(spark, sf))


def test_fits_score_test_rows_without_vectors(spark, flows, monkeypatch):
    plans, evaluate = [], train.evaluate_category
    seen = lambda scored, label: plans.append(_plan(scored.groupBy(label).agg(F.max("_found.said")))) or evaluate(scored, label)
    monkeypatch.setattr(train, "evaluate_category", seen)
    train.fit_category_forest(flows, flows, ["dur", "rate"], grid=[{"numTrees": 3, "maxDepth": 3}])
    assert len(plans) == 1 and "ArrowEvalPython" in plans[0] and "UDF(named_struct" not in plans[0]
    assert plans[0].count("InMemoryRelation") == 1  # the table given; one candidate needs no copy of it


def test_forests_side_by_side_read_rows_once(spark, flows):
    other = flows.withColumn("binary_label", 1 - F.col("binary_label"))
    some, more = (train.fit_binary_forest(rows, rows, ["dur", "rate"], params={"numTrees": 3, "maxDepth": 4}).model for rows in (flows, other))
    both = forests.side_by_side({"a": some, "b": more}, flows)
    assert _plan(both.groupBy("a.said").agg(F.count_if(F.col("b.said") == 1))).count("ArrowEvalPython") == 1
    apart = [m.transform(flows).select("binary_probs").collect() for m in (some, more)]
    assert [(r.a.probs, r.b.probs) for r in both.collect()] == [(list(x[0]), list(y[0])) for x, y in zip(*apart)]
    assert apart[0] != apart[1]
    category = train.fit_category_forest(flows, flows, ["dur"], grid=[{"numTrees": 2, "maxDepth": 2}]).model
    with pytest.raises(ValueError, match="c is no forest over"):
        forests.side_by_side({"a": some, "c": category}, flows)
