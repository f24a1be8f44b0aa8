"""Models are fitted on every row, and forests grow alike in memory and by histograms."""

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.parquet
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from flowwarden.operators import metrics
from flowwarden.plans import features, forests, grow, train
from flowwarden.queries import models
from flowwarden.session import work_path


def _rows(spark, n):
    h = lambda s, m: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(m)).cast("double")
    rows = spark.range(n).select(
        *[h(i, 100 * i + 1).alias(c) for i, c in enumerate(models.FLOW_FEATURES, 1)],
        *[F.concat(F.lit("v"), h(i, k).cast("int").cast("string")).alias(c) for i, (c, k) in enumerate({"proto": 4, "service": 20, "state": 2}.items(), 7)],
        h(10, 100).alias("noise"),
    )
    kind = F.when(F.col("proto") == "v0", 1).when(F.col("service").isin("v3", "v7", "v12"), 3).otherwise(4)
    right = (F.col("dur") > 40) & (F.col("sbytes") < 300)
    binary = F.when(F.col("noise") < 10, 1 - right.cast("int")).otherwise(right.cast("int"))
    return rows.select("*", binary.cast("double").alias("binary_label"), F.when(F.col("noise") < 5, 4).otherwise(kind).cast("double").alias("class_label")).drop("noise")


@pytest.mark.parametrize("name", ["forest", "gbt", "category", "plain_gbt", "plain_category"])
def test_models_are_fitted_on_every_row(spark, monkeypatch, name):
    """Not on a sample of a thousand: the roots of the trees have counted all training rows."""
    small, boosted = {"numTrees": 20, "maxDepth": 2}, {"maxIter": 1, "maxDepth": 2}
    for params, value in {"BINARY_FOREST": small, "CATEGORY_FOREST_GRID": [small], "PLAIN_FOREST": small, "BINARY_GBT_GRID": [boosted], "PLAIN_GBT": boosted}.items():
        monkeypatch.setattr(train, params, value)
    rows, n = _rows(spark, 6000).cache(), 6000
    model = models._FITS[name]((rows, rows)).model.stages[-1]
    if "gbt" in name:
        assert model.trees[0]._java_obj.rootNode().impurityStats().rawCount() == n
    else:
        assert model.about["rows"] / model.about["trees"] == pytest.approx(n, rel=0.02)


def test_forests_tell_classes_apart_as_sparks_do(spark):
    """Noise, weights, categories by subsets and by order: as many rows right as with Spark's own forest of these parameters."""
    rows = _rows(spark, 8000).cache()
    train_rows, test_rows = rows.where(F.xxhash64(*rows.columns) % 4 != 0), rows.where(F.xxhash64(*rows.columns) % 4 == 0)
    params = {"numTrees": 40, "maxDepth": 10, "maxBins": 64, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"}
    ours = train.fit_category_forest(train_rows, test_rows, models.FLOW_FEATURES, grid=[params], weighted=False)
    prepared = PipelineModel(ours.model.stages[:-1])
    spark_forest = RandomForestClassifier(featuresCol="features_mc", labelCol="class_label", seed=1, **params).fit(prepared.transform(train_rows))
    theirs = metrics.overall_metrics(metrics.confusion(spark_forest.transform(prepared.transform(test_rows)), "class_label", "prediction")).first()
    assert ours.metrics["accuracy"] > 0.9 and abs(ours.metrics["accuracy"] - theirs["accuracy"]) < 0.03
    nodes = ours.model.stages[-1].totalNumNodes
    assert 0.7 < nodes / spark_forest.totalNumNodes < 1.4
    importances = ours.model.stages[-1].featureImportances.toArray()
    assert importances.sum() == pytest.approx(1) and set(importances.argsort()[-2:]) == {6, 7}


def test_walked_and_masked_forests_agree(spark):
    """Also for values out of range, and after the model was saved and loaded."""
    rows = _rows(spark, 3000)
    model = train.fit_category_forest(rows, rows, models.FLOW_FEATURES, grid=[{"numTrees": 15, "maxDepth": 12, "maxBins": 64}]).model
    train.save(model, path := work_path(spark, "grown"))
    last, again = model.stages[-1], train.load_models({"m": path})["m"].stages[-1]
    x = np.random.default_rng(1).normal(size=(500, 9)) * 2
    x[:, 6:] = np.random.default_rng(2).integers(-1, 25, size=(500, 3))
    x[0, 0], x[1, 6] = np.nan, 0.5
    masked, walked = forests.packed(last, spark).votes(x), forests.WalkedForest(again.path, again.about).votes(x)
    assert (masked == walked).all() and len(set(walked.argmax(axis=1))) > 1
    assert again.getProbabilityCol() == "category_probs" and again.uid == last.uid and again.featureImportances == last.featureImportances


def _table(folder, n=4000):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.integers(0, 60, n), rng.integers(0, 60, n), rng.integers(0, 5, n), rng.integers(0, 30, n)]).astype("int16")
    y = np.where(x[:, 3] % 7 == 2, 2, np.where((x[:, 0] > 25) ^ (x[:, 2] == 3), 4, 9)).astype("int16")
    y[rng.random(n) < 0.2] = 2
    for i, part in enumerate(np.array_split(np.arange(n), 3)):
        pyarrow.parquet.write_table(pa.table({**{f"f{j}": x[part, j] for j in range(4)}, "label": y[part]}), f"{folder}/part-{i}.parquet")
    return grow.Plan(
        path=str(folder), classes=3, weights=(1.0, 0.5, 2.0), names=(2, 4, 9), arity=(0, 0, 5, 30), bins=(60, 60, 5, 30), tries=4, depth=9, least=2, most_bins=64, seed=42
    )


@pytest.mark.parametrize("rows, cells", [(3000, 1 << 22), (150, 1 << 22), (150, 1000)])
def test_trees_are_the_same_by_histograms_and_in_memory(tmp_path, monkeypatch, rows, cells):
    plan = _table(tmp_path)
    monkeypatch.setattr(grow, "BATCH", 700)
    whole = grow._packed(plan, 3, grow._tree(plan, 3))
    monkeypatch.setattr(grow, "ROWS", rows)
    monkeypatch.setattr(grow, "CELLS", cells)
    parts = grow._packed(plan, 3, grow._tree(plan, 3))
    assert whole["leaves"] > 50 and {k: v for k, v in whole.items() if k != "importance"} == {k: v for k, v in parts.items() if k != "importance"}
    assert whole["importance"] == pytest.approx(parts["importance"])


def test_sides_have_enough_rows_and_depth_ends(tmp_path):
    plan = dataclasses.replace(_table(tmp_path), least=40, depth=4)
    tree = grow._tree(plan, 0)
    assert tree["stats"].sum(axis=1).min() >= 40 and tree["depth"].max() == 4
    inner = tree["left"] >= 0
    assert (tree["stats"][inner] == tree["stats"][tree["left"][inner]] + tree["stats"][tree["right"][inner]]).all()


def test_rows_without_label_are_named(spark):
    rows = _rows(spark, 50).withColumn("binary_label", F.when(F.col("dur") > 50, F.col("binary_label")))
    with pytest.raises(ValueError, match="binary_label is no class"):
        train.fit_binary_forest(rows, rows, ["dur"], params={"numTrees": 1})


def test_few_values_are_cut_between_and_many_at_quantiles(spark):
    from flowwarden.plans.forest_model import Binned

    rows = spark.range(5000).select((F.col("id") % 3).cast("double").alias("few"), F.col("id").cast("double").alias("many"), F.lit(1.0).alias("one"), (F.col("id") % 2).alias("label"))
    prepared = features.fit_stages(features.binary_stages(["few", "many", "one"]), rows)
    binned = Binned(rows, "label", [(c, 0.0, 1.0) for c in prepared.stages[0].getInputCols()], [0, 0, 0])
    few, many, one = binned.cuts(10)
    assert few == [0.5, 1.5] and one == []
    assert len(many) == 9 and np.allclose(many, np.arange(500, 5000, 500), atol=5)
