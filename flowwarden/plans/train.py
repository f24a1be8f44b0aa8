"""Model training, selection and comparison."""

from __future__ import annotations

import functools
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowwarden.operators import metrics
from flowwarden.operators.labels import class_weights, with_weights
from flowwarden.plans import forest_model
from flowwarden.plans.features import binary_stages, category_stages, fit_stages, required_bins
from flowwarden.plans.forests import numbers_of, with_scores
from flowwarden.schemas import CATEGORICALS

# Training parameters.
BINARY_FOREST = {
    "numTrees": 200, "maxDepth": 18, "maxBins": 64, "minInstancesPerNode": 3,
    "featureSubsetStrategy": "sqrt",
}
BINARY_GBT_GRID = [
    {"maxIter": 80, "maxDepth": 8, "stepSize": 0.08},
    {"maxIter": 120, "maxDepth": 8, "stepSize": 0.06},
    {"maxIter": 100, "maxDepth": 10, "stepSize": 0.05},
]
CATEGORY_FOREST_GRID = [
    {"numTrees": 300, "maxDepth": 18, "maxBins": 128, "minInstancesPerNode": 2},
    {"numTrees": 400, "maxDepth": 20, "maxBins": 128, "minInstancesPerNode": 2},
    {"numTrees": 500, "maxDepth": 22, "maxBins": 192, "minInstancesPerNode": 1},
]
PLAIN_GBT = {"maxIter": 200, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8}
PLAIN_FOREST = {"numTrees": 200, "maxDepth": 15}
SEED = 42
ACCURACY_SHARE, F1_SHARE = 0.7, 0.3


@dataclass
class Fitted:
    """A model with every preparation stage in it, and how it did on the test rows."""

    model: PipelineModel
    params: dict
    metrics: dict = field(default_factory=dict)


#: Candidates that are fitted at the same time.
SIDE_BY_SIDE = 3
#: Rows to a partition of the table a model is fitted on, and its fewest partitions: by the rows alone, so that the model does not depend on the cluster.
FIT_ROWS, FIT_PARTITIONS = 100_000, 2


#: Rows of a class that a sample keeps at least, where there are as many.
CLASS_ROWS = 50


def sampled(
    df: DataFrame, label: str, weight: str | None, max_rows: int | None, seed: int = SEED, unweighted: DataFrame | None = None
) -> DataFrame:
    """About ``max_rows`` rows, chosen class by class by a hash of their content. No fit uses it: models are fitted on every row.

    Classes keep their shares, but ``CLASS_ROWS`` rows each; a class of which more is taken than its share weighs as much less, where there are weights.
    ``unweighted`` are the same rows before the weights were joined: counted without the join.
    """
    counts = {r[0]: r[1] for r in (df if unweighted is None else unweighted).groupBy(label).count().collect()}  # one row per class
    total = sum(counts.values())
    if max_rows is None or total <= max_rows:
        return df
    share = max_rows / total
    shares = {c: min(1.0, max(share, CLASS_ROWS / n)) for c, n in counts.items()}
    pick = lambda by: functools.reduce(lambda case, c: case.when(F.col(label).eqNullSafe(F.lit(c)), by(c)), shares, F)
    chance = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(1_000_000))
    some = df.where(chance < pick(lambda c: F.lit(int(1e6 * shares[c]))))
    return some.withColumn(weight, F.col(weight) * pick(lambda c: F.lit(share / shares[c]))) if weight else some


@contextmanager
def _kept(*tables: DataFrame):
    """Tables read by every candidate fit stay on the executors meanwhile."""
    held = [t.persist(StorageLevel.MEMORY_AND_DISK) for t in tables]
    try:
        yield held
    finally:
        for t in held:
            t.unpersist()


def evaluate_binary(scored: DataFrame, label: str) -> dict:
    """ROC and PR area from the scores (``_found`` of ``with_scores``), the rest from the confusion matrix."""
    rows = scored.select(
        F.col(label).cast("double").alias("label"),
        F.col("_found.said").alias("prediction"),
        F.get("_found.probs", F.lit(1)).alias("score"),
    )
    with _kept(rows) as (rows,):
        out = metrics.overall_metrics(metrics.confusion(rows)).first().asDict()
        return {**metrics.areas(rows), **out}


def evaluate_category(scored: DataFrame, label: str) -> dict:
    return metrics.overall_metrics(metrics.confusion(scored, label, "_found.said")).first().asDict()


def _estimator(kind, stage: str, features: str, label: str, weight: str | None, params: dict):
    """A classifier whose output columns are named after its stage, so that two can be chained."""
    if kind is Forest:
        return Forest(features, label, stage, params)
    model = kind(featuresCol=features, labelCol=label, predictionCol=f"{stage}_prediction", seed=SEED, **params)
    model.setProbabilityCol(f"{stage}_probs").setRawPredictionCol(f"{stage}_raw")
    return model.setWeightCol(weight) if weight else model


@dataclass
class Forest:
    """A forest to be grown on plain columns, every tree on all rows."""

    features: str
    label: str
    stage: str
    params: dict

    def fit(self, binned: forest_model.Binned, weights: dict[float, float]) -> forest_model.ForestModel:
        model = forest_model.fit(binned, weights, self.params, SEED)
        columns = {"featuresCol": self.features, "labelCol": self.label, "predictionCol": f"{self.stage}_prediction", "probabilityCol": f"{self.stage}_probs"}
        return model._set(**columns)


@contextmanager
def _rows_to_fit(prepared: PipelineModel, whole: DataFrame, label: str, weight: str | None, classes: int | None, estimator):
    """How the candidates are fitted on all rows: forests on rows cut into bins, written once; others on vectors that stay on the executors meanwhile."""
    if isinstance(estimator, Forest):
        weights = {r[label]: r["weight"] for r in class_weights(whole, label, classes).collect()} if weight else {}  # one row per class
        arity = {c: len(known) + 1 for s in prepared.stages if isinstance(s, StringIndexerModel) for c, known in zip(s.getOutputCols(), s.labelsArray)}
        numbers, rows = numbers_of(prepared.stages, estimator.features), whole
        for stage in prepared.stages:
            rows = stage.transform(rows)
        binned = forest_model.Binned(rows, label, numbers, [arity.get(c, 0) for c, _, _ in numbers])
        yield lambda forest: forest.fit(binned, weights)
        return
    weighed = with_weights(whole, label, weight, classes) if weight else whole
    with _kept(weighed.repartition(max(FIT_PARTITIONS, -(-whole.count() // FIT_ROWS)))) as (every,):
        every.count()  # kept before the threads ask for it
        rows = prepared.transform(every)
        yield lambda estimator: estimator.fit(rows)


def _fit_best(
    stages, candidates, train, test, label, classes, weighted, columns, evaluate, score
) -> Fitted:
    """Fit the preparation, the class weights and every candidate on the whole training split; the first of equal scores wins.

    Candidates are fitted side by side, each from a thread of the driver with the settings of this one, so that the short stages of one fill the
    gaps of the other. The columns in use are kept on the executors, test rows only if several candidates read them. Vectors are made again for each
    candidate that is fitted, as trees keep their own binned copy anyway; test rows are scored from plain columns where the model can.
    """
    needed = [label, *columns]
    weight = "weight" if weighted else None
    whole = train.select(*needed)
    prepared = fit_stages(stages, whole)
    offered = list(candidates(prepared, weight))
    test = test.select(*needed)
    with _rows_to_fit(prepared, whole, label, weight, classes, offered[0][1]) as fit, _kept(*([test] if len(offered) > 1 else [])) as kept:
        test = kept[0] if kept else test

        def tried(estimator):
            model = fit(estimator)
            return model, evaluate(with_scores(PipelineModel([*prepared.stages, model]), test, "_found"), label)

        threads = ThreadPool(min(SIDE_BY_SIDE, len(offered)))
        try:
            results = threads.map(inheritable_thread_target(train.sparkSession)(tried), [estimator for _, estimator in offered], chunksize=1)
        finally:
            threads.close()
    best = max(range(len(results)), key=lambda i: (score(results[i][1]), -i))
    model, found = results[best]
    return Fitted(PipelineModel([*prepared.stages, model]), offered[best][0], found)


def _fit_binary(kind, grid, train, test, features, label, weighted) -> Fitted:
    def candidates(_, weight):
        for params in grid:
            yield params, _estimator(kind, "binary", "features_vec", label, weight, params)

    return _fit_best(
        binary_stages(features), candidates, train, test, label, 2, weighted, features,
        evaluate_binary, lambda m: m["auc_roc"],
    )


def fit_binary_forest(train, test, features, label="binary_label", params=None, weighted=True) -> Fitted:
    return _fit_binary(Forest, [params or BINARY_FOREST], train, test, features, label, weighted)


def fit_binary_gbt(train, test, features, label="binary_label", grid=None, weighted=True) -> Fitted:
    """The grid entry with the best ROC area."""
    return _fit_binary(GBTClassifier, grid or BINARY_GBT_GRID, train, test, features, label, weighted)


def fit_category_forest(
    train, test, features, label="class_label", grid=None, weighted=True, categoricals=CATEGORICALS
) -> Fitted:
    """Category model on attack rows: best of 0.7 accuracy + 0.3 weighted F1."""

    def candidates(prepared, weight):
        index = next(s for s in prepared.stages if isinstance(s, StringIndexerModel))
        for params in grid or CATEGORY_FOREST_GRID:
            bins = max(params.get("maxBins", 32), required_bins(index))
            params = {"featureSubsetStrategy": "sqrt", **params, "maxBins": bins}
            yield params, _estimator(Forest, "category", "features_mc", label, weight, params)

    attacks = F.col(label) > 0
    return _fit_best(
        category_stages(features, categoricals), candidates, train.where(attacks), test.where(attacks),
        label, None, weighted, [*features, *categoricals], evaluate_category,
        lambda m: ACCURACY_SHARE * m["accuracy"] + F1_SHARE * m["weighted_f1"],
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_models(paths: dict[str, str]) -> dict[str, PipelineModel]:
    """Load several models; every one that cannot be read is named in the error."""
    loaded, missing = {}, []
    for name, path in paths.items():
        try:
            loaded[name] = PipelineModel.load(path)
        except Exception as error:  # a missing path surfaces as a JVM error of varying type
            missing.append(f"{name}: {path} ({type(error).__name__})")
    if missing:
        raise FileNotFoundError("models not found: " + "; ".join(missing))
    return loaded


def comparison(spark: SparkSession, results: dict[str, dict]) -> DataFrame:
    """Models by metrics; a metric a model does not have is null."""
    names = sorted({m for found in results.values() for m in found})
    rows = [(model, *[found.get(m) for m in names]) for model, found in results.items()]
    return spark.createDataFrame(rows, "model string, " + ", ".join(f"{m} double" for m in names))


def top_features(spark: SparkSession, model: PipelineModel, names: list[str], n: int = 20) -> DataFrame:
    """The ``n`` most important features of the last stage, ranked; names are positional when
    their number does not fit."""
    values = model.stages[-1].featureImportances.toArray()
    if len(names) != len(values):
        names = [f"feature_{i}" for i in range(len(values))]
    ranked = sorted(zip(names, map(float, values)), key=lambda pair: (-pair[1], pair[0]))[:n]
    rows = [(i, *pair) for i, pair in enumerate(ranked, start=1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def by_rank():
    """The order of the few ranked features."""
    return Window.orderBy("rank")
