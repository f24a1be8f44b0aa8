"""Fitting of forests on every row of a table, and the fitted model: a folder of trees that executors write and read."""

from __future__ import annotations

import math
import os
import threading

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.operators.quantiles import approx_quantiles
from flowwarden.plans import grow
from flowwarden.session import ship_package, work_path

#: Slices of the trees per core, so that cores end together.
SLICES = 4
#: Classes of a label at most, as in Spark.
MOST_CLASSES = 100


def with_scheme(spark, path: str) -> str:
    """A folder of Parquet files as tasks can open it: with the file system that Spark takes for it."""
    return os.path.dirname(spark.read.parquet(path).inputFiles()[0])


class ForestModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, MLWritable, MLReadable):
    """``path`` holds the trees, ``about`` the cuts of numbers, the categories and what is known of all trees together."""

    def __init__(self, path: str | None = None, about: dict | None = None):
        super().__init__()
        self.path, self.about = path, about or {}

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.about["importances"])

    @property
    def totalNumNodes(self) -> int:
        return 2 * self.about["leaves"] - self.about["trees"]

    def _transform(self, df: DataFrame) -> DataFrame:
        from flowwarden.plans import forests

        return forests.walked(self, df)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"about": self.model.about})
        spark.read.parquet(self.model.path).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(f"{path}/trees", found["about"])
        model._resetUid(found["uid"])
        DefaultParamsReader.getAndSetParams(model, found)
        return model


class Binned:
    """The rows of a fit as small integers, written once per number of bins; ``numbers`` says what a feature vector is made of (``forests.numbers_of``)
    and ``arity`` how many categories a feature has, 0 for numbers."""

    def __init__(self, rows: DataFrame, label: str, numbers: list[tuple[str, float, float]], arity: list[int]):
        features = [((F.col(f"`{c}`").cast("double") - F.lit(less)) * F.lit(times)).alias(f"f{i}") for i, (c, less, times) in enumerate(numbers)]
        self.rows, self.arity, self.made, self.lock = rows.select(*features, F.col(label).cast("double").alias("label")), arity, {}, threading.Lock()
        labels = [r[0] for r in self.rows.select("label").distinct().limit(MOST_CLASSES + 1).collect()]
        if not labels or len(labels) > MOST_CLASSES or any(v is None or v != v or v < 0 or v != int(v) for v in labels):
            raise ValueError(f"{label} is no class, or there are no rows: {sorted(labels, key=str)[:10]}")
        self.names = tuple(sorted(int(v) for v in labels))

    def cuts(self, most: int) -> list[list[float]]:
        """Between all values of a number that has few, else at quantiles of all rows."""
        columns = [f"f{i}" for i, n in enumerate(self.arity) if not n]
        if not columns:
            return [[] for _ in self.arity]
        about = self.rows.agg(*[F.approx_count_distinct(c, 0.02) for c in columns]).first()
        found = {}
        for c in (c for c, n in zip(columns, about) if n <= 2 * most):
            values = sorted(r[0] for r in self.rows.select(c).distinct().limit(3 * most).collect())
            if len(values) <= most:
                found[c] = [(a + b) / 2 for a, b in zip(values, values[1:])]
        if many := [c for c in columns if c not in found]:
            found |= {c: sorted(set(q)) for c, q in approx_quantiles(self.rows, many, [i / most for i in range(1, most)]).items()}
        return [found.get(f"f{i}", []) for i in range(len(self.arity))]

    def table(self, most: int) -> tuple[str, list[list[float]]]:
        """Folder of the rows with at most so many bins, and the cuts."""
        with self.lock:  # candidates are fitted side by side
            if most not in self.made:
                self.made[most] = self._written(self.cuts(most))
            return self.made[most]

    def _written(self, cuts: list[list[float]]) -> tuple[str, list[list[float]]]:
        arity, spark = self.arity, self.rows.sparkSession
        ship_package(spark)

        def binned(batches):
            for batch in batches:
                *values, label = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                codes = [v if n else np.searchsorted(c, v, side="left") for v, c, n in zip(values, cuts, arity)]
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype("int16")) for c in [*codes, label]], names=batch.schema.names)

        path = work_path(spark, "binned")
        self.rows.mapInArrow(binned, ", ".join(f"{c} smallint" for c in self.rows.columns)).write.parquet(path)
        return with_scheme(spark, path), cuts


def fit(binned: Binned, weights: dict[float, float], params: dict, seed: int) -> ForestModel:
    """Every tree is grown on a bootstrap of all rows; ``weights`` are those of classes, 1 if not given. Parameters are named as in Spark's forests."""
    spark, most = binned.rows.sparkSession, max(params.get("maxBins", 32), *binned.arity)
    table, cuts = binned.table(most)
    nf, trees = len(binned.arity), params.get("numTrees", 20)
    subset = params.get("featureSubsetStrategy", "auto")
    if subset not in ("auto", "sqrt", "all"):
        raise ValueError(f"featureSubsetStrategy {subset} is not known")
    plan = grow.Plan(
        path=table, classes=len(binned.names), weights=tuple(float(weights.get(float(c), 1.0)) for c in binned.names), names=binned.names, arity=tuple(binned.arity),
        bins=tuple(n or len(c) + 1 for n, c in zip(binned.arity, cuts)),
        tries=nf if subset == "all" or subset == "auto" and trees == 1 else math.ceil(math.sqrt(nf)),
        depth=params.get("maxDepth", 5), least=params.get("minInstancesPerNode", 1), most_bins=most, seed=seed,
    )
    path = work_path(spark, "trees")
    slices = min(trees, SLICES * spark.sparkContext.defaultParallelism)
    spark.range(0, trees, 1, slices).mapInArrow(lambda batches: grow.grown(plan, batches), grow.TREE).write.parquet(path)
    known = spark.read.parquet(path).select("rows", "leaves", "importance").toArrow().to_pydict()  # a few numbers per tree
    shares = np.array(known["importance"]).sum(axis=0)
    about = {
        "trees": trees, "classes": binned.names[-1] + 1, "arity": binned.arity, "cuts": cuts, "rows": sum(known["rows"]), "leaves": sum(known["leaves"]),
        "most_leaves": max(known["leaves"]), "importances": (shares / shares.sum() if shares.sum() > 0 else shares).tolist(),
    }
    return ForestModel(path, about)
