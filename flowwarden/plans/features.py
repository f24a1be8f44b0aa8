"""Feature vectors: fitted preparation stages shared by training and scoring."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.operators.labels import with_fallback_codes
from flowwarden.schemas import CATEGORICALS


def assembler(features: list[str], out: str = "features_raw") -> VectorAssembler:
    """Rows are cleaned before assembling, so ``keep`` never meets a null."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def scaler(source: str = "features_raw", out: str = "features_vec") -> StandardScaler:
    """Zero mean, unit sample standard deviation."""
    return StandardScaler(inputCol=source, outputCol=out, withMean=True, withStd=True)


def indexer(columns: list[str] = CATEGORICALS) -> StringIndexer:
    """Index by frequency; null and unseen values share one extra index."""
    return StringIndexer(
        inputCols=columns, outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def binary_stages(features: list[str]) -> Pipeline:
    return Pipeline(stages=[assembler(features), scaler()])


def category_stages(features: list[str], categoricals: list[str] = CATEGORICALS) -> Pipeline:
    """Scaled numbers followed by the category indices."""
    return Pipeline(
        stages=[
            assembler(features, "mc_raw"),
            scaler("mc_raw", "mc_scaled"),
            indexer(categoricals),
            VectorAssembler(
                inputCols=["mc_scaled", *[f"{c}_idx" for c in categoricals]],
                outputCol="features_mc",
                handleInvalid="keep",
            ),
        ]
    )


def fit_stages(stages: Pipeline, df: DataFrame) -> PipelineModel:
    """``stages.fit``, with the scaler's means and deviations from one aggregate over the plain columns of its assembler: no vector is made per row.

    The scaler itself is fitted on two rows that have these means and deviations. A deviation far below the last digits of its mean counts as zero.
    """
    fitted, by_output = [], {}
    for stage in stages.getStages():
        if isinstance(stage, StandardScaler):
            source = by_output[stage.getInputCol()]
            columns = source.getInputCols()
            aggregates = [of(F.col(f"`{c}`").cast("double")) for c in columns for of in (F.avg, F.stddev_samp)]
            found = df.agg(*aggregates).first()
            moments = [(mean, (spread or 0.0) / math.sqrt(2)) for mean, spread in zip(found[::2], found[1::2])]
            rows = [tuple(mean + side * half for mean, half in moments) for side in (-1, 1)]
            two = df.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns))
            fitted.append(stage.fit(source.transform(two)))
        elif isinstance(stage, VectorAssembler):
            by_output[stage.getOutputCol()] = stage
            fitted.append(stage)
        else:
            fitted.append(stage.fit(df))
    return PipelineModel(fitted)


def required_bins(model: StringIndexerModel) -> int:
    """Trees need a bin for every category and one for unseen values."""
    return max(len(labels) + 1 for labels in model.labelsArray)


def widen_vector(df: DataFrame, source: str, out: str, have: int, want: int) -> DataFrame:
    """``out`` = the vector ``source`` of ``have`` numbers with the category codes and then zeros
    behind it, ``want`` numbers in all. A model that takes no more gets the vector as it is."""
    if want <= have:
        return df.withColumn(out, F.col(source))
    coded = with_fallback_codes(df, CATEGORICALS)
    numbers = [F.col(f"{c}_code") for c in CATEGORICALS] + [F.lit(0.0)] * (want - have)
    tail = F.array(*numbers[: want - have])
    wide = coded.withColumn(out, array_to_vector(F.concat(vector_to_array(source), tail)))
    return wide.drop(*[f"{c}_code" for c in CATEGORICALS])
