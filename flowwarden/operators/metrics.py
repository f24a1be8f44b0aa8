"""Classifier quality from scored rows.

Everything that only needs (label, prediction) counts is computed from the confusion matrix, whose
size is the square of the number of classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.session import materialise


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return (
        df.groupBy(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("label", "prediction")
    )


def per_class_accuracy(matrix: DataFrame) -> DataFrame:
    return (
        matrix.groupBy("label")
        .agg(
            F.sum("n").alias("total"),
            F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("correct"),
        )
        .withColumn("accuracy", F.round(F.col("correct") / F.col("total"), 4))
        .orderBy("label")
    )


def class_report(matrix: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of every class seen as label or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
    )
    sums = (
        matrix.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    support, predicted, hits = F.col("support"), F.col("predicted"), F.col("hits")
    return sums.select(
        "class",
        "support",
        ratio(hits, predicted).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(hits * 2, support + predicted).alias("f1"),
    )


def class_report_with_averages(matrix: DataFrame) -> DataFrame:
    """The per-class report plus its macro and weighted averages, told apart by ``scope``."""
    report = class_report(matrix)
    measures = ["precision", "recall", "f1"]
    averages = report.agg(
        F.sum("support").alias("support"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}") for m in measures],
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("scope"),
                        F.lit(None).cast("double").alias("class"),
                        "support",
                        *[F.col(f"{kind}_{m}").alias(m) for m in measures],
                    )
                    for kind in ("macro", "weighted")
                ]
            )
        )
    )
    return report.select(F.lit("class").alias("scope"), "class", "support", *measures).unionByName(averages)


def overall_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, one row."""
    weigh = lambda m: F.sum(F.col(m) * F.col("support")) / F.sum("support")
    # The weighted mean of recalls is hits over rows, that is the accuracy.
    return class_report(matrix).agg(
        weigh("recall").alias("accuracy"),
        weigh("f1").alias("weighted_f1"),
        weigh("precision").alias("weighted_precision"),
        weigh("recall").alias("weighted_recall"),
    )


def positive_f1(matrix: DataFrame, positive: float = 1.0) -> DataFrame:
    """Precision, recall and F1 of the positive class alone."""
    return class_report(matrix).where(F.col("class") == positive).select(
        F.col("precision"), F.col("recall"), F.col("f1").alias("binary_f1")
    )


def curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score, as the threshold from which rows count as positive: its own positives and negatives (``pos``, ``neg``), and
    those from it on (``tp``, ``fp``). No binning.

    Scores are counted before anything moves, then sorted once, by range; each range adds what the ranges above it hold, so no task sees more
    than its range. Rows without a score are left out. The sorted counts are written, as they are read for both.
    """
    positive = F.col(label).cast("double") > 0.5
    counts = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranged = materialise(counts.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id()), "curve")
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = ranged.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).select(
        "part", F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p"), F.coalesce(F.sum("q").over(above), F.lit(0)).alias("q")
    )
    upto = Window.partitionBy("part").orderBy(F.desc("score"))
    return ranged.join(F.broadcast(sums), "part").select(
        "score", "pos", "neg", (F.sum("pos").over(upto) + F.col("p")).alias("tp"), (F.sum("neg").over(upto) + F.col("q")).alias("fp")
    )


def areas(df: DataFrame, label: str = "label", score: str = "score") -> dict[str, float]:
    """Exact areas under the ROC and the precision-recall curve (``auc_roc``, ``auc_pr``), by trapezoids, from one ``curve``.

    The precision-recall curve begins at recall 0 with the precision of the first threshold. Without rows of one kind the area that needs them is 0.
    """
    points = curve(df, label, score)
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before = F.when(before_tp + before_fp > 0, before_tp / (before_tp + before_fp)).otherwise(precision)
    found = points.agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("q"),
        F.sum(F.col("neg") * (F.col("tp") + before_tp) / 2).alias("roc"), F.sum(F.col("pos") * (precision + before) / 2).alias("pr"),
    ).first()
    p, q = found["p"] or 0, found["q"] or 0
    return {"auc_roc": found["roc"] / p / q if p and q else 0.0, "auc_pr": found["pr"] / p if p else 0.0}


def column_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample standard deviation per column, as rows, from one aggregate."""
    measured = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_samp(c).alias(f"std_{c}") for c in columns]
    )
    return measured.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"))
                    for c in columns
                ]
            )
        )
    )
