"""Scoring: fitted models, the two-stage cascade, and alert rows."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.functions.scalars import lookup, parse_iso, record_key, safe_float, safe_int
from flowwarden.operators.cleanse import clean_features
from flowwarden.operators.joins import severity_of
from flowwarden.plans.forests import with_scores
from flowwarden.schemas import ATTACK_TYPES, HIGH_CONFIDENCE
from flowwarden.session import materialise, ship_package


def score_binary(df: DataFrame, model: PipelineModel, features: list[str]) -> DataFrame:
    """Adds ``features_vec``, ``binary_prediction`` and ``binary_probability`` (of class 1)."""
    scored = with_scores(model, clean_features(df, features), "_found")
    probability = F.coalesce(F.get("_found.probs", F.lit(1)), F.lit(0.0))
    return scored.withColumns({"binary_prediction": F.col("_found.said"), "binary_probability": probability}).drop("features_raw", "_found")


def attacks(df: DataFrame) -> DataFrame:
    return df.where(F.col("binary_prediction") == 1)


def normals(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce(F.col("binary_prediction"), F.lit(0)) != 1)


def high_confidence(df: DataFrame, threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    return attacks(df).where(F.col("binary_probability") >= threshold)


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows behind a boundary that filters are not pushed through.

    A filter on a prediction would otherwise be pushed below the projection that makes it, and every
    row that passes would run the model twice.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def score_category(
    df: DataFrame,
    model: PipelineModel,
    names: Mapping[int, str] = ATTACK_TYPES,
    include_normal: bool = False,
) -> DataFrame:
    """Adds ``attack_cat_id``, ``attack_type`` and ``attack_confidence``.

    Only the flagged rows go through the second model. With ``include_normal`` the other rows are
    added with id 0, ``Normal``, 0.0; ``df`` should then be a stored table, as it is read for both parts.
    """
    scored = with_scores(model, attacks(df), "_found")
    cat = F.col("_found.said").cast("int")
    found = {
        "attack_cat_id": cat,
        "attack_type": lookup(cat, names, "Unknown"),
        "attack_confidence": F.coalesce(F.get("_found.probs", cat), F.lit(0.0)),
    }
    flagged = scored.withColumns(found).select(*df.columns, *found)
    if not include_normal:
        return flagged
    rest = {"attack_cat_id": F.lit(0), "attack_type": F.lit("Normal"), "attack_confidence": F.lit(0.0)}
    return flagged.unionByName(normals(df).withColumns(rest).select(*df.columns, *rest))


def only_for_attacks(found: dict[str, Column]) -> dict[str, Column]:
    """Category columns for a table that also holds normal rows."""
    defaults = {"attack_cat_id": F.lit(0), "attack_type": F.lit("Normal"), "attack_confidence": F.lit(0.0)}
    flagged = F.coalesce(F.col("binary_prediction"), F.lit(0)) == 1
    return {c: F.when(flagged, value).otherwise(defaults[c]) for c, value in found.items()}


def cascade(
    df: DataFrame,
    binary: PipelineModel,
    category: PipelineModel,
    features: list[str],
    names: Mapping[int, str] = ATTACK_TYPES,
    include_normal: bool = False,
) -> DataFrame:
    """Both stages: the second model sees flagged rows only, the first every row once.

    One lazy plan, unless the normal rows are wanted too: then the first stage is written, as both parts read it. Its vectors don't go
    through there, they are made behind it where somebody reads them.
    """
    first = score_binary(df, binary, features).drop("features_vec")
    first = materialise(first, "first-stage") if include_normal else evaluated_once(first)
    first = PipelineModel(binary.stages[:-1]).transform(first).drop("features_raw")
    return score_category(first, category, names, include_normal)


def to_alerts(scored: DataFrame) -> DataFrame:
    """Alert rows of scored flows: constants for the absent addresses, severity by attack type.

    Record key, time and session are taken from the flow when it has them.
    """
    present = set(scored.columns)
    column = lambda c, kind: F.col(c) if c in present else F.lit(None).cast(kind)
    attack_type = F.coalesce(F.nullif("attack_type", F.lit("")), F.lit("Unknown"))
    carried = [F.col(c) for c in ("record_id", "event_time", "session_id") if c in present]
    return scored.select(
        *carried,
        safe_int(F.col("binary_prediction"), 1).alias("binary_prediction"),
        safe_float(F.col("binary_probability")).alias("binary_probability"),
        attack_type.alias("attack_type"),
        safe_float(F.col("attack_confidence")).alias("attack_confidence"),
        severity_of(attack_type, "medium").alias("severity"),
        F.lit("").alias("src_ip"),
        F.lit("").alias("dst_ip"),
        F.lit(0).alias("src_port"),
        F.lit(0).alias("dst_port"),
        F.coalesce(column("proto", "string"), F.lit("")).alias("protocol"),
        safe_int(column("sbytes", "double"), 0, "bigint").alias("sbytes"),
        safe_int(column("dbytes", "double"), 0, "bigint").alias("dbytes"),
        safe_float(column("rate", "double")).alias("rate"),
    )


def enrich_alerts(alerts: DataFrame, session_id: Column | None = None) -> DataFrame:
    """Id and write time where missing, and the session.

    The id is made from the record the alert stems from, so scoring a record again gives the same
    alert; only rows without any source key are identified by their content. An empty id is a
    missing one. Times given as text are ISO 8601; text that is none counts as the epoch, an absent time as now.
    """
    present = set(alerts.columns)
    text = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    own = [text(c) for c in ("alert_id", "record_id") if c in present]
    times = [_instant(alerts, c) for c in ("alert_time", "event_time") if c in present]
    content = record_key(*[F.col(c) for c in sorted(present - {"alert_id", "record_id"})])
    session = session_id if session_id is not None else F.col("session_id")
    rest = [c for c in alerts.columns if c not in {"alert_id", "record_id", "alert_time", "event_time", "session_id"}]
    return alerts.select(
        session.alias("session_id"),
        F.coalesce(*times, F.current_timestamp()).cast("timestamp").alias("alert_time"),
        F.coalesce(*own, content).alias("alert_id"),
        *rest,
    )


def _instant(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.when(value.isNotNull(), parse_iso(value))
    return value


# --- Rule scorer: a fixed model with the columns of the fitted cascade, so that the jobs around
# --- scoring can be checked by value.

RULE_FEATURES = ["rate", "sbytes", "dur"]
RULE_WEIGHTS = {"rate": 0.03, "sbytes": 0.04, "dur": -0.02}
RULE_BIAS = -1.5


def category_weights(cat: int) -> tuple[float, float, float]:
    """Weights of one category for (rate, sbytes, dur), each scaled by 1/100."""
    return cat * 3 % 11 / 4.0, cat * 5 % 11 / 4.0, cat * 7 % 11 / 4.0


def rule_scores(df: DataFrame, include_normal: bool = False) -> DataFrame:
    """Binary and category columns from fixed weights, as plain expressions.

    The bias is added last, as in ``NumpyRules``: rows at a probability of one half are decided by the order of the sum.
    """
    z = functools.reduce(operator.add, (F.col(c) * F.lit(w) for c, w in RULE_WEIGHTS.items())) + F.lit(RULE_BIAS)
    flagged = df.withColumn("binary_probability", 1 / (1 + F.exp(-z))).withColumn(
        "binary_prediction", (F.col("binary_probability") >= 0.5).cast("int")
    )
    if not include_normal:
        flagged = attacks(flagged)
    scores = F.array(
        *[
            sum((F.col(c) / 100.0 * F.lit(w) for c, w in zip(RULE_FEATURES, category_weights(cat))), F.lit(0.0))
            for cat in range(1, 10)
        ]
    )
    scored = flagged.withColumn("_scores", scores).withColumn("_top", F.array_max("_scores"))
    cat = F.array_position("_scores", F.col("_top")).cast("int")
    total = F.aggregate("_scores", F.lit(0.0), lambda acc, s: acc + F.exp(s - F.col("_top")))
    found = {
        "attack_cat_id": cat,
        "attack_type": lookup(cat, ATTACK_TYPES, "Unknown"),
        "attack_confidence": 1 / total,
    }
    if include_normal:
        found = only_for_attacks(found)
    return scored.withColumns(found).drop("_scores", "_top")


class NumpyRules:
    """The rule scorer over numpy arrays: stands for any model that lives outside Spark."""

    def __call__(self, features: np.ndarray) -> dict[str, np.ndarray]:
        # Terms are added one by one: a matrix product rounds in an order of its own, which differs by batch and machine.
        z = functools.reduce(operator.add, (x * RULE_WEIGHTS[c] for c, x in zip(RULE_FEATURES, features.T))) + RULE_BIAS
        weights = np.array([category_weights(c) for c in range(1, 10)])
        scores = functools.reduce(operator.add, (np.outer(x, w) for x, w in zip(features.T / 100.0, weights.T)))
        top = scores.max(axis=1, keepdims=True)
        return {
            "binary_probability": 1 / (1 + np.exp(-z)),
            "attack_cat_id": scores.argmax(axis=1) + 1,
            "attack_confidence": 1 / np.exp(scores - top).sum(axis=1),
        }


SCORE_SCHEMA = [
    T.StructField("binary_prediction", T.IntegerType()),
    T.StructField("binary_probability", T.DoubleType()),
    T.StructField("attack_cat_id", T.IntegerType()),
    T.StructField("attack_confidence", T.DoubleType()),
]


def score_with(df: DataFrame, scorer, features: list[str], keep: list[str]) -> DataFrame:
    """Score with any Python model, batch by batch on the executors.

    ``scorer`` takes a float matrix and returns arrays named as the score columns; it is broadcast
    once. Only the flagged rows come back.
    """
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(scorer)
    needed = [c for c in dict.fromkeys([*keep, *features]) if c in df.columns]
    cleaned = clean_features(df.select(*needed), features)
    out = T.StructType([cleaned.schema[c] for c in keep] + SCORE_SCHEMA)

    def batches(frames):
        for frame in frames:
            found = shared.value(frame[features].to_numpy(dtype="float64"))
            flagged = found["binary_probability"] >= 0.5
            yield pd.DataFrame(
                {
                    **{c: frame[c][flagged] for c in keep},
                    "binary_prediction": np.ones(int(flagged.sum()), dtype="int32"),
                    **{c: found[c][flagged] for c in ("binary_probability", "attack_cat_id", "attack_confidence")},
                }
            )

    return cleaned.mapInPandas(batches, out)
