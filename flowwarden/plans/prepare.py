"""Raw flow table to prepared train and test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowwarden.operators.cleanse import (
    clip_outliers, drop_columns, drop_sparse_rows, fill_medians, normalise_names, numeric_columns,
    require_columns,
)
from flowwarden.operators.sampling import split_train_test
from flowwarden.session import materialise


def prepare_flows(
    raw: DataFrame,
    features: list[str],
    key: str,
    label: str = "label",
    drop: tuple[str, ...] = ("id", "attack_cat"),
    exact: bool = True,
    test_size: float = 0.2,
) -> tuple[DataFrame, DataFrame]:
    """Normalise names, drop columns, check the schema, drop sparse rows, fill medians, clip
    outliers, split.

    The cleaned table is written once: medians, quantiles and split cuts each need a pass over it.
    """
    df = drop_columns(normalise_names(raw), list(drop))
    df = require_columns(df, [*features, label])
    df = materialise(drop_sparse_rows(df), "prepared")
    keep = {key, label}
    df = fill_medians(df, [c for c in numeric_columns(df) if c not in keep], exact=exact)
    df = clip_outliers(df, [c for c in features if c in numeric_columns(df)], exact=exact)
    return split_train_test(df, key, label, test_size)


def write_prepared(train: DataFrame, test: DataFrame, path: str) -> None:
    train.write.mode("overwrite").parquet(f"{path}/train")
    test.write.mode("overwrite").parquet(f"{path}/test")
