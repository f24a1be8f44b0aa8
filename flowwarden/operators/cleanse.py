"""Flow-table cleansing: names, columns, nulls, outliers, schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.functions.scalars import finite_or_zero, nan_to_null
from flowwarden.operators.quantiles import approx_quantiles, exact_quantiles


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in expected if c not in present]


def require_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    missing = missing_columns(df, expected)
    if missing:
        raise ValueError(f"missing columns ({len(missing)}): {missing}")
    return df


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null, as JSON and most stores expect."""
    return df.select(
        [
            nan_to_null(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def clean_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Finite doubles for every feature, in order, after the other columns; an absent feature is
    0.0. One flat projection, however wide the table."""
    present = set(df.columns)
    others = [F.col(c) for c in df.columns if c not in set(features)]
    cleaned = [
        (finite_or_zero(F.col(c)) if c in present else F.lit(0.0)).alias(c) for c in features
    ]
    return df.select(others + cleaned)


def drop_sparse_rows(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Keep rows with at least ``int(share * columns)`` values (NaN counts as missing)."""
    return df.na.drop(thresh=int(len(df.columns) * share))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_medians(
    df: DataFrame,
    columns: list[str] | None = None,
    exact: bool = True,
) -> DataFrame:
    """Replace missing numbers by the column median. Filled columns become double, so that a
    median between two integers is not truncated."""
    columns = columns if columns is not None else numeric_columns(df)
    medians = (
        exact_quantiles(df, columns, [0.5])
        if exact
        else approx_quantiles(df, columns, [0.5])
    )

    def filled(c: str):
        value = F.col(c).cast("double")
        value = F.when(~F.isnan(value), value)
        middle = medians[c][0]
        return (value if middle is None else F.coalesce(value, F.lit(middle))).alias(c)

    return df.select([filled(c) if c in medians else F.col(c) for c in df.columns])


def clip_outliers(
    df: DataFrame,
    columns: list[str],
    lower: float = 0.01,
    upper: float = 0.99,
    exact: bool = True,
) -> DataFrame:
    """Clip columns to their own quantile range; null stays null, absent columns are skipped."""
    columns = [c for c in columns if c in set(df.columns)]
    bounds = (
        exact_quantiles(df, columns, [lower, upper])
        if exact
        else approx_quantiles(df, columns, [lower, upper])
    )

    def clipped(c: str):
        low, high = bounds[c]
        value = F.col(c).cast("double")
        if low is None:
            return value.alias(c)
        # least/greatest skip nulls, so the guard is needed; NaN stays as it is.
        return (
            F.when(value.isNotNull() & ~F.isnan(value), F.least(F.greatest(value, F.lit(low)), F.lit(high)))
            .otherwise(value)
            .alias(c)
        )

    return df.select([clipped(c) if c in bounds else F.col(c) for c in df.columns])


def profile(df: DataFrame, label: str) -> DataFrame:
    """Rows, columns and null cells of the table (scope ``table``) and of every label value.

    Grouping by label first leaves one row per class for the totals.
    """
    nulls = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    per_label = df.groupBy(F.col(label).alias("label_value")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("null_cells")
    )
    return (
        per_label.rollup("label_value")
        .agg(
            F.grouping("label_value").alias("_all"),
            F.sum("rows").alias("rows"),
            F.sum("null_cells").alias("null_cells"),
        )
        .select(
            F.when(F.col("_all") == 1, "table").otherwise("label").alias("scope"),
            "label_value",
            "rows",
            F.lit(len(df.columns)).cast("bigint").alias("columns"),
            "null_cells",
        )
    )
