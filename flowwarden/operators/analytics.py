"""Counts, shares and histograms over alert tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.functions.scalars import floor_in_hour
from flowwarden.operators.joins import severity_of
from flowwarden.operators.ranking import latest
from flowwarden.schemas import SEVERITY_LEVELS


def newest_time(alerts: DataFrame) -> dt.datetime | None:
    """The latest alert time, for use as ``as_of``; a literal reaches the scan as a filter."""
    return alerts.agg(F.max("alert_time")).first()[0]


def since(alerts: DataFrame, as_of: dt.datetime | None, hours: float) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of``: the cutoff is included, no upper bound."""
    if as_of is None:
        return alerts.limit(0)
    kind = alerts.schema["alert_time"].dataType
    cutoff = F.lit(as_of - dt.timedelta(hours=hours)).cast(kind)
    return alerts.where(F.col("alert_time") >= cutoff)


def _window(alerts, as_of, hours, cap):
    if cap is not None:
        alerts = latest(alerts, cap)
    return alerts if hours is None else since(alerts, as_of, hours)


def alert_stats(
    alerts: DataFrame,
    as_of: dt.datetime | None = None,
    hours: float | None = 24,
    cap: int | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Total, per-severity and per-type counts as rows (``facet``, ``name``, ``alerts``).

    The table is grouped once by (severity, type); the three facets are grouping sets over that
    small result, so the scan is not expanded threefold. ``by`` gives the same per session.
    """
    by = by or []
    counted = (
        _window(alerts, as_of, hours, cap)
        .groupBy(
            *by,
            F.coalesce("severity", F.lit("unknown")).alias("severity"),
            F.coalesce("attack_type", F.lit("Unknown")).alias("attack_type"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    keys = [F.col(c) for c in by]
    sev, kind = F.col("severity"), F.col("attack_type")
    sets = [keys, [*keys, sev], [*keys, kind]]
    facets = (
        counted.groupingSets(sets, *keys, sev, kind)
        .agg(F.grouping("severity").alias("_s"), F.grouping("attack_type").alias("_t"), F.sum("n").alias("alerts"))
        .select(
            *by,
            F.when(F.col("_s") == 0, "severity").when(F.col("_t") == 0, "attack_type").otherwise("total").alias("facet"),
            F.coalesce("severity", "attack_type", F.lit("all")).alias("name"),
            "alerts",
        )
    )
    if by:
        return facets
    # A window without alerts still has a total: 0.
    none = alerts.sparkSession.range(1).select(
        F.lit("total").alias("facet"), F.lit("all").alias("name"), F.lit(0).cast("bigint").alias("alerts")
    )
    return facets.unionByName(none).groupBy("facet", "name").agg(F.sum("alerts").alias("alerts"))


def severity_counts(alerts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One column per severity level, zero where a level does not occur."""
    level = F.lower("severity")
    return alerts.groupBy(*(by or [])).agg(
        *[F.count_if(level == s).alias(s) for s in SEVERITY_LEVELS]
    )


def distribution(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination, most frequent first."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), *[F.col(k).asc() for k in keys])
    )


def ranked_counts(alerts: DataFrame, key: str = "attack_type") -> DataFrame:
    """Count per value with its rank; the ranking window runs over one row per value."""
    counts = alerts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("n").desc(), F.col(key).asc())
    return counts.withColumn("rank", F.row_number().over(order))


def threat_shares(alerts: DataFrame) -> DataFrame:
    """Type, count, percent of all alerts to one place (half up), severity and rank."""
    ranked = ranked_counts(alerts.withColumn("attack_type", F.coalesce("attack_type", F.lit("Unknown"))))
    n, total = F.col("n"), F.sum("n").over(Window.partitionBy())
    tenths = F.floor((n * 2000 + total) / (total * 2))
    return ranked.select(
        "rank",
        "attack_type",
        "n",
        (tenths / F.lit(10.0)).alias("percent"),
        severity_of(F.col("attack_type"), "info").alias("severity"),
    )


def timeline(
    alerts: DataFrame,
    interval: int = 60,
    as_of: dt.datetime | None = None,
    hours: float | None = 24,
    cap: int | None = None,
    even: bool = False,
    by: list[str] | None = None,
) -> DataFrame:
    """Alerts per time bucket, ascending, empty buckets absent.

    By default the minute is floored inside its hour, so 45 gives buckets at :00 and :45 and
    anything above 60 acts as 60. ``even`` gives windows of equal length instead.
    """
    rows = _window(alerts, as_of, hours, cap)
    by = by or []
    bucket = _bucket(F.col("alert_time"), interval, even)
    return (
        rows.groupBy(*by, bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("alerts"))
        .orderBy(*by, "bucket")
    )


def _bucket(ts: Column, interval: int, even: bool) -> Column:
    if interval <= 0:
        raise ValueError("interval must be positive")
    return F.window(ts, f"{interval} minutes")["start"] if even else floor_in_hour(ts, interval)


def bucket_label(bucket: Column) -> Column:
    return F.date_format(bucket, "HH:mm")
