"""Latest rows, top-N per key, last write wins, display order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.session import materialise


def newest_first() -> list[Column]:
    """The one order of alert reads: time descending, id ascending."""
    return [F.col("alert_time").desc(), F.col("alert_id").asc()]


def latest(alerts: DataFrame, n: int = 100) -> DataFrame:
    return alerts.orderBy(*newest_first()).limit(n)


def latest_of_type(alerts: DataFrame, attack_type: str, n: int = 100) -> DataFrame:
    return latest(of_type(alerts, attack_type), n)


def latest_of_type_bounded(alerts: DataFrame, attack_type: str, n: int = 100, factor: int = 5) -> DataFrame:
    """Looks only at the newest ``factor * n`` rows, so it may return fewer than ``n``."""
    return latest(of_type(latest(alerts, factor * n), attack_type), n)


def of_type(alerts: DataFrame, attack_type: str) -> DataFrame:
    return alerts.where(F.lower("attack_type") == attack_type.lower())


def of_severity(alerts: DataFrame, severity: str) -> DataFrame:
    return alerts.where(F.lower("severity") == severity.lower())


def top_n_per_key(
    df: DataFrame, keys: list[str], order: list[Column], n: int, salts: int = 64
) -> DataFrame:
    """The first ``n`` rows of every key.

    Ranked twice: first within (key, slice of the input tasks), then within the key. Spark also
    prunes each task to ``n`` rows per group before the first shuffle, so one task sees at most
    ``salts * n`` rows of a key, however hot the key is.
    """
    sliced = df.withColumn("_slice", F.spark_partition_id() % F.lit(salts))
    first = Window.partitionBy(*keys, "_slice").orderBy(*order)
    second = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= n)
        .drop("_rank", "_slice")
        .withColumn("_rank", F.row_number().over(second))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def last_write(df: DataFrame, keys: list[str], seq: list[str] = ()) -> DataFrame:
    """One row per key: the one with the highest ``seq``.

    An aggregation rather than a window, so copies are combined before the shuffle and a key with
    very many copies sends one row per task. Remaining columns break ties, which keeps the result
    the same on every run.
    """
    rest = [c for c in df.columns if c not in keys and c not in seq]
    best = F.max(F.struct(*seq, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def last_by_order(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the highest ``order``, a number that no two rows share.

    Only keys that occur more than once are aggregated and joined back. Both aggregations are on
    hashes with fixed-width buffers, so nothing is sorted, and the wide rows are not shuffled as
    long as few keys are written twice: AQE then broadcasts these.
    """
    last = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), F.max(order).alias("_last"))
    again = last.where(F.col("_copies") > 1).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_last")
    same = [df[k].eqNullSafe(again[f"_k_{k}"]) for k in keys]
    condition = same[0]
    for part in same[1:]:
        condition &= part
    joined = df.join(again, condition, "left")
    return joined.where(F.col("_last").isNull() | (F.col(order) == F.col("_last"))).select(*df.columns)


def numbered_by_range(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``out`` = 0, 1, ... in the order of the columns, which must be unique together.

    Rows are sorted by range and numbered per range, with the counts of the earlier ranges added:
    no task holds more than its range. Written out, so that both uses see the same ranges.
    """
    ranged = materialise(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select(
        "_range", (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    # One row per range on the other side.
    return (
        ranged.withColumn("_place", place)
        .join(F.broadcast(before), "_range")
        .select(*df.columns, (F.col("_place") + F.col("_before")).cast("bigint").alias(out))
    )


def sort_for_display(alerts: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """Sort by one column as the alert list does: probability as a number, the rest as
    case-insensitive text. Newest-first order breaks ties, which also lets Spark split the range
    of a value that fills much of the table."""
    if column == "binary_probability":
        number = F.col(column).try_cast("double")
        key = F.when(F.isnan(number), 0.0).otherwise(F.coalesce(number, F.lit(0.0)))
    else:
        key = F.lower(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return alerts.orderBy(key.asc() if ascending else key.desc(), *newest_first())


def recent_sessions(sessions: DataFrame, n: int = 10) -> DataFrame:
    return sessions.orderBy(F.col("created_at").desc(), F.col("session_id").asc()).limit(n)
