"""Dimension lookups and key-based joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.functions.scalars import lookup
from flowwarden.schemas import SEVERITIES, SEVERITY_ALIASES

def lookup_join(
    df: DataFrame, dim: DataFrame, on: str, dim_key: str, value: str, out: str, default
) -> DataFrame:
    """Left join that puts ``dim.value`` into ``out``, ``default`` where the key has no match."""
    keyed = dim.select(F.col(dim_key).alias("_dim_key"), F.col(value).alias("_dim_value"))
    return (
        df.join(keyed, F.col(on) == F.col("_dim_key"), "left")
        .withColumn(out, F.coalesce("_dim_value", F.lit(default)))
        .drop("_dim_key", "_dim_value")
    )


def severity_of(attack_type: Column, default: str = "medium") -> Column:
    """Severity of an attack name: ``medium`` is the default when writing, ``info`` when showing."""
    return lookup(attack_type, {**SEVERITIES, **SEVERITY_ALIASES}, default)


def session_counts(sessions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Every session with its number of alerts; counted before the join."""
    counts = alerts.groupBy("session_id").agg(F.count(F.lit(1)).alias("alerts"))
    return sessions.join(counts, "session_id", "left").withColumn(
        "alerts", F.coalesce("alerts", F.lit(0).cast("bigint"))
    )


#: Parts that the alerts of one session are dealt to where both tables are too large to broadcast.
SESSION_PARTS = 16


def _by_part(alerts: DataFrame, sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A session may hold a third of the alerts: its rows go to several tasks, its key to each of them.
    A small session table is broadcast by its size, and nothing is dealt."""
    part = F.pmod(F.monotonically_increasing_id(), F.lit(SESSION_PARTS)).cast("int")
    known = sessions.select("session_id").distinct()
    parts = F.explode(F.sequence(F.lit(0), F.lit(SESSION_PARTS - 1)))
    return alerts.withColumn("_part", part), known.withColumn("_part", parts)


def registered_only(alerts: DataFrame, sessions: DataFrame) -> DataFrame:
    left, right = _by_part(alerts, sessions)
    return left.join(right, ["session_id", "_part"], "left_semi").drop("_part")


def orphans(alerts: DataFrame, sessions: DataFrame) -> DataFrame:
    left, right = _by_part(alerts, sessions)
    return left.join(right, ["session_id", "_part"], "left_anti").drop("_part")


def not_in(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not in the target."""
    return source.join(target.select(*keys), keys, "left_anti")


def bounded_not_in(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """``not_in`` for a source known to be small (a top-N): the target is filtered where it lies
    by the broadcast source keys, so a large target is scanned but never shuffled."""
    wanted = F.broadcast(source.select(*keys).distinct())
    hits = target.select(*keys).join(wanted, keys, "left_semi").distinct()
    return source.join(F.broadcast(hits), keys, "left_anti")


#: A key with more than this share of the rows is hot; there are fewer such keys than its inverse.
HOT_SHARE = 1e-3


def dimension_join(df: DataFrame, dim: DataFrame, on: str, key: str, rows: str, n: int) -> DataFrame:
    """``df`` with the other columns of ``dim``, nulls where its key is not there. ``dim`` has one row per ``key`` and may be as long as ``df``; ``rows``
    says how many of the ``n`` rows of ``df`` share the key.

    Hot keys, fewer than a thousand, are broadcast; the others are joined, and no task gets more than a thousandth of the rows under one key. Rows
    that the broadcast settles, and rows without a value, get keys of their own, so they don't meet in one task.
    """
    limit = max(1000, int(n * HOT_SHARE))
    columns = [c for c in dim.columns if c not in (key, rows)]
    side = lambda d, p: d.select(F.col(key).alias(f"_{p}_key"), *(F.col(c).alias(f"_{p}_{c}") for c in columns))
    df_columns = df.columns
    out = df.join(F.broadcast(side(dim.where(F.col(rows) > limit), "hot")), F.col(on) == F.col("_hot_key"), "left")
    settled = F.col("_hot_key").isNotNull() | F.col(on).isNull()
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    out = out.withColumn("_own_key", F.when(settled, alone).otherwise(F.concat(F.lit("+"), F.col(on).cast("string"))))
    rest = side(dim.where(F.col(rows) <= limit), "rest").withColumn("_rest_key", F.concat(F.lit("+"), F.col("_rest_key").cast("string")))
    out = out.join(rest, F.col("_own_key") == F.col("_rest_key"), "left")
    return out.select(*df_columns, *[F.coalesce(f"_hot_{c}", f"_rest_{c}").alias(c) for c in columns])
