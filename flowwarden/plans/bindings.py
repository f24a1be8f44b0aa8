"""Views that present the given tables as flows, alerts and sessions.

Each view exists twice: as a DataFrame and as the text of a common table expression over the same
base tables, so that results can be compared on another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.functions.scalars import lookup
from flowwarden.operators.joins import severity_of
from flowwarden.schemas import ATTACK_TYPES, SEVERITIES

EVENT_SLOTS = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}
FLOW_FEATURES = ["dur", "rate", "sload", "dload", "sbytes", "dbytes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").try_cast("int")
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert per event; type and severity from the event type and its ``k``."""
    k, user = F.col("k"), F.col("user_id")
    cat = lookup(F.col("event_type"), {e: 2 * s for e, s in EVENT_SLOTS.items()}, 0) + k % 2
    probability = F.least(F.col("value") / 500.0, F.lit(1.0))
    typed = _events(spark, sf_dir).withColumn("attack_cat_id", cat.cast("int"))
    attack_type = lookup(F.col("attack_cat_id"), ATTACK_TYPES, "Unknown")
    flagged = F.col("attack_cat_id") != 0
    return typed.select(
        F.col("event_id").cast("string").alias("alert_id"),
        F.concat(F.lit("session-"), (user % 8).cast("string")).alias("session_id"),
        F.col("ts").alias("alert_time"),
        "attack_cat_id",
        attack_type.alias("attack_type"),
        severity_of(attack_type).alias("severity"),
        F.when(user % 5 != 0, F.concat(F.lit("10.0.0."), (user % 256).cast("string"))).alias("src_ip"),
        F.when(k % 3 != 0, F.concat(F.lit("10.1.0."), k.cast("string"))).alias("dst_ip"),
        F.when(k % 4 != 0, k + 1024).alias("src_port"),
        F.when(k % 7 != 0, k + 8000).alias("dst_port"),
        F.when(k % 5 == 0, None).when(k % 2 == 0, "tcp").otherwise("udp").alias("protocol"),
        flagged.cast("int").alias("binary_prediction"),
        probability.alias("binary_probability"),
        F.when(flagged, 0.5 + probability / 2).otherwise(0.0).alias("attack_confidence"),
        k.cast("bigint").alias("sbytes"),
        (k * 3).cast("bigint").alias("dbytes"),
        F.col("value").alias("rate"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        alerts(spark, sf_dir)
        .groupBy("session_id")
        .agg(F.lit("flows").alias("dataset"), F.min("alert_time").alias("created_at"))
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records with key, time and session, one per event."""
    k, user = F.col("k"), F.col("user_id")
    return _events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("record_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(F.lit("session-"), (user % 8).cast("string")).alias("session_id"),
        F.when(k % 10 != 0, user.cast("double")).alias("dur"),
        F.when(k % 3 == 0, "tcp").when(k % 3 == 1, "udp").otherwise("gre").alias("proto"),
        F.when(k % 2 == 0, "http").otherwise("-").alias("service"),
        F.when(k % 4 == 0, "FIN").otherwise("INT").alias("state"),
        k.cast("double").alias("sbytes"),
        (k * 3).cast("double").alias("dbytes"),
        F.col("value").alias("rate"),
        F.col("event_type").alias("attack_cat"),
        (k + F.col("value") / 5 > 60).cast("int").alias("label"),
    )


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flow table with the dirt of real files: nulls, NaN, infinities, padded categories."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    inf, nan = float("inf"), float("nan")
    return table(spark, sf_dir, "lineitem").select(
        F.when(part % 7 != 0, F.col("l_quantity")).alias("dur"),
        F.when(supp % 11 == 0, inf)
        .when(supp % 13 == 0, nan)
        .when(part % 17 == 0, -inf)
        .otherwise(F.col("l_extendedprice"))
        .alias("rate"),
        F.col("l_discount").alias("sload"),
        F.when(part % 5 != 0, F.col("l_tax")).alias("dload"),
        part.cast("double").alias("sbytes"),
        F.when(part % 9 != 0, supp.cast("int")).alias("dbytes"),
        F.when(flag == "A", "tcp").when(flag == "N", "udp").when(part % 2 == 0, "unas").otherwise("sctp").alias("proto"),
        F.when(line <= 2, "dns").when(line <= 4, "http").when(line == 5, "-").when(line == 6, "ssh").alias("service"),
        F.when(status == "F", "FIN").otherwise("INT").alias("state"),
        F.when(flag == "A", " DoS ")
        .when(flag == "N", F.when(line <= 3, "Normal").when(line == 4, "").when(line == 5, "   ").when(line == 6, " Normal "))
        .when(line == 1, "Fuzzers")
        .when(line == 2, "Backdoor")
        .when(line == 3, "Backdoors")
        .when(line == 4, " Generic")
        .when(line == 5, "Reconnaissance ")
        .when(line == 6, "Shellcode")
        .otherwise("Mystery")
        .alias("attack_cat"),
        (F.col("l_extendedprice") > 50000).cast("int").alias("label"),
    )


_attack_case = " ".join(f"WHEN {i} THEN '{n}'" for i, n in ATTACK_TYPES.items())
_severity_case = " ".join(f"WHEN '{n}' THEN '{s}'" for n, s in SEVERITIES.items())
_slot_case = " ".join(f"WHEN '{e}' THEN {s}" for e, s in EVENT_SLOTS.items())

SQL_VIEWS = {
    "typed": f"""
      SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             2 * (CASE event_type {_slot_case} ELSE 0 END)
               + CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 AS attack_cat_id
      FROM events""",
    "alerts": f"""
      SELECT CAST(event_id AS VARCHAR) AS alert_id,
             'session-' || CAST(user_id % 8 AS VARCHAR) AS session_id,
             ts AS alert_time, attack_cat_id,
             CASE attack_cat_id {_attack_case} ELSE 'Unknown' END AS attack_type,
             CASE (CASE attack_cat_id {_attack_case} ELSE 'Unknown' END) {_severity_case} ELSE 'medium' END AS severity,
             CASE WHEN user_id % 5 <> 0 THEN '10.0.0.' || CAST(user_id % 256 AS VARCHAR) END AS src_ip,
             CASE WHEN k % 3 <> 0 THEN '10.1.0.' || CAST(k AS VARCHAR) END AS dst_ip,
             CASE WHEN k % 4 <> 0 THEN k + 1024 END AS src_port,
             CASE WHEN k % 7 <> 0 THEN k + 8000 END AS dst_port,
             CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN 'tcp' ELSE 'udp' END AS protocol,
             CASE WHEN attack_cat_id <> 0 THEN 1 ELSE 0 END AS binary_prediction,
             least(value / CAST(500.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS binary_probability,
             CASE WHEN attack_cat_id <> 0
                  THEN CAST(0.5 AS DOUBLE) + least(value / CAST(500.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) / 2
                  ELSE CAST(0.0 AS DOUBLE) END AS attack_confidence,
             CAST(k AS BIGINT) AS sbytes, CAST(k * 3 AS BIGINT) AS dbytes, value AS rate
      FROM typed""",
    "sessions": """
      SELECT session_id, 'flows' AS dataset, min(alert_time) AS created_at FROM alerts GROUP BY session_id""",
    "messages": """
      SELECT CAST(event_id AS VARCHAR) AS record_id, ts AS event_time,
             'session-' || CAST(user_id % 8 AS VARCHAR) AS session_id,
             CASE WHEN k % 10 <> 0 THEN CAST(user_id AS DOUBLE) END AS dur,
             CASE k % 3 WHEN 0 THEN 'tcp' WHEN 1 THEN 'udp' ELSE 'gre' END AS proto,
             CASE WHEN k % 2 = 0 THEN 'http' ELSE '-' END AS service,
             CASE WHEN k % 4 = 0 THEN 'FIN' ELSE 'INT' END AS state,
             CAST(k AS DOUBLE) AS sbytes, CAST(k * 3 AS DOUBLE) AS dbytes, value AS rate,
             event_type AS attack_cat, CASE WHEN k + value / 5 > 60 THEN 1 ELSE 0 END AS label
      FROM typed""",
    "raw_flows": """
      SELECT CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END AS dur,
             CASE WHEN l_suppkey % 11 = 0 THEN CAST('inf' AS DOUBLE)
                  WHEN l_suppkey % 13 = 0 THEN CAST('nan' AS DOUBLE)
                  WHEN l_partkey % 17 = 0 THEN CAST('-inf' AS DOUBLE) ELSE l_extendedprice END AS rate,
             l_discount AS sload, CASE WHEN l_partkey % 5 <> 0 THEN l_tax END AS dload,
             CAST(l_partkey AS DOUBLE) AS sbytes,
             CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_suppkey AS INTEGER) END AS dbytes,
             CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp'
                  ELSE CASE WHEN l_partkey % 2 = 0 THEN 'unas' ELSE 'sctp' END END AS proto,
             CASE WHEN l_linenumber <= 2 THEN 'dns' WHEN l_linenumber <= 4 THEN 'http'
                  WHEN l_linenumber = 5 THEN '-' WHEN l_linenumber = 6 THEN 'ssh' END AS service,
             CASE l_linestatus WHEN 'F' THEN 'FIN' ELSE 'INT' END AS state,
             CASE l_returnflag WHEN 'A' THEN ' DoS '
               WHEN 'N' THEN CASE WHEN l_linenumber <= 3 THEN 'Normal' WHEN l_linenumber = 4 THEN ''
                                  WHEN l_linenumber = 5 THEN '   ' WHEN l_linenumber = 6 THEN ' Normal ' END
               ELSE CASE l_linenumber WHEN 1 THEN 'Fuzzers' WHEN 2 THEN 'Backdoor' WHEN 3 THEN 'Backdoors'
                         WHEN 4 THEN ' Generic' WHEN 5 THEN 'Reconnaissance ' WHEN 6 THEN 'Shellcode'
                         ELSE 'Mystery' END END AS attack_cat,
             CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS label
      FROM lineitem""",
}
_NEEDS = {"alerts": ["typed"], "messages": ["typed"], "sessions": ["alerts"]}


def with_views(sql: str, views: list[str]) -> str:
    """``sql`` with the views it uses in front, each after the views it needs itself."""
    ordered: list[str] = []

    def add(view: str) -> None:
        for needed in _NEEDS.get(view, []):
            add(needed)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        add(view)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in ordered)
    joiner = ",\n" if sql.lstrip().upper().startswith("WITH ") else "\n"
    body = sql.lstrip()[5:] if joiner == ",\n" else sql
    return f"WITH {ctes}{joiner}{body}"
