"""The scalar functions on their own."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from flowwarden.functions.scalars import (
    finite_or_zero, floor_in_hour, format_iso, lookup, nan_to_null, parse_iso, record_key, safe_float, safe_int,
)
from flowwarden.operators.joins import severity_of
from flowwarden.plans import bindings
from flowwarden.queries.registry import query
from flowwarden.sources.messages import JSON_TIMES


def _events(spark, d):
    return bindings.table(spark, d, "events")


@query(
    """SELECT trim(attack_cat) AS trimmed, lower(trim(attack_cat)) AS lowered, count(*) AS n FROM raw_flows GROUP BY ALL""",
    ("raw_flows",),
)
def n01_trim_lower(spark, d):
    trimmed = F.trim("attack_cat")
    return (
        bindings.raw_flows(spark, d)
        .groupBy(trimmed.alias("trimmed"), F.lower(trimmed).alias("lowered"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("SELECT event_id, substr(event_type, 2, 3) AS part, event_type || ':' || user_id AS joined FROM events")
def n02_substring_concat(spark, d):
    return _events(spark, d).select(
        "event_id",
        F.substring("event_type", 2, 3).alias("part"),
        F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")).alias("joined"),
    )


_ISO_CASES = """
  SELECT event_id, CASE event_id % 9
           WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
           WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30'
           WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M')
           WHEN 3 THEN 'bad'
           WHEN 4 THEN ''
           WHEN 5 THEN NULL
           WHEN 6 THEN strftime(ts, '%Y%m%dT%H%M%S')
           WHEN 7 THEN strftime(ts, '%Y-%m')
           ELSE strftime(ts, '%Y-%m-%d') END AS text, ts
  FROM events"""


@query(
    f"""SELECT event_id, CASE event_id % 9 WHEN 0 THEN ts
               WHEN 1 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
               WHEN 2 THEN date_trunc('minute', ts) WHEN 6 THEN date_trunc('second', ts)
               WHEN 8 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) ELSE TIMESTAMP '1970-01-01' END AS parsed,
              text FROM ({_ISO_CASES}) c"""
)
def n03_parse_iso(spark, d):
    ts, case = F.col("ts"), F.col("event_id") % 9
    text = (
        F.when(case == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(case == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
        .when(case == 2, F.date_format(ts, "yyyy-MM-dd HH:mm"))
        .when(case == 3, "bad")
        .when(case == 4, "")
        .when(case == 5, None)
        .when(case == 6, F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(case == 7, F.date_format(ts, "yyyy-MM"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
    rows = _events(spark, d).select("event_id", text.alias("text"))
    return rows.withColumn("parsed", parse_iso(F.col("text")).cast("timestamp_ntz"))


@query(
    "SELECT alert_id, strftime(alert_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM alerts", ("alerts",)
)
def n04_format_iso(spark, d):
    return bindings.alerts(spark, d).select("alert_id", format_iso(F.col("alert_time")).alias("iso"))


@query(
    "SELECT event_id, date_trunc('hour', ts) + to_minutes(CAST((minute(ts) // 10) * 10 AS INTEGER)) AS bucket FROM events"
)
def n05_floor_minutes(spark, d):
    return _events(spark, d).select("event_id", floor_in_hour(F.col("ts"), 10).alias("bucket"))


@query(
    """SELECT alert_id, coalesce(src_ip, dst_ip, 'none') AS address,
              CASE WHEN binary_probability >= 0.5 THEN 'likely' WHEN binary_probability >= 0.1 THEN 'possible' ELSE 'unlikely' END AS band
       FROM alerts""",
    ("alerts",),
)
def n06_defaults_and_cases(spark, d):
    p = F.col("binary_probability")
    return bindings.alerts(spark, d).select(
        "alert_id",
        F.coalesce("src_ip", "dst_ip", F.lit("none")).alias("address"),
        F.when(p >= 0.5, "likely").when(p >= 0.1, "possible").otherwise("unlikely").alias("band"),
    )


@query(
    """SELECT CASE WHEN isnan(rate) OR isinf(rate) THEN -1 ELSE CAST(trunc(rate) AS INTEGER) END AS as_int,
              coalesce(dur, CAST(-1 AS DOUBLE)) AS as_float,
              CASE WHEN dbytes % 2 = 0 THEN dbytes ELSE -1 END AS from_text FROM raw_flows""",
    ("raw_flows",),
)
def n07_safe_casts(spark, d):
    return bindings.raw_flows(spark, d).select(
        safe_int(F.col("rate"), -1).alias("as_int"),
        safe_float(F.col("dur"), -1.0).alias("as_float"),
        safe_int(F.when(F.col("dbytes") % 2 == 0, F.col("dbytes").cast("string")).otherwise("odd"), -1).alias("from_text"),
    )


@query(
    """SELECT event_id, round(sqrt(value), 6) AS root, event_id // 7 AS sevenths,
              greatest(value, CAST(user_id AS DOUBLE), CAST(10 AS DOUBLE)) AS highest FROM events"""
)
def n08_math(spark, d):
    value = F.col("value")
    return _events(spark, d).select(
        "event_id",
        F.round(F.sqrt(value), 6).alias("root"),
        F.floor(F.col("event_id") / 7).alias("sevenths"),
        F.array_max(F.array(value, F.col("user_id").cast("double"), F.lit(10.0))).alias("highest"),
    )


@query(
    """SELECT dur IS NULL AS no_dur, isnan(rate) AS is_nan, isinf(rate) AS is_inf,
              CASE WHEN isnan(rate) OR isinf(rate) THEN CAST(0 AS DOUBLE) ELSE rate END AS finite,
              CASE WHEN isnan(rate) THEN NULL ELSE rate END AS number FROM raw_flows""",
    ("raw_flows",),
)
def n09_null_nan_infinity(spark, d):
    rate = F.col("rate")
    return bindings.raw_flows(spark, d).select(
        F.col("dur").isNull().alias("no_dur"),
        F.isnan(rate).alias("is_nan"),
        (F.abs(rate) == float("inf")).alias("is_inf"),
        finite_or_zero(rate).alias("finite"),
        nan_to_null(rate).alias("number"),
    )


@query(
    """SELECT alert_id, CASE attack_cat_id WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'other' END AS word, severity
       FROM alerts""",
    ("alerts",),
)
def n10_map_lookup(spark, d):
    return bindings.alerts(spark, d).select(
        "alert_id",
        lookup(F.col("attack_cat_id"), {1: "one", 2: "two"}, "other").alias("word"),
        severity_of(F.col("attack_type")).alias("severity"),
    )


@query(
    """SELECT event_id, value AS first, CAST(user_id AS DOUBLE) AS second, CAST(0 AS DOUBLE) AS third,
              CAST(NULL AS DOUBLE) AS beyond, CAST(4 AS INTEGER) AS width FROM events"""
)
def n11_arrays(spark, d):
    pair = F.array(F.col("value"), F.col("user_id").cast("double"))
    padded = F.concat(pair, F.array_repeat(F.lit(0.0), 2))
    rows = _events(spark, d).select("event_id", padded.alias("a"))
    at = lambda i: F.get("a", F.lit(i))
    return rows.select(
        "event_id", at(0).alias("first"), at(1).alias("second"), at(2).alias("third"), at(9).alias("beyond"), F.size("a").alias("width")
    )


@query("SELECT event_id, value AS x0, CAST(user_id AS DOUBLE) AS x1 FROM events")
def n12_vectors(spark, d):
    vector = array_to_vector(F.array(F.col("value"), F.col("user_id").cast("double")))
    rows = _events(spark, d).select("event_id", vector_to_array(vector).alias("v"))
    return rows.select("event_id", F.col("v")[0].alias("x0"), F.col("v")[1].alias("x1"))


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type, value, ts FROM events"""
)
def n13_json(spark, d):
    rows = _events(spark, d)
    inner = F.from_json("props", "k int")["k"].alias("k")
    text = F.to_json(F.struct("event_id", inner, "event_type", "value", "ts"), JSON_TIMES).alias("text")
    schema = "event_id bigint, k int, event_type string, value double, ts timestamp_ntz"
    return rows.select(text).select(F.from_json("text", schema, JSON_TIMES).alias("r")).select("r.*")


@query(
    "SELECT event_id, md5(CAST(event_id AS VARCHAR) || chr(1) || coalesce(event_type, '')) AS id FROM events"
)
def n14_repeatable_ids(spark, d):
    return _events(spark, d).select("event_id", record_key(F.col("event_id"), F.col("event_type")).alias("id"))
