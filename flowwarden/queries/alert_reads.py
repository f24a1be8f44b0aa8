"""Reads and aggregates of the alert table."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowwarden.functions.scalars import category_or, format_iso, half_up, lookup, safe_float, safe_int
from flowwarden.operators import analytics, joins, labels, ranking, sampling
from flowwarden.plans import bindings, score
from flowwarden.queries.registry import query
from flowwarden.schemas import ATTACK_TYPES, SEVERITIES

SESSION = "session-3"


def _session(spark, d):
    return bindings.alerts(spark, d).where(F.col("session_id") == SESSION)


def _as_of(spark, d):
    return analytics.newest_time(bindings.alerts(spark, d))


_LISTED = ["session_id", "alert_id", "alert_time", "attack_type", "severity"]
_LISTED_SQL = "session_id, alert_id, alert_time, attack_type, severity"

# --- counts

_FACETS = """
  SELECT {by} CASE WHEN grouping(severity) = 0 THEN 'severity' WHEN grouping(attack_type) = 0 THEN 'attack_type'
              ELSE 'total' END AS facet,
         coalesce(severity, attack_type, 'all') AS name, CAST(count(*) AS BIGINT) AS alerts
  FROM {source} GROUP BY GROUPING SETS ({sets})"""


@query(
    _FACETS.format(
        by="",
        source="""(SELECT * FROM alerts WHERE session_id = 'session-3'
                   AND alert_time >= (SELECT max(alert_time) FROM alerts) - INTERVAL 24 HOUR) s""",
        sets="(), (severity), (attack_type)",
    ),
    ("alerts",),
)
def a01_alert_stats(spark, d):
    return analytics.alert_stats(_session(spark, d), _as_of(spark, d), hours=24)


@query(
    _FACETS.format(
        by="session_id,",
        source="alerts",
        sets="(session_id), (session_id, severity), (session_id, attack_type)",
    ),
    ("alerts",),
)
def a01_alert_stats_all_sessions(spark, d):
    return analytics.alert_stats(bindings.alerts(spark, d), hours=None, by=["session_id"])


@query(
    _FACETS.format(
        by="",
        source="""(SELECT * FROM (SELECT * FROM alerts WHERE session_id = 'session-3'
                     ORDER BY alert_time DESC, alert_id LIMIT 10000) c
                   WHERE alert_time >= (SELECT max(alert_time) FROM alerts) - INTERVAL 240 HOUR) s""",
        sets="(), (severity), (attack_type)",
    ),
    ("alerts",),
)
def a01_alert_stats_newest_10000(spark, d):
    return analytics.alert_stats(_session(spark, d), _as_of(spark, d), hours=240, cap=10_000)


@query("SELECT 'total' AS facet, 'all' AS name, count(*) AS alerts FROM alerts WHERE session_id = 'none such'", ("alerts",))
def a01_alert_stats_without_alerts(spark, d):
    rows = bindings.alerts(spark, d).where(F.col("session_id") == "none such")
    return analytics.alert_stats(rows, hours=None)


@query(
    """SELECT session_id, CAST(count(*) FILTER (severity = 'high') AS BIGINT) AS high,
              CAST(count(*) FILTER (severity = 'medium') AS BIGINT) AS medium,
              CAST(count(*) FILTER (severity = 'low') AS BIGINT) AS low,
              CAST(count(*) FILTER (severity = 'info') AS BIGINT) AS info
       FROM alerts GROUP BY session_id""",
    ("alerts",),
)
def a02_severity_counts(spark, d):
    return analytics.severity_counts(bindings.alerts(spark, d), ["session_id"])


@query(
    f"""SELECT CAST(row_number() OVER (ORDER BY n DESC, attack_type) AS INTEGER) AS rank, attack_type, n,
              CAST((n * 2000 + total) // (2 * total) AS BIGINT) / CAST(10.0 AS DOUBLE) AS percent,
              CASE attack_type {' '.join(f"WHEN '{t}' THEN '{s}'" for t, s in SEVERITIES.items())} ELSE 'info' END AS severity
       FROM (SELECT attack_type, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
             FROM alerts GROUP BY attack_type) c""",
    ("alerts",),
)
def a03_threat_share(spark, d):
    return analytics.threat_shares(bindings.alerts(spark, d))


@query("SELECT attack_type, count(*) AS n FROM alerts GROUP BY attack_type", ("alerts",))
def a04_class_distribution(spark, d):
    return analytics.distribution(bindings.alerts(spark, d), "attack_type")


@query(
    "SELECT attack_cat_id, severity, count(*) AS n FROM alerts GROUP BY attack_cat_id, severity", ("alerts",)
)
def a05_two_key_distribution(spark, d):
    return analytics.distribution(bindings.alerts(spark, d), "attack_cat_id", "severity").orderBy("attack_cat_id")


@query("SELECT DISTINCT attack_type FROM alerts", ("alerts",))
def a18_distinct_sorted(spark, d):
    return bindings.alerts(spark, d).select("attack_type").distinct().orderBy("attack_type")


# --- time buckets

_TIMELINE = """
  SELECT date_trunc('hour', alert_time) + to_minutes(CAST((minute(alert_time) // {i}) * {i} AS INTEGER)) AS bucket,
         count(*) AS alerts
  FROM alerts WHERE {where} GROUP BY 1"""
_LAST_DAY = "session_id = 'session-3' AND alert_time >= (SELECT max(alert_time) FROM alerts) - INTERVAL 24 HOUR"


@query(_TIMELINE.format(i=60, where=_LAST_DAY), ("alerts",))
def t01_timeline(spark, d):
    return analytics.timeline(_session(spark, d), 60, _as_of(spark, d), hours=24)


@query(_TIMELINE.format(i=45, where="true"), ("alerts",))
def t01_timeline_in_hour_45(spark, d):
    return analytics.timeline(bindings.alerts(spark, d), 45, hours=None)


@query(
    """SELECT time_bucket(INTERVAL 45 MINUTE, alert_time, TIMESTAMP '1970-01-01') AS bucket, count(*) AS alerts
       FROM alerts GROUP BY 1""",
    ("alerts",),
)
def t01_timeline_even_45(spark, d):
    return analytics.timeline(bindings.alerts(spark, d), 45, hours=None, even=True)


@query(
    """SELECT session_id, date_trunc('hour', alert_time) AS bucket, count(*) AS alerts
       FROM alerts GROUP BY ALL""",
    ("alerts",),
)
def t01_timeline_all_sessions(spark, d):
    return analytics.timeline(bindings.alerts(spark, d), 60, hours=None, by=["session_id"])


@query(
    f"""SELECT bucket, alerts, strftime(bucket, '%H:%M') AS label
        FROM ({_TIMELINE.format(i=15, where='true')}) t""",
    ("alerts",),
)
def t02_bucket_labels(spark, d):
    buckets = analytics.timeline(bindings.alerts(spark, d), 15, hours=None)
    return buckets.withColumn("label", analytics.bucket_label(F.col("bucket")))


# --- filters


@query(f"SELECT {_LISTED_SQL} FROM alerts WHERE binary_prediction = 1", ("alerts",))
def f01_attack_rows(spark, d):
    return score.attacks(bindings.alerts(spark, d)).select(*_LISTED)


@query(f"SELECT {_LISTED_SQL} FROM alerts WHERE coalesce(binary_prediction, 0) <> 1", ("alerts",))
def f02_normal_rows(spark, d):
    return score.normals(bindings.alerts(spark, d)).select(*_LISTED)


@query(f"SELECT {_LISTED_SQL} FROM alerts WHERE lower(attack_type) = 'dos'", ("alerts",))
def f03_type_filter(spark, d):
    return ranking.of_type(bindings.alerts(spark, d), "dOS").select(*_LISTED)


@query(f"SELECT {_LISTED_SQL} FROM alerts WHERE lower(severity) = 'high'", ("alerts",))
def f04_severity_filter(spark, d):
    return ranking.of_severity(bindings.alerts(spark, d), "High").select(*_LISTED)


@query(
    f"""SELECT {_LISTED_SQL} FROM alerts
        WHERE alert_time >= (SELECT max(alert_time) FROM alerts) - INTERVAL 72 HOUR""",
    ("alerts",),
)
def f05_time_cutoff(spark, d):
    return analytics.since(bindings.alerts(spark, d), _as_of(spark, d), 72).select(*_LISTED)


@query(
    f"SELECT {_LISTED_SQL}, binary_probability FROM alerts WHERE binary_prediction = 1 AND binary_probability >= 0.2",
    ("alerts",),
)
def f06_high_confidence(spark, d):
    # The probabilities of the view rarely reach the usual 0.8.
    return score.high_confidence(bindings.alerts(spark, d), 0.2).select(*_LISTED, "binary_probability")


@query("SELECT DISTINCT attack_type FROM alerts WHERE attack_type <> 'Normal'", ("alerts",))
def f07_types_without_normal(spark, d):
    types = bindings.alerts(spark, d).select("attack_type").where(F.col("attack_type") != "Normal")
    return types.distinct().orderBy("attack_type")


@query(
    "SELECT alert_id, src_ip, dst_ip, protocol FROM alerts WHERE src_ip IS NOT NULL AND dst_ip IS NOT NULL",
    ("alerts",),
)
def f09_drop_null_rows(spark, d):
    rows = bindings.alerts(spark, d).select("alert_id", "src_ip", "dst_ip", "protocol")
    return rows.na.drop(subset=["src_ip", "dst_ip"])


# --- latest rows, top-N, order


@query(
    f"SELECT {_LISTED_SQL} FROM alerts WHERE session_id = 'session-3' ORDER BY alert_time DESC, alert_id LIMIT 100",
    ("alerts",),
)
def l01_latest_alerts(spark, d):
    return ranking.latest(_session(spark, d).select(*_LISTED), 100)


@query(
    f"""SELECT {_LISTED_SQL} FROM alerts WHERE session_id = 'session-3' AND lower(attack_type) = 'exploits'
        ORDER BY alert_time DESC, alert_id LIMIT 100""",
    ("alerts",),
)
def l02_latest_of_type(spark, d):
    return ranking.latest_of_type(_session(spark, d).select(*_LISTED), "Exploits", 100)


@query(
    f"""SELECT {_LISTED_SQL} FROM (
          SELECT * FROM alerts WHERE session_id = 'session-3' ORDER BY alert_time DESC, alert_id LIMIT 500) n
        WHERE lower(attack_type) = 'exploits' ORDER BY alert_time DESC, alert_id LIMIT 100""",
    ("alerts",),
)
def l03_latest_of_type_bounded(spark, d):
    return ranking.latest_of_type_bounded(_session(spark, d).select(*_LISTED), "Exploits", 100)


@query(
    f"""SELECT {_LISTED_SQL} FROM alerts
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY alert_time DESC, alert_id) <= 100""",
    ("alerts",),
)
def l04_latest_per_session(spark, d):
    rows = bindings.alerts(spark, d).select(*_LISTED)
    return ranking.top_n_per_key(rows, ["session_id"], ranking.newest_first(), 100)


@query("SELECT * FROM sessions ORDER BY created_at DESC, session_id LIMIT 5", ("sessions",))
def l05_recent_sessions(spark, d):
    return ranking.recent_sessions(bindings.sessions(spark, d), 5)



@query(f"SELECT {_LISTED_SQL} FROM alerts", ("alerts",))
def l06_sort_by_type(spark, d):
    return ranking.sort_for_display(bindings.alerts(spark, d).select(*_LISTED), "attack_type", ascending=True)


@query(
    "SELECT alert_id, alert_time, binary_probability FROM alerts", ("alerts",)
)
def l06_sort_by_probability(spark, d):
    rows = bindings.alerts(spark, d).select("alert_id", "alert_time", "binary_probability")
    return ranking.sort_for_display(rows, "binary_probability", ascending=False)


@query(
    """SELECT severity, n, CAST(row_number() OVER (ORDER BY n DESC, severity) AS INTEGER) AS rank
       FROM (SELECT severity, count(*) AS n FROM alerts GROUP BY severity) c""",
    ("alerts",),
)
def l09_rank_by_count(spark, d):
    return analytics.ranked_counts(bindings.alerts(spark, d), "severity")


@query(
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
)
def l10_last_write_per_key(spark, d):
    rows = bindings.table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return ranking.last_write(rows, ["user_id"], ["event_id"])


# --- joins


@query(
    """SELECT a.alert_id, a.attack_cat_id, coalesce(m.attack_type, 'Unknown') AS attack_type
       FROM alerts a LEFT JOIN (VALUES (0, 'Normal'), (1, 'DoS'), (2, 'Exploits'), (3, 'Fuzzers'), (4, 'Generic'))
         AS m(id, attack_type) ON a.attack_cat_id = m.id""",
    ("alerts",),
)
def j01_names_by_id(spark, d):
    names = [(i, n) for i, n in ATTACK_TYPES.items() if i < 5]
    dim = F.broadcast(spark.createDataFrame(names, "id int, attack_type string"))
    rows = bindings.alerts(spark, d).select("alert_id", "attack_cat_id")
    return joins.lookup_join(rows, dim, "attack_cat_id", "id", "attack_type", "attack_type", "Unknown")


@query(
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'high' WHEN 'view' THEN 'high' ELSE 'medium' END AS on_write,
              CASE event_type WHEN 'click' THEN 'high' WHEN 'view' THEN 'high' ELSE 'info' END AS on_display FROM events"""
)
def j02_severity_defaults(spark, d):
    # Two event types stand for known attacks (one by its other spelling), the rest have no severity.
    kind = lookup(F.col("event_type"), {"click": "DoS", "view": "Backdoor", "error": "Unheard of"}, "")
    return bindings.table(spark, d, "events").select(
        "event_id",
        joins.severity_of(kind, "medium").alias("on_write"),
        joins.severity_of(kind, "info").alias("on_display"),
    )


@query(
    f"""SELECT alert_id, attack_type, CASE attack_type {' '.join(f"WHEN '{t}' THEN '{s}'" for t, s in SEVERITIES.items())}
               ELSE 'medium' END AS severity FROM alerts""",
    ("alerts",),
)
def j02_severity_by_type(spark, d):
    dim = F.broadcast(spark.createDataFrame(list(SEVERITIES.items()), "type string, severity string"))
    rows = bindings.alerts(spark, d).select("alert_id", "attack_type")
    return joins.lookup_join(rows, dim, "attack_type", "type", "severity", "severity", "medium")


@query(
    """SELECT s.session_id, s.dataset, s.created_at, CAST(coalesce(c.n, 0) AS BIGINT) AS alerts FROM sessions s
       LEFT JOIN (SELECT session_id, count(*) AS n FROM alerts GROUP BY session_id) c
         ON s.session_id = c.session_id""",
    ("alerts", "sessions"),
)
def j03_session_alert_counts(spark, d):
    return joins.session_counts(bindings.sessions(spark, d), bindings.alerts(spark, d))


_REGISTERED = "(SELECT session_id FROM sessions WHERE session_id <> 'session-5')"


@query(f"SELECT {_LISTED_SQL} FROM alerts WHERE session_id IN {_REGISTERED}", ("alerts", "sessions"))
def j04_registered_sessions_only(spark, d):
    known = bindings.sessions(spark, d).where(F.col("session_id") != "session-5")
    return joins.registered_only(bindings.alerts(spark, d), known).select(*_LISTED)


@query(f"SELECT {_LISTED_SQL} FROM alerts WHERE session_id NOT IN {_REGISTERED}", ("alerts", "sessions"))
def j04_orphan_alerts(spark, d):
    known = bindings.sessions(spark, d).where(F.col("session_id") != "session-5")
    return joins.orphans(bindings.alerts(spark, d), known).select(*_LISTED)


@query(
    f"SELECT {_LISTED_SQL} FROM alerts WHERE severity IN ('high', 'info')",
    ("alerts",),
)
def j05_not_yet_replicated(spark, d):
    source = bindings.alerts(spark, d).select(*_LISTED)
    target = source.where(F.col("severity").isin("medium", "low"))
    return joins.not_in(source, target, ["session_id", "alert_time", "alert_id"])


# --- projections


@query(
    """SELECT event_id, CASE WHEN event_id % 6 IN (0, 1, 2, 3) THEN -1 ELSE CAST(trunc(-value) AS INTEGER) END AS as_int,
              CASE event_id % 6 WHEN 0 THEN CAST(-1 AS DOUBLE) WHEN 1 THEN CAST(-1 AS DOUBLE)
                   WHEN 2 THEN CAST(7.5 AS DOUBLE) WHEN 3 THEN CAST(3.7 AS DOUBLE) ELSE -value END AS as_float,
              CASE event_id % 6 WHEN 0 THEN -1 WHEN 1 THEN -1 WHEN 2 THEN -1 WHEN 3 THEN -1 ELSE CAST(event_id AS INTEGER) END
                AS text_int
       FROM events"""
)
def p16_safe_coercion(spark, d):
    case = F.col("event_id") % 6
    number = (
        F.when(case == 0, None)
        .when(case == 1, float("nan"))
        .when(case == 2, float("inf"))
        .when(case == 3, 1e300)
        .otherwise(-F.col("value"))
    )
    text = (
        F.when(case == 0, None).when(case == 1, "x").when(case == 2, "7.5").when(case == 3, "3.7")
    )
    return bindings.table(spark, d, "events").select(
        "event_id",
        safe_int(number, -1).alias("as_int"),
        safe_float(F.when(case < 4, text).otherwise((-F.col("value")).cast("string")), -1.0).alias("as_float"),
        safe_int(F.when(case < 4, text).otherwise(F.col("event_id").cast("string")), -1).alias("text_int"),
    )


@query(
    """SELECT record_id, session_id, 1 AS binary_prediction, rate / 500 AS binary_probability,
              coalesce(nullif(t, ''), 'Unknown') AS attack_type, CAST(0.0 AS DOUBLE) AS attack_confidence,
              CASE t WHEN 'DoS' THEN 'high' WHEN 'Worms' THEN 'medium' ELSE 'medium' END AS severity,
              '' AS src_ip, '' AS dst_ip, 0 AS src_port, 0 AS dst_port, proto AS protocol,
              CAST(sbytes AS BIGINT) AS sbytes, CAST(dbytes AS BIGINT) AS dbytes, rate
       FROM (SELECT *, CASE attack_cat WHEN 'click' THEN 'DoS' WHEN 'view' THEN 'Worms' WHEN 'error' THEN '' END AS t
             FROM messages) m""",
    ("messages",),
)
def p17_alert_projection(spark, d):
    kind = lookup(F.col("attack_cat"), {"click": "DoS", "view": "Worms", "error": ""}, None)
    rows = bindings.messages(spark, d).drop("event_time").select(
        "*",
        F.lit(1.0).alias("binary_prediction"),
        (F.col("rate") / 500).alias("binary_probability"),
        kind.alias("attack_type"),
        F.lit(None).cast("double").alias("attack_confidence"),
    )
    return score.to_alerts(rows)


@query(
    """SELECT 'session-x' AS session_id, ts AS alert_time,
              CASE WHEN event_id % 3 = 0 THEN 'own-' || event_id ELSE CAST(event_id AS VARCHAR) END AS alert_id, value AS rate
       FROM events"""
)
def p18_alert_enrichment(spark, d):
    rows = bindings.table(spark, d, "events").select(
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("own-"), F.col("event_id").cast("string"))).alias("alert_id"),
        F.col("event_id").cast("string").alias("record_id"),
        F.col("ts").alias("event_time"),
        F.col("value").alias("rate"),
    )
    out = score.enrich_alerts(rows, F.lit("session-x"))
    return out.withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


@query(
    """SELECT attack_cat_id, attack_type, count(*) AS alerts FROM alerts GROUP BY ALL""", ("alerts",)
)
def p19_class_names(spark, d):
    dim = spark.createDataFrame(list(ATTACK_TYPES.items()), "attack_cat_id int, attack_type string")
    used = bindings.alerts(spark, d).groupBy("attack_cat_id").agg(F.count(F.lit(1)).alias("alerts"))
    return used.join(F.broadcast(dim), "attack_cat_id")


@query(
    """SELECT alert_id, strftime(alert_time, '%H:%M:%S') AS clock, coalesce(nullif(attack_type, ''), 'Unknown') AS attack_type,
              coalesce(nullif(severity, ''), 'info') AS severity,
              CAST(round(CAST(binary_probability AS DECIMAL(18, 6)), 3) AS VARCHAR) AS probability,
              coalesce(src_ip, '—') || ':' || coalesce(CAST(src_port AS VARCHAR), '') AS source,
              coalesce(dst_ip, '—') || ':' || coalesce(CAST(dst_port AS VARCHAR), '') AS target,
              coalesce(protocol, '—') AS protocol
       FROM alerts""",
    ("alerts",),
)
def p20_display_rows(spark, d):
    def end(ip: str, port: str):
        shown = F.coalesce(F.nullif(ip, F.lit("")), F.lit("—"))
        return F.concat(shown, F.lit(":"), F.coalesce(F.col(port).cast("string"), F.lit("")))

    return bindings.alerts(spark, d).select(
        "alert_id",
        F.substring(format_iso(F.col("alert_time")), 12, 8).alias("clock"),
        category_or(F.col("attack_type"), "Unknown").alias("attack_type"),
        category_or(F.col("severity"), "info").alias("severity"),
        half_up(F.coalesce("binary_probability", F.lit(0.0)), 3).cast("string").alias("probability"),
        end("src_ip", "src_port").alias("source"),
        end("dst_ip", "dst_port").alias("target"),
        F.coalesce(F.nullif("protocol", F.lit("")), F.lit("—")).alias("protocol"),
    )


@query(
    """SELECT m.id AS attack_cat_id, m.attack_type, count(*) AS events
       FROM events e JOIN (VALUES ('click', 0, 'click'), ('error', 1, 'error'), ('view', 4, 'view')) AS m(e, id, attack_type)
         ON e.event_type = m.e GROUP BY ALL"""
)
def p21_label_map_rows(spark, d):
    # Every row carries a map in the plain layout; two of its ids are no integers.
    kind = F.col("event_type")
    ids = lookup(kind, {"click": "0", "error": "1", "view": "4", "purchase": "two", "signup": "x3"}, "")
    maps = bindings.table(spark, d, "events").select(F.create_map(ids, kind).alias("names"))
    rows = labels.label_map_rows(maps, "names")
    return rows.groupBy("attack_cat_id", "attack_type").agg(F.count(F.lit(1)).alias("events"))


# --- set operations


@query(
    """SELECT alert_id, severity, src_ip, NULL::VARCHAR AS dst_ip FROM alerts WHERE binary_prediction = 1
       UNION ALL SELECT alert_id, severity, NULL, dst_ip FROM alerts""",
    ("alerts",),
)
def u01_concat_by_name(spark, d):
    rows = bindings.alerts(spark, d)
    return sampling.concat(
        score.attacks(rows).select("alert_id", "severity", "src_ip"), rows.select("dst_ip", "severity", "alert_id")
    )
