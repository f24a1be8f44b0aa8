"""Sources, sinks and table maintenance: everything is written, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowwarden.operators import analytics, metrics, ranking
from flowwarden.plans import bindings, prepare
from flowwarden.queries.registry import query
from flowwarden.schemas import ALERT_SCHEMA, ATTACK_TYPES, FEATURES
from flowwarden.session import work_path
from flowwarden.sources import alert_table, messages, readers
from flowwarden.sources.folders import folders

_LISTED = ["session_id", "alert_id", "alert_time", "attack_type", "severity", "rate"]
_LISTED_SQL = "session_id, alert_id, alert_time, attack_type, severity, rate"


def _listed(df):
    return df.select(*_LISTED).withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


def _stored_alerts(spark, d, rows=None):
    """A new alert table that holds the alerts of the view and their sessions."""
    path = work_path(spark, "alerts")
    alert_table.create_tables(spark, path)
    alert_table.store_alerts(rows if rows is not None else bindings.alerts(spark, d), path, 1)
    alert_table.store_sessions(bindings.sessions(spark, d), path, 1)
    return path


# --- batch sources


@query("SELECT * FROM lineitem")
def s05_csv_scan(spark, d):
    path = work_path(spark, "csv")
    rows = bindings.table(spark, d, "lineitem")
    rows.write.option("header", True).csv(path)
    return readers.read_csv(spark, path, rows.schema)


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"""
)
def s06_multi_file_scan(spark, d):
    path = work_path(spark, "parts")
    rows = bindings.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rows.repartition(4).write.option("header", True).csv(path)
    return readers.read_flow_files(spark, path, ["flows_*.csv", "part-*.csv"], rows.schema)


@query("SELECT l_orderkey, l_extendedprice, l_shipdate FROM lineitem")
def s07_parquet_scan(spark, d):
    return readers.read_table(spark, f"{d}/lineitem.parquet").select("l_orderkey", "l_extendedprice", "l_shipdate")


@query(
    """SELECT layout, attack_cat_id, attack_type, count(*) AS alerts FROM alerts, (VALUES ('both'), ('plain')) l(layout) GROUP BY ALL""", ("alerts",)
)
def s08_json_sidecars(spark, d):
    # The label map is written in its layouts and read back; ids and names join the alerts.
    ids = {n: i for i, n in ATTACK_TYPES.items()}
    counts = bindings.alerts(spark, d).groupBy("attack_cat_id").agg(F.count(F.lit(1)).alias("alerts"))
    parts = []
    for layout in ("both", "plain"):
        path = work_path(spark, f"sidecar-{layout}")
        readers.write_label_map(spark, path, ids, layout)
        parts.append(counts.join(readers.read_label_map(spark, path), "attack_cat_id").withColumn("layout", F.lit(layout)))
    return parts[0].unionByName(parts[1])


@query(
    f"SELECT {_LISTED_SQL} FROM alerts WHERE session_id = 'session-3' ORDER BY alert_time DESC, alert_id LIMIT 100", ("alerts",)
)
def s09_session_alert_scan(spark, d):
    path = _stored_alerts(spark, d)
    return _listed(alert_table.latest_alerts(spark, path, "session-3", 100))


@query(
    """SELECT session_id, alert_id, severity, rate FROM alerts WHERE sbytes % 10 <> 0
       QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY alert_time DESC, alert_id) <= 100""",
    ("alerts",),
)
def s10_recent_list(spark, d):
    # Every alert is one JSON element; some elements are broken and must be skipped.
    rows = bindings.alerts(spark, d).select("session_id", "alert_id", F.col("alert_time").cast("timestamp").alias("alert_time"), "severity", "rate", "sbytes")
    text = F.when(F.col("sbytes") % 10 == 0, F.lit('{"alert_id": ')).otherwise(F.to_json(F.struct("*"), messages.JSON_TIMES))
    path = work_path(spark, "recent")
    rows.select(text.alias("value")).write.text(path)
    parsed = messages.parse_messages(spark.read.text(path), rows.schema)
    good = messages.good_rows(parsed, rows.schema)
    newest = ranking.top_n_per_key(good, ["session_id"], ranking.newest_first(), 100)
    return newest.select("session_id", "alert_id", "severity", "rate")


@query("SELECT * FROM sessions", ("sessions",))
def s11_session_scan(spark, d):
    path = work_path(spark, "sessions")
    alert_table.create_tables(spark, path)
    alert_table.store_sessions(bindings.sessions(spark, d), path, 1)
    rows = alert_table.read_sessions(spark, path)
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query(
    """SELECT CASE WHEN user_id % 8 = 7 THEN 'local-session' ELSE 'session-' || CAST(user_id % 8 AS VARCHAR) END AS session_id,
              CASE WHEN event_id % 9 < 2 THEN 'made' ELSE CAST(event_id AS VARCHAR) END AS alert_id,
              CASE WHEN event_id % 11 < 2 THEN TIMESTAMP '1970-01-01' ELSE ts END AS alert_time,
              event_type AS attack_type, '' AS severity, value AS rate, CAST(0 AS BIGINT) AS sbytes
       FROM events
       UNION ALL SELECT 'session-twins', 'made', TIMESTAMP '2026-01-01 10:00:00', 'DoS', '', CAST(1 AS DOUBLE), CAST(0 AS BIGINT)
       FROM events, (VALUES (1), (2)) twice(i) WHERE event_id % 500 = 0"""
)
def s12_ingest_payloads(spark, d):
    # Payload files of at most a hundred alerts each; one session is absent from its payloads. Some ids are
    # missing or empty, some times bad, empty or in another zone, and some payloads hold two equal alerts.
    event, user = F.col("event_id"), F.col("user_id") % 8
    own_time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    other_zone = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL '5:30' HOUR TO MINUTE"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    alert = F.struct(
        F.when(event % 9 == 0, F.lit(None).cast("string")).when(event % 9 == 1, "").otherwise(event.cast("string")).alias("alert_id"),
        F.lit("overridden").alias("session_id"),
        F.when(event % 11 == 0, "bad").when(event % 11 == 1, "").when(event % 11 == 2, other_zone).otherwise(own_time).alias("alert_time"),
        F.col("event_type").alias("attack_type"),
        F.col("value").alias("rate"),
    )
    twin = F.struct(
        F.lit(None).cast("string").alias("alert_id"), F.lit("x").alias("session_id"),
        F.lit("2026-01-01T10:00:00Z").alias("alert_time"), F.lit("DoS").alias("attack_type"), F.lit(1.0).alias("rate"),
    )
    session = F.when(user != 7, F.concat(F.lit("session-"), user.cast("string")))
    events = bindings.table(spark, d, "events")
    payloads = (
        events.groupBy(session.alias("session_id"), (event / 100).cast("bigint").alias("part"))
        .agg(F.collect_list(alert).alias("alerts"))
        .drop("part")
        .unionByName(events.where(event % 500 == 0).select(F.lit("session-twins").alias("session_id"), F.array(twin, twin).alias("alerts")))
        .withColumn("sessions", F.array(F.struct("session_id", F.lit("flows").alias("dataset"))))
    )
    folder, path = work_path(spark, "payloads"), work_path(spark, "ingested")
    payloads.write.json(folder)
    alert_table.create_tables(spark, path)
    schema = (
        "session_id string, sessions array<struct<session_id string, dataset string>>, alerts array<struct<"
        "alert_id string, session_id string, alert_time string, attack_type string, rate double>>"
    )
    for _ in range(2):  # the second run replaces the first
        alert_table.ingest(spark.read.schema(schema).json(folder), path, 1, "local-session", writer="dashboard")
    made = F.when(F.length("alert_id") == 32, "made").otherwise(F.col("alert_id"))
    return _listed(alert_table.read_alerts(spark, path).withColumn("alert_id", made)).withColumn("sbytes", F.lit(0).cast("bigint"))


# --- sinks


_UPSERT = """
  SELECT session_id, alert_id, alert_time, CASE WHEN sbytes % 3 = 0 THEN 'Rewritten' ELSE attack_type END AS attack_type,
         severity, rate FROM alerts"""


@query(_UPSERT, ("alerts",))
def k02_alert_upsert(spark, d):
    # A third of the rows is written again; every row of the first write comes twice.
    rows = bindings.alerts(spark, d)
    path = _stored_alerts(spark, d, rows.unionByName(rows))
    again = rows.where(F.col("sbytes") % 3 == 0).withColumn("attack_type", F.lit("Rewritten"))
    alert_table.store_alerts(again, path, 2)
    return _listed(alert_table.read_alerts(spark, path))


@query(
    f"""SELECT {', '.join(f.name for f in ALERT_SCHEMA.fields if f.name not in ('src_ip', 'dst_ip', 'src_port', 'dst_port', 'protocol'))},
               coalesce(src_ip, '') AS src_ip, coalesce(dst_ip, '') AS dst_ip, coalesce(src_port, 0) AS src_port,
               coalesce(dst_port, 0) AS dst_port, coalesce(protocol, '') AS protocol FROM alerts""",
    ("alerts",),
)
def k02_alert_defaults(spark, d):
    path = _stored_alerts(spark, d)
    rows = alert_table.read_alerts(spark, path).select(*ALERT_SCHEMA.names)
    return rows.withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


@query(
    f"""SELECT {_LISTED_SQL} FROM alerts
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY alert_time DESC, alert_id) <= 10000""",
    ("alerts",),
)
def k04_capped_recent_list(spark, d):
    path = _stored_alerts(spark, d)
    return _listed(alert_table.recent_alerts(spark, path))


@query(
    """WITH kept AS (SELECT event_id AS row_key, CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS DOUBLE) END AS dur,
          CASE WHEN event_id % 3 <> 0 THEN value END AS rate, CASE WHEN event_type IN ('error', 'view') THEN 1 ELSE 0 END AS label
          FROM events WHERE user_id % 7 <> 0 OR event_id % 3 <> 0),
        filled AS (SELECT row_key, label, coalesce(dur, md) AS dur, coalesce(rate, mr) AS rate
          FROM kept, (SELECT quantile_cont(dur, 0.5) AS md, quantile_cont(rate, 0.5) AS mr FROM kept) m)
       SELECT row_key, label, round(least(greatest(dur, dl), dh), 9) AS dur, round(least(greatest(rate, rl), rh), 9) AS rate
       FROM filled, (SELECT quantile_cont(dur, 0.01) AS dl, quantile_cont(dur, 0.99) AS dh,
                            quantile_cont(rate, 0.01) AS rl, quantile_cont(rate, 0.99) AS rh FROM filled) b"""
)
def k05_prepared_tables(spark, d):
    user, event = F.col("user_id"), F.col("event_id")
    raw = bindings.table(spark, d, "events").select(
        event.alias(" Row_Key"),
        F.when(user % 7 != 0, user.cast("double")).alias("DUR"),
        F.when(event % 3 != 0, F.col("value")).alias("rate "),
        F.when((user % 7 != 0) | (event % 3 != 0), F.col("event_type").isin("error", "view").cast("int")).alias("Label"),
        F.lit("x").alias("attack_cat"),
    )
    # Of four columns a row without both measures and without label has one value: below half.
    train, test = prepare.prepare_flows(raw, ["dur", "rate"], "row_key")
    path = work_path(spark, "prepared-tables")
    prepare.write_prepared(train, test, path)
    both = readers.read_table(spark, f"{path}/train").unionByName(readers.read_table(spark, f"{path}/test"))
    return both.select("row_key", "label", F.round("dur", 9).alias("dur"), F.round("rate", 9).alias("rate"))


@query("SELECT record_id, session_id, rate, proto, dur, label FROM messages", ("messages",))
def k06_publish_messages(spark, d):
    rows = bindings.messages(spark, d).withColumn("id", F.lit(1))
    path = work_path(spark, "topic")
    messages.publish(messages.to_messages(rows), "text", path)
    schema = rows.drop("id").schema
    back = messages.good_rows(messages.parse_messages(spark.read.text(path), schema), schema)
    return back.select("record_id", "session_id", "rate", "proto", "dur", "label")


@query(
    """SELECT attack_cat_id, attack_type, n, CAST(39 AS BIGINT) AS features, 'rules' AS model, '0.5' AS threshold,
              round((SELECT avg(CASE WHEN binary_prediction = (attack_type = 'DoS')::INT THEN CAST(1 AS DOUBLE) ELSE 0 END) FROM alerts), 9) AS accuracy
       FROM (SELECT attack_cat_id, attack_type, count(*) AS n FROM alerts GROUP BY ALL) c""",
    ("alerts",),
)
def k08_metadata_sidecars(spark, d):
    # Label map, feature list and training results (model, parameters, metrics), written and read back.
    path = work_path(spark, "metadata")
    alerts = bindings.alerts(spark, d)
    counts = alerts.groupBy("attack_cat_id").agg(F.count(F.lit(1)).alias("n"))
    matrix = metrics.confusion(alerts.select((F.col("attack_type") == "DoS").cast("int").alias("label"), F.col("binary_prediction").alias("prediction")))
    readers.write_label_map(spark, f"{path}/labels", {n: i for i, n in ATTACK_TYPES.items()})
    readers.write_feature_list(spark, f"{path}/features", FEATURES)
    readers.write_results(spark, f"{path}/results", {"rules": ({"threshold": 0.5}, metrics.overall_metrics(matrix).first().asDict())})
    listed = readers.read_feature_list(spark, f"{path}/features").orderBy("position").collect()
    if [r["feature"] for r in listed] != FEATURES:
        raise ValueError("feature list changed on the way")
    found = readers.read_results(spark, f"{path}/results").first()
    return counts.join(readers.read_label_map(spark, f"{path}/labels"), "attack_cat_id").select(
        "attack_cat_id", "attack_type", "n", F.lit(len(listed)).cast("bigint").alias("features"), F.lit(found["model"]).alias("model"),
        F.lit(found["params"]["threshold"]).alias("threshold"), F.lit(round(found["metrics"]["accuracy"], 9)).alias("accuracy"),
    )


@query(
    f"""SELECT {_LISTED_SQL} FROM (
          SELECT * FROM alerts WHERE session_id = 'session-3' ORDER BY alert_time DESC, alert_id LIMIT 500) n
        UNION SELECT {_LISTED_SQL} FROM alerts WHERE session_id = 'session-3' AND severity = 'high'""",
    ("alerts",),
)
def k09_replicate(spark, d):
    # The target has the session's high alerts already; two runs must not duplicate anything.
    source = _stored_alerts(spark, d)
    target = work_path(spark, "replica")
    alert_table.create_tables(spark, target)
    high = ranking.of_severity(alert_table.read_alerts(spark, source, "session-3"), "high")
    alert_table.write_alerts(high, target, 1)
    # Run, repeated under the same number, and run again under the next.
    for commit in (2, 2, 3):
        alert_table.replicate(spark, source, target, "session-3", commit)
    return _listed(alert_table.read_alerts(spark, target))


# --- session maintenance


@query(
    """SELECT session_id, CASE WHEN session_id = 'session-2' THEN 'again' ELSE dataset END AS dataset,
              CASE WHEN session_id = 'session-2' THEN TIMESTAMP '2030-01-01' ELSE created_at END AS created_at FROM sessions""",
    ("sessions",),
)
def x02_register_session(spark, d):
    path = work_path(spark, "registered")
    alert_table.create_tables(spark, path)
    rows = bindings.sessions(spark, d)
    alert_table.store_sessions(rows, path, 1)
    later = rows.where(F.col("session_id") == "session-2").select(
        "session_id", F.lit("again").alias("dataset"), F.lit("2030-01-01").cast("timestamp").alias("created_at")
    )
    alert_table.store_sessions(later, path, 2)
    return alert_table.read_sessions(spark, path).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("SELECT * FROM sessions ORDER BY created_at DESC, session_id LIMIT 10", ("sessions",))
def x03_list_sessions(spark, d):
    path = work_path(spark, "listed")
    alert_table.create_tables(spark, path)
    alert_table.store_sessions(bindings.sessions(spark, d), path, 1)
    rows = ranking.recent_sessions(alert_table.read_sessions(spark, path), 10)
    return rows.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query(
    """SELECT 'session-3' AS session_id, count(*) AS removed_alerts, true AS session_removed FROM alerts WHERE session_id = 'session-3'""",
    ("alerts",),
)
def x04_delete_session_counts(spark, d):
    return alert_table.delete_session(spark, _stored_alerts(spark, d), "session-3", 2)


@query(
    f"SELECT {_LISTED_SQL} FROM alerts WHERE session_id <> 'session-3' OR attack_type = 'DoS'", ("alerts",)
)
def x04_after_delete(spark, d):
    # The DoS alerts of the session are written again after the delete.
    path = _stored_alerts(spark, d)
    alert_table.delete_session(spark, path, "session-3", 2)
    back = bindings.alerts(spark, d).where((F.col("session_id") == "session-3") & (F.col("attack_type") == "DoS"))
    alert_table.store_alerts(back, path, 3)
    compacted = work_path(spark, "compacted")
    alert_table.compact(spark, path, compacted)
    return _listed(alert_table.read_alerts(spark, compacted))


@query(
    """SELECT (SELECT count(*) FROM sessions) AS removed_sessions, count(*) AS removed_alerts, CAST(0 AS BIGINT) AS left_alerts
       FROM alerts""",
    ("alerts", "sessions"),
)
def x05_delete_all(spark, d):
    path = _stored_alerts(spark, d)
    counts = alert_table.delete_all(spark, path, 2)
    left = alert_table.read_alerts(spark, path).count()
    return counts.withColumn("left_alerts", F.lit(left).cast("bigint"))


@query(
    "SELECT session_id, count(*) AS removed_alerts FROM alerts GROUP BY session_id", ("alerts",)
)
def a19_removed_counts(spark, d):
    """What a delete of each session would remove, counted on the durable table."""
    return alert_table.count_alerts(spark, _stored_alerts(spark, d)).withColumnRenamed("alerts", "removed_alerts")


# --- reads of the stored table


@query(
    f"""SELECT {_LISTED_SQL} FROM (SELECT session_id, alert_id, alert_time, severity, rate,
          CASE WHEN sbytes % 3 = 0 THEN 'Rewritten' ELSE attack_type END AS attack_type FROM alerts) a
        ORDER BY alert_time DESC, alert_id LIMIT 100""",
    ("alerts",),
)
def l01_latest_stored_alerts(spark, d):
    rows = bindings.alerts(spark, d)
    path = _stored_alerts(spark, d)
    again = rows.where(F.col("sbytes") % 3 == 0).withColumn("attack_type", F.lit("Rewritten"))
    alert_table.store_alerts(again, path, 2)
    return _listed(alert_table.latest_alerts(spark, path, n=100))


@query(
    """SELECT CASE WHEN grouping(severity) = 0 THEN 'severity' WHEN grouping(attack_type) = 0 THEN 'attack_type' ELSE 'total' END AS facet,
              coalesce(severity, attack_type, 'all') AS name, count(*) AS alerts
       FROM alerts WHERE session_id = 'session-3' GROUP BY GROUPING SETS ((), (severity), (attack_type))""",
    ("alerts",),
)
def a01_stats_of_stored_alerts(spark, d):
    return analytics.alert_stats(alert_table.read_alerts(spark, _stored_alerts(spark, d), "session-3"), hours=None)


@query("SELECT date_trunc('hour', alert_time) AS bucket, count(*) AS alerts FROM alerts GROUP BY 1", ("alerts",))
def t01_timeline_of_stored_alerts(spark, d):
    out = analytics.timeline(alert_table.read_alerts(spark, _stored_alerts(spark, d)), 60, hours=None)
    return out.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query(
    f"SELECT {_LISTED_SQL}, CAST(2 AS BIGINT) AS folders FROM ({_UPSERT}) a", ("alerts",)
)
def k02_merged_in_place(spark, d):
    """Six small commits, two merges and a late rewrite: reads give the same as before, and two folders of the writer are left."""
    rows, path = bindings.alerts(spark, d), work_path(spark, "merged")
    alert_table.create_tables(spark, path)
    for commit in range(4):
        alert_table.store_alerts(rows.where(F.pmod(F.col("alert_id").cast("bigint"), F.lit(4)) == commit), path, commit)
    alert_table.merge_commits(spark, path)
    again = rows.where(F.col("sbytes") % 3 == 0).withColumn("attack_type", F.lit("Rewritten"))
    alert_table.store_alerts(again.withColumn("attack_type", F.lit("Draft")), path, 4)
    alert_table.store_alerts(again, path, 5)
    alert_table.merge_commits(spark, path)
    left = len(folders(spark, f"{path}/alerts/writer=*/commit=*"))
    return _listed(alert_table.read_alerts(spark, path)).withColumn("folders", F.lit(left).cast("bigint"))


@query(
    f"SELECT {_LISTED_SQL} FROM alerts QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY alert_time DESC, alert_id) = 1",
    ("alerts",),
)
def k03_single_alerts(spark, d):
    # The newest alert of each session: as many alerts as sessions, in one write.
    path = work_path(spark, "single")
    alert_table.create_tables(spark, path)
    newest = ranking.top_n_per_key(bindings.alerts(spark, d), ["session_id"], ranking.newest_first(), 1)
    alert_table.store_alerts(newest, path, 1)
    return _listed(alert_table.read_alerts(spark, path))


@query("SELECT count(DISTINCT session_id) AS sessions, count(DISTINCT session_id) AS different, count(DISTINCT session_id) AS well_formed, count(*) AS alerts FROM alerts", ("alerts",))
def x01_new_session_ids(spark, d):
    """Every session is copied under a new id; the ids are made where the rows are, once for each session."""
    alerts = bindings.alerts(spark, d).select("session_id")
    copied = alert_table.under_new_sessions(alerts)
    return copied.agg(
        F.countDistinct("session_id").alias("sessions"), F.countDistinct("new_session_id").alias("different"),
        F.count_distinct(F.when(F.col("new_session_id").rlike("^session-[0-9a-f]{10}$"), F.col("new_session_id"))).alias("well_formed"),
        F.count(F.lit(1)).alias("alerts"),
    )


@query("SELECT CAST(0 AS BIGINT) AS before, count(*) AS after FROM alerts", ("alerts",))
def x06_create_if_absent(spark, d):
    # Creating the tables again leaves what they hold.
    path = work_path(spark, "created")
    alert_table.create_tables(spark, path)
    before = alert_table.read_alerts(spark, path).count()
    alert_table.store_alerts(bindings.alerts(spark, d), path, 1)
    alert_table.create_tables(spark, path)
    return alert_table.read_alerts(spark, path).agg(F.lit(before).cast("bigint").alias("before"), F.count(F.lit(1)).alias("after"))
