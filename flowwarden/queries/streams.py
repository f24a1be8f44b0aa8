"""Streaming queries: message files replayed in time order, run to the end, read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.operators import analytics
from flowwarden.operators.cleanse import clean_features
from flowwarden.plans import bindings, score
from flowwarden.queries.preparation import SCORED_SQL
from flowwarden.queries.registry import query
from flowwarden.schemas import ATTACK_TYPES
from flowwarden.session import work_path
from flowwarden.sources import alert_table, messages
from flowwarden.sources.folders import stored_commits
from flowwarden.streaming import jobs
from flowwarden.streaming.sources import message_stream
from flowwarden.streaming.state import evictions, keyed_state

SLICES = 4
#: Files of one slice: so many tasks write it, and a trigger takes so many.
FILES = 4
_BROKEN = '{"record_id": "oops", "rate": '

_ALERT_ROW = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("alert_time", T.TimestampType()),
        T.StructField("alert_id", T.StringType()),
        T.StructField("attack_type", T.StringType()),
        T.StructField("severity", T.StringType()),
    ]
)


def _cuts(rows, time: str, parts: int = SLICES) -> list[dt.datetime]:
    """Times that cut the table's span into equal parts."""
    first, last = rows.agg(F.min(time), F.max(time)).first()
    return [first + (last - first) * i / parts for i in range(1, parts)]


# The same cuts for the other engine; microseconds are rounded the same way on both sides.
def _slice_sql(time: str) -> str:
    return f"""least({SLICES - 1}, CAST(floor({SLICES} * CAST(epoch_us({time}) - epoch_us((SELECT min(ts) FROM events)) AS DOUBLE)
      / (epoch_us((SELECT max(ts) FROM events)) - epoch_us((SELECT min(ts) FROM events)))) AS BIGINT))"""


def _publish(rows, time: str, path: str, cuts) -> None:
    """Message files of one time slice after the other, as a file source takes files by age. Rows on
    a cut belong to the later slice; each slice is written by ``FILES`` tasks."""
    edges = [None, *cuts, None]
    for start, end in zip(edges, edges[1:]):
        part = rows
        if start is not None:
            part = part.where(F.col(time) >= F.lit(start))
        if end is not None:
            part = part.where(F.col(time) < F.lit(end))
        messages.publish(part.select("value").repartition(FILES), "text", path)


def _replay(spark, rows, time: str, broken=None) -> str:
    """Publish a table as message files in time order; returns the folder."""
    path = work_path(spark, "messages")
    value = F.to_json(F.struct(*rows.columns), messages.JSON_TIMES)
    if broken is not None:
        value = F.when(broken, F.lit(_BROKEN)).otherwise(value)
    _publish(rows.select(value.alias("value"), F.col(time).alias("_time")), "_time", path, _cuts(rows, time))
    return path


def _flow_messages(spark, d, broken=None):
    rows = bindings.messages(spark, d)
    return _replay(spark, rows, "event_time", broken), rows.schema


def _alert_rows(spark, d):
    rows = bindings.alerts(spark, d)
    return rows.withColumn("alert_time", F.col("alert_time").cast("timestamp")).select(*_ALERT_ROW.names)


def _alert_stream(spark, folder, cap=FILES):
    stream = message_stream(spark, folder, fmt="text", cap=cap)
    return messages.good_rows(messages.parse_messages(stream, _ALERT_ROW), _ALERT_ROW)


def _to_parquet(spark, stream, name, on_batch=jobs.batch_writer, mode="append", skip_empty=False):
    out = work_path(spark, name)
    offsets = work_path(spark, f"{name}-offsets")
    jobs.run_to_end(jobs.start(stream, on_batch(out), offsets, trigger=None, mode=mode, skip_empty=skip_empty))
    return out


def _rules(flows):
    return score.rule_scores(clean_features(flows, score.RULE_FEATURES))


def _scored_table(spark, d, broken=None, scorer=_rules, streams=1):
    """The alert table after ``streams`` streams, each with a checkpoint of its own, have scored the messages."""
    folder, schema = _flow_messages(spark, d, broken)
    path = work_path(spark, "scored")
    alert_table.create_tables(spark, path)
    for _ in range(streams):
        offsets = work_path(spark, "scored-offsets")
        job = jobs.scoring_batch(schema, scorer, path, alert_table.writer_of(offsets))
        stream = message_stream(spark, folder, fmt="text", cap=FILES)
        jobs.run_to_end(jobs.start(stream, job, offsets, trigger=None))
    return path


@query("SELECT record_id, session_id, rate FROM messages", ("messages",))
def s01_stream_source(spark, d):
    folder, _ = _flow_messages(spark, d)
    stream = message_stream(spark, folder, fmt="text", cap=2 * FILES)
    out = spark.read.parquet(_to_parquet(spark, stream, "raw"))
    field = lambda c: F.get_json_object("value", f"$.{c}")
    return out.select(
        field("record_id").alias("record_id"), field("session_id").alias("session_id"), field("rate").cast("double").alias("rate")
    )


_BROKEN_SQL = "CAST(record_id AS BIGINT) % 50 = 0"


def _broken():
    return F.col("record_id").cast("bigint") % 50 == 0


@query(f"SELECT record_id, event_time, session_id, dur, proto, rate, label FROM messages WHERE NOT ({_BROKEN_SQL})", ("messages",))
def s04_decode_messages(spark, d):
    # One message in fifty is broken text and must not come out as a row of nulls.
    folder, schema = _flow_messages(spark, d, _broken())
    stream = message_stream(spark, folder, fmt="text", cap=0)
    flows = messages.good_rows(messages.parse_messages(stream, schema), schema)
    out = spark.read.parquet(_to_parquet(spark, flows, "decoded"))
    return out.select(
        "record_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "session_id", "dur", "proto", "rate", "label"
    )


@query(f"SELECT {', '.join(_ALERT_ROW.names)} FROM alerts", ("alerts",))
def k01_foreach_batch_sink(spark, d):
    folder = _replay(spark, _alert_rows(spark, d), "alert_time")

    out = spark.read.parquet(_to_parquet(spark, _alert_stream(spark, folder), "sunk", skip_empty=True))
    return out.select(*_ALERT_ROW.names).withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


_SEVERITY = "CASE attack_type WHEN 'DoS' THEN 'high' WHEN 'Exploits' THEN 'high' WHEN 'Shellcode' THEN 'high' WHEN 'Backdoors' THEN 'high' WHEN 'Reconnaissance' THEN 'low' WHEN 'Analysis' THEN 'low' ELSE 'medium' END"


@query(
    f"""SELECT session_id, event_time AS alert_time, record_id AS alert_id, attack_type, {_SEVERITY} AS severity, proto AS protocol,
               1 AS binary_prediction, round(binary_probability, 9) AS binary_probability,
               round(attack_confidence, 9) AS attack_confidence, CAST(sbytes AS BIGINT) AS sbytes, rate
        FROM ({SCORED_SQL}) s WHERE binary_prediction = 1""",
    ("messages",),
)
def r04_stream_scoring(spark, d):
    rows = alert_table.read_alerts(spark, _scored_table(spark, d))
    return rows.select(
        "session_id", F.col("alert_time").cast("timestamp_ntz").alias("alert_time"), "alert_id", "attack_type", "severity",
        "protocol", "binary_prediction", F.round("binary_probability", 9).alias("binary_probability"),
        F.round("attack_confidence", 9).alias("attack_confidence"), "sbytes", "rate",
    )


@query(
    f"""SELECT (SELECT count(*) FROM messages WHERE {_BROKEN_SQL} OR CAST(record_id AS BIGINT) % 50 = 1) AS quarantined, count(*) AS alerts
        FROM ({SCORED_SQL}) s WHERE binary_prediction = 1 AND NOT ({_BROKEN_SQL}) AND CAST(record_id AS BIGINT) % 50 <> 1""",
    ("messages",),
)
def r05_quarantine(spark, d):
    # One message in fifty is broken text, one has no key, time or session: both are set aside.
    rows = bindings.messages(spark, d)
    path, folder = work_path(spark, "scored"), work_path(spark, "messages")
    keyless = F.col("record_id").cast("bigint") % 50 == 1
    empty = F.when(F.col("record_id").cast("bigint") % 100 == 1, "{}").otherwise('{"unrelated": 1}')
    value = F.when(_broken(), F.lit(_BROKEN)).when(keyless, empty).otherwise(F.to_json(F.struct(*rows.columns), messages.JSON_TIMES))
    _publish(rows.select(value.alias("value"), "event_time"), "event_time", folder, _cuts(rows, "event_time"))
    alert_table.create_tables(spark, path)
    job = jobs.scoring_batch(rows.schema, _rules, path)
    stream = message_stream(spark, folder, fmt="text", cap=FILES)
    jobs.run_to_end(jobs.start(stream, job, work_path(spark, "scored-offsets"), trigger=None))
    aside = spark.read.text(f"{path}/quarantine").groupBy().agg(F.count(F.lit(1)).alias("quarantined"))
    alerts = alert_table.read_alerts(spark, path).count()
    return aside.withColumn("alerts", F.lit(alerts).cast("bigint"))


@query(
    f"""SELECT {_slice_sql('event_time')} AS batch, count(*) AS rows, CAST(sum(binary_prediction) AS BIGINT) AS attacks, true AS timed
        FROM ({SCORED_SQL}) s GROUP BY 1""",
    ("messages",),
)
def r07_batch_metrics(spark, d):
    path = _scored_table(spark, d)
    found = spark.read.parquet(f"{path}/metrics")
    return found.select(F.col("commit").cast("bigint").alias("batch"), "rows", "attacks", (F.col("write_seconds") > 0).alias("timed"))


@query(
    """SELECT session_id, bucket, alerts FROM (
         SELECT session_id, date_trunc('hour', alert_time) AS bucket, count(*) AS alerts FROM alerts, (
             SELECT min(ts) + to_microseconds((epoch_us(max(ts)) - epoch_us(min(ts))) // 2) AS middle FROM events) e
         WHERE alert_time >= middle GROUP BY 1, 2) w, (SELECT max(ts) AS last FROM events) e
       WHERE bucket + INTERVAL 1 HOUR <= last - INTERVAL 30 SECOND""",
    ("alerts",),
)
def r08_late_rows_dropped(spark, d):
    # The later half of the table arrives first, in two slices; the earlier half is then behind the
    # watermark. (A batch is checked against the watermark its predecessor ran with.)
    rows = _alert_rows(spark, d)
    first, last = rows.agg(F.min("alert_time"), F.max("alert_time")).first()
    middle = first + (last - first) // 2
    text = rows.select(F.to_json(F.struct("*"), messages.JSON_TIMES).alias("value"), "alert_time")
    early, path = text.where(F.col("alert_time") < F.lit(middle)), work_path(spark, "late")
    later, between = text.where(F.col("alert_time") >= F.lit(middle)), [middle + (last - middle) / 2]
    _publish(later, "alert_time", path, between)
    _publish(early, "alert_time", path, [])
    out = _to_parquet(spark, jobs.timeline(_alert_stream(spark, path), 60), "late-timeline")
    counts = spark.read.parquet(out).select("session_id", "bucket", "alerts")
    return counts.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("SELECT session_id, severity, attack_type, count(*) AS alerts FROM alerts GROUP BY ALL", ("alerts",))
def r09_running_stats(spark, d):
    folder = _replay(spark, _alert_rows(spark, d), "alert_time")
    return jobs.read_folded_stats(spark, _to_parquet(spark, _alert_stream(spark, folder), "stats", on_batch=jobs.folded_stats))


@query(
    """SELECT session_id, severity, attack_type, count(*) AS alerts, CAST(4 AS BIGINT) AS bases FROM alerts, range(2) writers
       GROUP BY session_id, severity, attack_type""",
    ("alerts",),
)
def r09_folded_after_replays(spark, d):
    """Two writers fold the same alerts; each of them runs its last batch once more, as after a failure. Two bases a writer are left."""
    out, folder = work_path(spark, "stats"), _replay(spark, _alert_rows(spark, d), "alert_time")
    for writer in ("a", "b"):
        fold, batches = jobs.folded_stats(out, writer), []

        def twice(batch, batch_id):
            for _ in range(1 + (batch_id == SLICES - 1)):
                fold(batch, batch_id)
            batches.append(batch_id)

        jobs.run_to_end(jobs.start(_alert_stream(spark, folder), twice, work_path(spark, "stats-offsets"), trigger=None))
    bases = sum(len(stored_commits(spark, f"{out}/writer={w}")) for w in ("a", "b"))
    return jobs.read_folded_stats(spark, out).withColumn("bases", F.lit(bases).cast("bigint"))


@query(
    """SELECT session_id, bucket, alerts FROM (
         SELECT session_id, date_trunc('hour', alert_time) AS bucket, count(*) AS alerts FROM alerts GROUP BY 1, 2) w
       WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 30 SECOND""",
    ("alerts",),
)
def r10_stream_timeline(spark, d):
    folder = _replay(spark, _alert_rows(spark, d), "alert_time")
    out = spark.read.parquet(_to_parquet(spark, jobs.timeline(_alert_stream(spark, folder), 60), "timeline"))
    return out.select("session_id", F.col("bucket").cast("timestamp_ntz").alias("bucket"), "alerts")


@query("SELECT alert_id, session_id, attack_type FROM alerts WHERE severity = 'high'", ("alerts",))
def r11_notifications(spark, d):
    folder = _replay(spark, _alert_rows(spark, d), "alert_time")
    out = work_path(spark, "notifications")
    stream = jobs.notifications(_alert_stream(spark, folder))
    sent = (
        stream.writeStream.format("text")
        .option("checkpointLocation", work_path(spark, "notifications-offsets"))
        .trigger(availableNow=True)
        .start(out)
    )
    jobs.run_to_end(sent)
    back = messages.good_rows(messages.parse_messages(spark.read.text(out), _ALERT_ROW), _ALERT_ROW)
    return back.select("alert_id", "session_id", "attack_type")


@query(
    "SELECT alert_id, alert_time FROM alerts WHERE alert_time >= (SELECT max(alert_time) FROM alerts) - INTERVAL 1 HOUR",
    ("alerts",),
)
def r12_expiry(spark, d):
    rows = bindings.alerts(spark, d).select("alert_id", "alert_time")
    return jobs.unexpired(rows, analytics.newest_time(rows), hours=1)


#: Entries that the cache of one key holds at most, and its lifetime.
CACHE_ENTRIES, CACHE_SECONDS = 20, 3600


@query(
    f"""WITH steps AS (
          SELECT session_id, attack_type, alert_time,
                 coalesce(alert_time - lag(alert_time) OVER w >= to_seconds({CACHE_SECONDS}), true) AS opens
          FROM alerts WINDOW w AS (PARTITION BY session_id, attack_type ORDER BY alert_time)),
        runs AS (
          SELECT session_id, attack_type, alert_time,
                 count(*) FILTER (WHERE opens) OVER (PARTITION BY session_id, attack_type ORDER BY alert_time RANGE UNBOUNDED PRECEDING) AS run FROM steps),
        held AS (
          SELECT session_id, attack_type, run, max(alert_time) + to_seconds({CACHE_SECONDS}) AS evicted_at,
                 least(count(*), {CACHE_ENTRIES}) AS entries,
                 run < max(run) OVER (PARTITION BY session_id, attack_type) AS followed
          FROM runs GROUP BY session_id, attack_type, run)
        SELECT session_id, attack_type, evicted_at, entries FROM held
        WHERE followed OR (epoch_us(evicted_at) + 999) // 1000 <= (SELECT epoch_us(max(alert_time)) // 1000 FROM alerts) - 30000""",
    ("alerts",),
)
def r12_cache_expiry_in_stream(spark, d):
    # The stream's state holds what a cache with a lifetime of an hour holds, and gives a row when a key goes.
    folder = _replay(spark, _alert_rows(spark, d), "alert_time")
    with keyed_state(spark):
        gone = evictions(_alert_stream(spark, folder), ["session_id", "attack_type"], CACHE_SECONDS, "30 seconds", CACHE_ENTRIES)
        out = spark.read.parquet(_to_parquet(spark, gone, "evicted"))
    return out.select("session_id", "attack_type", F.col("evicted_at").cast("timestamp_ntz").alias("evicted_at"), "entries")


@query(f"SELECT {', '.join(_ALERT_ROW.names)} FROM alerts", ("alerts",))
def r13_exactly_once(spark, d):
    # Every alert is sent twice and some many times more, over two streams. The table has each once.
    rows = _alert_rows(spark, d)
    copies = F.sequence(F.lit(1), F.when(F.col("severity") == "info", 5).otherwise(2))
    folder = _replay(spark, rows.withColumn("_copy", F.explode(copies)).drop("_copy"), "alert_time")
    path = work_path(spark, "once")
    alert_table.create_tables(spark, path)
    for _ in range(2):
        offsets = work_path(spark, "once-offsets")
        store = jobs.alert_writer(path, alert_table.writer_of(offsets))
        jobs.run_to_end(jobs.start(_alert_stream(spark, folder), store, offsets, trigger=None))
    out = alert_table.read_alerts(spark, path).select(*_ALERT_ROW.names)
    return out.withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


@query(f"SELECT {', '.join(_ALERT_ROW.names)} FROM alerts", ("alerts",))
def r13_once_per_key_in_stream(spark, d):
    # Every alert is sent twice, in whatever files, and one type many times: the first of each comes out at once, the newest ones too.
    rows = _alert_rows(spark, d)
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("attack_type") == "DoS", 9).otherwise(2)))
    folder = _replay(spark, rows.withColumn("_copy", copies).drop("_copy"), "alert_time")
    once = jobs.first_per_key(_alert_stream(spark, folder), ["session_id", "alert_time", "alert_id"])
    out = spark.read.parquet(_to_parquet(spark, once, "once")).select(*_ALERT_ROW.names)
    return out.withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


# --- options, restarts, several writers


@query(f"SELECT CAST({SLICES} AS BIGINT) AS batches, count(*) AS messages FROM messages", ("messages",))
def s03_trigger_cap(spark, d):
    # A trigger takes the files of one slice, so there are as many batches as slices.
    folder, _ = _flow_messages(spark, d)
    out = spark.read.parquet(_to_parquet(spark, message_stream(spark, folder, fmt="text", cap=FILES), "capped"))
    return out.agg(F.countDistinct("commit").alias("batches"), F.count(F.lit(1)).alias("messages"))


@query("SELECT count(*) AS oldest_first FROM messages WHERE event_time < (SELECT min(ts) + to_microseconds((epoch_us(max(ts)) - epoch_us(min(ts))) // 4) FROM events)", ("messages",))
def s02_starting_order(spark, d):
    # Files are taken oldest first: the first batch holds the first slice and nothing else.
    folder, schema = _flow_messages(spark, d)
    out = spark.read.parquet(_to_parquet(spark, message_stream(spark, folder, fmt="text", cap=FILES), "ordered"))
    return out.where("commit = 0").agg(F.count(F.lit(1)).alias("oldest_first"))


@query(
    f"""SELECT record_id, CASE WHEN {_slice_sql('event_time')} < 2 THEN 'earliest' WHEN {_slice_sql('event_time')} = 2 THEN 'latest' ELSE 'restart' END AS came
        FROM messages WHERE {_slice_sql('event_time')} >= 2 OR CAST(record_id AS BIGINT) % 2 = 0""",
    ("messages",),
)
def s02_start_positions(spark, d):
    """A stream that starts at the latest file leaves out the files before, and after a restart takes those that came meanwhile.

    The first two slices are there before it starts; another stream, which starts at the earliest file, tells them (rows with even ids).
    """
    rows = bindings.messages(spark, d)
    folder, out, offsets = (work_path(spark, n) for n in ("positions-in", "positions-out", "positions-offsets"))
    value = F.to_json(F.struct(*rows.columns), messages.JSON_TIMES).alias("value")
    text, cuts = rows.select(value, "event_time"), _cuts(rows, "event_time")
    begins, ends = [F.lit(True), *(F.col("event_time") >= F.lit(c) for c in cuts)], [*(F.col("event_time") < F.lit(c) for c in cuts), F.lit(True)]
    for i in range(2):
        messages.publish(text.where(begins[i] & ends[i]).select("value").repartition(FILES), "text", folder)
    early = _to_parquet(spark, message_stream(spark, folder, fmt="text", starting="earliest", cap=0), "positions-early")
    for i in range(2, SLICES):
        stream = message_stream(spark, folder, fmt="text", starting="latest", cap=0, checkpoint=offsets)
        if i == 2:  # there is nothing new yet
            jobs.run_to_end(jobs.start(stream, jobs.batch_writer(out), offsets, trigger=None, skip_empty=True))
        messages.publish(text.where(begins[i] & ends[i]).select("value").repartition(FILES), "text", folder)
        jobs.run_to_end(jobs.start(stream, jobs.batch_writer(out), offsets, trigger=None, skip_empty=True))
    record = F.get_json_object("value", "$.record_id").alias("record_id")
    late = spark.read.parquet(out)
    first = late.agg(F.min("commit")).first()[0]
    late = late.select(record, F.when(F.col("commit") == first, "latest").otherwise("restart").alias("came"))
    early = spark.read.parquet(early).select(record, F.lit("earliest").alias("came")).where(F.col("record_id").cast("bigint") % 2 == 0)
    return early.unionAll(late)


@query(f"SELECT {', '.join(_ALERT_ROW.names)} FROM alerts", ("alerts",))
def r03_checkpointed_restart(spark, d):
    # The same query runs, stops and runs again after more files have come: each file is taken once, batches are appended.
    rows = _alert_rows(spark, d)
    text = rows.select(F.to_json(F.struct("*"), messages.JSON_TIMES).alias("value"), "alert_time")
    folder, out, offsets = (work_path(spark, n) for n in ("restart-in", "restart-out", "restart-offsets"))
    middle = _cuts(rows, "alert_time", 2)[0]
    for part in (F.col("alert_time") < F.lit(middle), F.col("alert_time") >= F.lit(middle)):
        _publish(text.where(part), "alert_time", folder, [])
        jobs.run_to_end(jobs.start(_alert_stream(spark, folder), jobs.batch_writer(out), offsets, trigger=None))
    return spark.read.parquet(out).select(*_ALERT_ROW.names).withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))


@query("SELECT count(*) AS rows, CAST(1 AS BIGINT) AS batches, true AS stopped FROM alerts WHERE severity = 'high'", ("alerts",))
def r06_timed_trigger_and_stop(spark, d):
    """A query on a timer writes the one batch there is, skips empty ones and stops when told to."""
    out, folder = work_path(spark, "timed"), _replay(spark, _alert_rows(spark, d), "alert_time")
    stream = _alert_stream(spark, folder, cap=0).where(F.col("severity") == "high")
    running = jobs.start(stream, jobs.batch_writer(out), work_path(spark, "timed-offsets"), trigger="1 second")
    running.processAllAvailable()
    jobs.run_to_end(running, timeout=1)
    found = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("commit").alias("batches"))
    return found.withColumn("stopped", F.lit(not running.isActive))


@query("SELECT CAST(0 AS BIGINT) AS batches, count(*) AS messages FROM messages", ("messages",))
def f08_empty_batches(spark, d):
    # No message passes the filter, so no batch reaches the writer.
    folder, _ = _flow_messages(spark, d)
    seen = []
    stream = message_stream(spark, folder, fmt="text", cap=FILES).where("value = 'none such'")
    jobs.run_to_end(jobs.start(stream, lambda batch, i: seen.append(i), work_path(spark, "empty-offsets"), trigger=None))
    return spark.read.text(folder).agg(F.lit(len(seen)).cast("bigint").alias("batches"), F.count(F.lit(1)).alias("messages"))


_SCORED_ALERTS = f"SELECT session_id, record_id AS alert_id, attack_type FROM ({SCORED_SQL}) s WHERE binary_prediction = 1"


def _alert_keys(rows):
    return rows.select("session_id", "alert_id", "attack_type")


@query(_SCORED_ALERTS, ("messages",))
def r04_two_streams(spark, d):
    # Both streams count their batches from 0 and write the same alerts: all of them are there, once.
    return _alert_keys(alert_table.read_alerts(spark, _scored_table(spark, d, streams=2)))


@query(f"{_SCORED_ALERTS} UNION ALL SELECT 'session-x', alert_id, attack_type FROM alerts WHERE severity = 'high'", ("messages", "alerts"))
def k02_write_after_compact(spark, d):
    # A stream writes batches, the table is compacted, another stream and an ingest write under the same numbers.
    path, small = _scored_table(spark, d), work_path(spark, "small")
    alert_table.compact(spark, path, small)
    folder, schema = _flow_messages(spark, d)
    offsets = work_path(spark, "after-compact")
    job = jobs.scoring_batch(schema, _rules, small, alert_table.writer_of(offsets))
    jobs.run_to_end(jobs.start(message_stream(spark, folder, fmt="text", cap=FILES), job, offsets, trigger=None))
    high = bindings.alerts(spark, d).where(F.col("severity") == "high")
    for commit in (0, 1, 1):
        alert_table.store_alerts(high, small, commit, "session-x", writer="ingest")
    return _alert_keys(alert_table.read_alerts(spark, small))


@query(f"{_SCORED_ALERTS}", ("messages",))
def x04_stream_after_delete(spark, d):
    # The session is deleted under a high number; what a stream writes later, from batch 0 on, counts again.
    path = _scored_table(spark, d)
    alert_table.delete_session(spark, path, "session-3", 100)
    folder, schema = _flow_messages(spark, d)
    offsets = work_path(spark, "after-delete")
    job = jobs.scoring_batch(schema, _rules, path, alert_table.writer_of(offsets))
    jobs.run_to_end(jobs.start(message_stream(spark, folder, fmt="text", cap=FILES), job, offsets, trigger=None))
    return _alert_keys(alert_table.read_alerts(spark, path))


@query("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS bad, true AS same_alerts, true AS known_types FROM messages", ("messages",))
def r15_fitted_models_on_a_stream(spark, d):
    # The fitted forests score the messages in micro-batches; alerts and counts agree with scoring them as a table.
    from flowwarden.queries import models

    binary, category = models._model(spark, d, "forest"), models._model(spark, d, "category")
    scorer = lambda flows: score.cascade(flows, binary, category, bindings.FLOW_FEATURES)
    path = _scored_table(spark, d, scorer=scorer)
    counts = spark.read.parquet(f"{path}/metrics").agg(F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), F.sum("attacks").alias("attacks"))
    stored = alert_table.read_alerts(spark, path)
    batch = scorer(bindings.messages(spark, d)).count()
    known = stored.where(~F.col("attack_type").isin(*ATTACK_TYPES.values())).isEmpty()
    return counts.select(
        "rows", "bad", ((F.col("attacks") == batch) & F.lit(stored.count() == batch)).alias("same_alerts"), F.lit(known).alias("known_types")
    )
