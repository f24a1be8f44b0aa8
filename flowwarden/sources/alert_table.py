"""The alert and session tables as append-only Parquet.

Every write is a folder named after its writer and the writer's own number for it (a stream's batch, an
ingest's id), so writers never meet, and a write that is repeated replaces its own folder. Rows carry
an order that all writers share: the time of the write and the place within it. Reads show the
last row per key without rows that are older than a delete of their session.
Session reads and old months skip whole folders; rows are sorted by time within files, so a cutoff
inside a month skips row groups. Days would make many tiny files for quiet sessions.

    <path>/alerts/writer=W/commit=N/session_id=S/alert_month=YYYY-MM/
    <path>/alerts/writer=W~N/commit=N/...   the writer's commits up to N, merged (see ``merge_commits``)
    <path>/sessions/writer=W/commit=N/
    <path>/deleted/writer=W/commit=N/

Reads for the newest rows look at folder names first and open the newest months only.

Clocks of different drivers order their writes; a delete and a write closer together than these clocks
agree may be taken in either order.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.functions.scalars import record_key, safe_float, safe_int
from flowwarden.operators.joins import bounded_not_in
from flowwarden.operators.ranking import last_by_order, last_write, latest, newest_first, top_n_per_key
from flowwarden.plans.score import enrich_alerts
from flowwarden.schemas import ALERT_KEY, ALERT_SCHEMA, RECENT_CAP, SESSION_SCHEMA
from flowwarden.session import materialise
from flowwarden.sources.folders import folders, remove_folder, rename_folder, stored_commits

MAIN = "main"
_ORDER = T.StructField("written", T.DecimalType(38, 0))
_FOLDERS = [T.StructField("writer", T.StringType()), T.StructField("commit", T.LongType())]
_ALERT_FILES = T.StructType([*ALERT_SCHEMA.fields, T.StructField("alert_month", T.StringType()), _ORDER, *_FOLDERS])
_SESSION_FILES = T.StructType([*SESSION_SCHEMA.fields, _ORDER, *_FOLDERS])
_DELETED_FILES = T.StructType([T.StructField("session_id", T.StringType()), _ORDER, *_FOLDERS])
#: Places within a write fit below the nanoseconds of its time.
_PLACES = 10**19
_last_time = 0


def create_tables(spark: SparkSession, path: str) -> None:
    """Empty tables where none exist."""
    for name, schema in (("alerts", _ALERT_FILES), ("sessions", _SESSION_FILES), ("deleted", _DELETED_FILES)):
        spark.createDataFrame([], schema).write.mode("append").partitionBy("writer", "commit").parquet(f"{path}/{name}")


def writer_of(checkpoint: str) -> str:
    """The writer's name of a stream: restarts share it, a new checkpoint or another stream does not."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def _now() -> int:
    """Nanoseconds, later than any this process has used before."""
    global _last_time
    _last_time = max(time.time_ns(), _last_time + 1)
    return _last_time


def _written() -> Column:
    """The order of the rows of one write: no two rows of the table share it."""
    start = F.lit(Decimal(_now() * _PLACES)).cast("decimal(38,0)")
    return (start + F.monotonically_increasing_id().cast("decimal(19,0)")).cast("decimal(38,0)").alias("written")


def _folder(path: str, table: str, writer: str, commit: int) -> str:
    return f"{path}/{table}/writer={writer}/commit={commit}"


def coerce_alerts(alerts: DataFrame) -> DataFrame:
    """Exactly the alert columns: text defaults to '', numbers to 0."""
    present = set(alerts.columns)

    def coerced(field: T.StructField) -> Column:
        col = F.col(field.name) if field.name in present else F.lit(None).cast("string")
        if field.name in ALERT_KEY:
            return col.cast(field.dataType).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(col.cast("string"), F.lit("")).alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return safe_float(col).alias(field.name)
        return safe_int(col, 0, field.dataType.simpleString()).alias(field.name)

    return alerts.select([coerced(f) for f in ALERT_SCHEMA.fields])


def store_alerts(
    alerts: DataFrame, path: str, commit: int, session_id: str | None = None, writer: str = MAIN
) -> None:
    """Write alert rows as one commit of a writer, enriched and coerced.

    Copies of a key are left to the read, which combines them anyway; so a write needs one shuffle.
    """
    session = F.lit(session_id) if session_id is not None else None
    write_alerts(coerce_alerts(enrich_alerts(alerts, session)), path, commit, writer)


def store_alert(
    spark: SparkSession, alert: dict, path: str, commit: int, session_id: str, writer: str = MAIN
) -> None:
    """Write a single alert given as a dictionary; fields it lacks get their defaults."""
    given = {k: v for k, v in alert.items() if v is not None}
    row = spark.createDataFrame([tuple(given.values())], list(given)) if given else spark.range(1).select()
    store_alerts(row, path, commit, session_id, writer)


def write_alerts(rows: DataFrame, path: str, commit: int, writer: str = MAIN) -> None:
    """Write complete alert rows; ``rebalance`` lets AQE split the files of a hot session and
    merge small ones."""
    (
        rows.withColumn("alert_month", F.date_format("alert_time", "yyyy-MM"))
        .hint("rebalance", F.col("session_id"), F.col("alert_month"))
        .sortWithinPartitions("session_id", "alert_month", "alert_time")
        .select("*", _written())
        .write.mode("overwrite")
        .partitionBy("session_id", "alert_month")
        .parquet(_folder(path, "alerts", writer, commit))
    )


def read_alerts(
    spark: SparkSession,
    path: str,
    session_id: str | None = None,
    since: dt.datetime | None = None,
    without: tuple[str, int] | None = None,
) -> DataFrame:
    """Live alerts: last write per key, deleted sessions left out.

    ``session_id`` and the month of ``since`` select folders; the time itself selects row groups.
    ``without`` leaves out one commit of one writer.
    """
    live = _live(spark, path, _stored_alerts(spark, path, session_id, since, without))
    return last_by_order(live, ALERT_KEY, "written").select(*ALERT_SCHEMA.names)


def _stored_alerts(spark, path, session_id=None, since=None, without=None, months=None) -> DataFrame:
    reader = spark.read.schema(_ALERT_FILES)
    if months is None:
        stored = reader.parquet(f"{path}/alerts")
    else:
        stored = reader.option("basePath", f"{path}/alerts").parquet(*[f for m in months for f in _month_folders(spark, path, session_id, m)])
    # What has been merged counts from the merged folder only.
    for writer, upto in _merged(spark, path):
        stored = stored.where((F.col("writer") != writer) | (F.col("commit") > upto))
    if session_id is not None:
        stored = stored.where(F.col("session_id") == session_id)
    if since is not None:
        start = F.lit(since).cast("timestamp")
        stored = stored.where(
            (F.col("alert_month") >= F.date_format(start, "yyyy-MM")) & (F.col("alert_time") >= start)
        )
    if without is not None:
        stored = stored.where((F.col("writer") != without[0]) | (F.col("commit") != without[1]))
    return stored


def _month_folders(spark: SparkSession, path: str, session_id: str | None, month: str = "*") -> list[str]:
    """Folders of a session (all without one) and month: names alone, as the file system lists them."""
    session = "*" if session_id is None else spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(session_id)
    return folders(spark, f"{path}/alerts/writer=*/commit=*/session_id={session}/alert_month={month}")


def _merged(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(writer, last commit) that a merged folder stands for; a merged folder that a later one took up stands for nothing itself."""
    newest: dict[str, int] = {}
    stale = []
    for name in folders(spark, f"{path}/alerts/writer=*~*"):
        writer, _, upto = name.rsplit("writer=", 1)[1].rpartition("~")
        if writer in newest:
            stale.append((f"{writer}~{min(newest[writer], int(upto))}", 1 << 62))
        newest[writer] = max(newest.get(writer, 0), int(upto))
    return [*newest.items(), *stale]


def latest_alerts(
    spark: SparkSession, path: str, session_id: str | None = None, n: int = 100, since: dt.datetime | None = None
) -> DataFrame:
    """The newest ``n`` live alerts, as ``latest(read_alerts(...), n)`` but from the newest months alone.

    The time is part of the key, so copies of a key are in one month and stand together in the order. Months are taken newest first, twice as many
    in each round, until ``n`` live keys are found; the keys come from key columns alone, and their rows, a literal number
    of keys, are then picked from these months.
    """
    months = sorted({f.rsplit("alert_month=", 1)[1] for f in _month_folders(spark, path, session_id)}, reverse=True)
    if since is not None:
        months = [m for m in months if m >= f"{since:%Y-%m}"]
    width, live, found = 1, None, []
    while months:
        live = _live(spark, path, _stored_alerts(spark, path, session_id, since, months=months[:width]))
        keys = live.groupBy(*ALERT_KEY).agg(F.max("written").alias("_last"))
        found = latest(keys, n).select("_last").collect()  # n of them
        if len(found) >= n or width >= len(months):
            break
        width *= 2
    if not found:
        return _stored_alerts(spark, path).where(F.lit(False)).select(*ALERT_SCHEMA.names)
    newest = F.broadcast(spark.createDataFrame(found, T.StructType([T.StructField("_last", _ORDER.dataType)])))
    rows = live.join(newest, F.col("written") == F.col("_last"), "left_semi")
    return latest(rows.select(*ALERT_SCHEMA.names), n)


def _live(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rows not followed by a delete of their session.

    One row per deleted session is left on the other side; where these are too many to broadcast,
    AQE splits the alerts of a session that fills a task.
    """
    deletes = (
        spark.read.schema(_DELETED_FILES)
        .parquet(f"{path}/deleted")
        .groupBy("session_id")
        .agg(F.max("written").alias("_deleted"))
    )
    kept = rows.join(deletes, "session_id", "left")
    return kept.where(F.col("_deleted").isNull() | (F.col("written") > F.col("_deleted"))).drop("_deleted")


def recent_alerts(spark: SparkSession, path: str, cap: int = RECENT_CAP) -> DataFrame:
    """The newest ``cap`` alerts of every session.

    Key columns tell the time of each session's last alert to keep, one row per session; wide rows older than that are dropped where they are read.
    """
    live = _live(spark, path, _stored_alerts(spark, path))
    keys = live.select(*ALERT_KEY).distinct()
    kept = top_n_per_key(keys, ["session_id"], newest_first(), cap)
    cutoffs = kept.groupBy(F.col("session_id").alias("_session")).agg(F.min("alert_time").alias("_cutoff"))
    cutoffs = materialise(cutoffs, "cutoffs")
    near = live.join(cutoffs, (F.col("session_id") == F.col("_session")) & (F.col("alert_time") >= F.col("_cutoff")), "left_semi")
    return top_n_per_key(last_by_order(near, ALERT_KEY, "written").select(*ALERT_SCHEMA.names), ["session_id"], newest_first(), cap)


def new_session_id() -> str:
    """``session-`` and ten random hex digits."""
    return f"session-{uuid.uuid4().hex[:10]}"


def under_new_sessions(alerts: DataFrame) -> DataFrame:
    """``alerts`` with ``new_session_id``: a fresh id for every session, made by the executors and kept, so that all its rows get the same."""
    fresh = F.concat(F.lit("session-"), F.substring(F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")), 1, 10)).alias("new_session_id")
    named = materialise(alerts.select(F.col("session_id").alias("_old")).distinct().select("_old", fresh), "new-sessions")
    return alerts.join(named, F.col("session_id").eqNullSafe(F.col("_old")), "left").drop("_old")


def store_sessions(sessions: DataFrame, path: str, commit: int, writer: str = MAIN) -> None:
    """Register sessions: a later registration replaces dataset and creation time."""
    rows = sessions.select(
        "session_id",
        "dataset",
        F.coalesce(F.col("created_at"), F.current_timestamp()).cast("timestamp").alias("created_at"),
    )
    rows = last_write(rows.where(F.col("session_id").isNotNull()), ["session_id"], ["created_at"])
    _write_sessions(rows, path, commit, writer)


def _write_sessions(rows: DataFrame, path: str, commit: int, writer: str) -> None:
    rows.select("*", _written()).write.mode("overwrite").parquet(_folder(path, "sessions", writer, commit))


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(_SESSION_FILES).parquet(f"{path}/sessions")
    return last_by_order(_live(spark, path, stored), ["session_id"], "written").select(*SESSION_SCHEMA.names)


def count_alerts(spark: SparkSession, path: str, session_id: str | None = None) -> DataFrame:
    """Live alerts per session, from the key columns alone."""
    live = _live(spark, path, _stored_alerts(spark, path, session_id))
    return live.select(*ALERT_KEY).distinct().groupBy("session_id").agg(F.count(F.lit(1)).alias("alerts"))


def delete_session(spark: SparkSession, path: str, session_id: str, commit: int, writer: str = MAIN) -> DataFrame:
    """Delete one session and its alerts; one row with what was removed."""
    alerts = count_alerts(spark, path, session_id).agg(F.coalesce(F.sum("alerts"), F.lit(0))).first()[0]
    known = not read_sessions(spark, path).where(F.col("session_id") == session_id).isEmpty()
    gone = spark.createDataFrame([(session_id,)], "session_id string")
    gone.select("*", _written()).write.mode("overwrite").parquet(_folder(path, "deleted", writer, commit))
    return spark.createDataFrame(
        [(session_id, alerts, known)], "session_id string, removed_alerts bigint, session_removed boolean"
    )


def delete_all(spark: SparkSession, path: str, commit: int, writer: str = MAIN) -> DataFrame:
    """Delete every session and alert; one row with the counts."""
    alerts, sessions = count_alerts(spark, path), read_sessions(spark, path)
    removed = alerts.agg(F.coalesce(F.sum("alerts"), F.lit(0))).first()[0]
    counts = spark.createDataFrame(
        [(sessions.count(), removed)], "removed_sessions bigint, removed_alerts bigint"
    )
    gone = alerts.select("session_id").union(sessions.select("session_id")).distinct()
    gone.select("*", _written()).write.mode("overwrite").parquet(_folder(path, "deleted", writer, commit))
    return counts


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the live rows as one commit of a new table, under a writer of its own; the old one
    stays readable meanwhile, and later writes of any writer add to the new one."""
    create_tables(spark, target)
    writer = f"compact-{uuid.uuid4().hex[:12]}"
    write_alerts(read_alerts(spark, path), target, 1, writer)
    _write_sessions(read_sessions(spark, path), target, 1, writer)


def merge_commits(spark: SparkSession, path: str, writer: str = MAIN, upto: int | None = None) -> int | None:
    """Replace the alert commits of a writer up to ``upto`` (all but the newest, if not given) by one folder; returns the last commit in it.

    A writer's many small folders become one folder per session and month. Rows keep their order, so what reads give does not change. The merged
    folder is written aside and takes effect by one renaming; the old folders go afterwards. A merge that breaks off before that has changed
    nothing, and one that breaks off later is tidied up by the next. Reads that were planned before a merge have to be planned again. A batch that its
    stream runs again is in the merged folder already.
    """
    commits = stored_commits(spark, f"{path}/alerts/writer={writer}")
    done = max((n for w, n in _merged(spark, path) if w == writer), default=None)
    upto = upto if upto is not None else (commits[-2] if len(commits) > 1 else None)
    fresh = [c for c in commits if upto is not None and c <= upto and (done is None or c > done)]
    if fresh:
        merged = f"{writer}~{fresh[-1]}"
        stored = _stored_alerts(spark, path)
        own = (F.col("writer") == writer) & (F.col("commit") <= fresh[-1])
        if done is not None:
            own |= F.col("writer") == f"{writer}~{done}"
        aside = f"{path}/merging/{merged}"
        (
            stored.where(own).select(*ALERT_SCHEMA.names, "alert_month", "written")
            .hint("rebalance", F.col("session_id"), F.col("alert_month"))
            .sortWithinPartitions("session_id", "alert_month", "alert_time")
            .write.mode("overwrite").partitionBy("session_id", "alert_month").parquet(f"{aside}/commit={fresh[-1]}")
        )
        rename_folder(spark, aside, f"{path}/alerts/writer={merged}")
        done = fresh[-1]
    if done is not None:
        for commit in commits:
            if commit <= done:
                remove_folder(spark, f"{path}/alerts/writer={writer}/commit={commit}")
        for name in folders(spark, f"{path}/alerts/writer={writer}~*"):
            if not name.endswith(f"~{done}"):
                remove_folder(spark, name)
    return done


def ingest(
    payloads: DataFrame, path: str, commit: int, default_session: str, default_dataset: str = "flows", writer: str = MAIN
) -> None:
    """Store the alerts and sessions of externally computed payloads.

    A payload holds ``session_id``, ``alerts`` (array of structs) and ``sessions``. Its session
    overrides the one in the alert; ids and times of the alerts are kept. An alert without an id (null
    or '') gets one from where it stands: file, place of the payload, place in the payload. So equal
    alerts stay separate, and reading the same files again gives the same ids.
    """
    session = F.coalesce("session_id", F.lit(default_session)).alias("_session")
    placed = payloads.select(
        session, "alerts",
        F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_payload"),
    )
    alerts = placed.select("_session", "_file", "_payload", F.posexplode("alerts").alias("_place", "alert"))
    source = record_key(F.col("_file"), F.col("_payload"), F.col("_place"))
    alerts = alerts.select(F.col("_session"), source.alias("record_id"), "alert.*").drop("session_id")
    store_alerts(alerts.withColumnRenamed("_session", "session_id"), path, commit, writer=writer)
    sessions = payloads.select(F.explode("sessions").alias("s")).select(
        F.nullif("s.session_id", F.lit("")).alias("session_id"),
        F.coalesce("s.dataset", F.lit(default_dataset)).alias("dataset"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    store_sessions(sessions, path, commit, writer)


def replicate(
    spark: SparkSession, source: str, target: str, session_id: str, commit: int, n: int = 500, writer: str = "replica"
) -> None:
    """Copy the newest ``n`` alerts of a session that the target lacks, and all sessions.

    What the same commit holds already does not count as there, so a repeated run writes it again.
    """
    newest = latest_alerts(spark, source, session_id, n)
    there = read_alerts(spark, target, session_id, without=(writer, commit))
    write_alerts(bounded_not_in(newest, there, ALERT_KEY), target, commit, writer)
    _write_sessions(read_sessions(spark, source), target, commit, writer)
