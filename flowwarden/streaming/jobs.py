"""Streaming jobs: scoring into the alert table, running counts, timelines, notifications."""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowwarden.operators.analytics import since
from flowwarden.plans.score import to_alerts
from flowwarden.schemas import ALERT_SCHEMA
from flowwarden.sources.alert_table import MAIN, store_alerts
from flowwarden.sources.folders import folders, remove_folder, stored_commits
from flowwarden.sources.messages import bad_rows, good_rows, parse_messages
from flowwarden.streaming.sources import DEFAULT_DELAY, DEFAULT_TRIGGER, trigger_options


STATS_KEY = ("session_id", "severity", "attack_type")


def start(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    mode: str = "append",
    skip_empty: bool = True,
) -> StreamingQuery:
    """A query that hands each micro-batch to ``on_batch`` and keeps its own offsets.

    An error stops the query before the offsets are committed, so the batch is run again on
    restart instead of being lost. Empty batches are skipped; turn that off for a stateful
    stream, where looking into the batch would run its aggregation twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not (skip_empty and batch.isEmpty()):
            on_batch(batch, batch_id)

    return (
        stream.writeStream.foreachBatch(handle)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(trigger))
        .start()
    )


def run_to_end(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a query and stop it whatever happens."""
    try:
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
    finally:
        query.stop()


def _counts():
    return F.count_if(~F.col("bad")).alias("rows"), F.count_if("bad").alias("bad")


def _observed(seen: Observation, parsed: DataFrame) -> dict:
    """The counts of a batch. Where no row becomes an alert, adaptive execution may drop the plan with its counts; the rows are then counted by themselves."""
    try:
        return seen.get
    except Py4JJavaError:
        return parsed.agg(*_counts()).first().asDict()


def scoring_batch(
    schema: T.StructType, score: Callable[[DataFrame], DataFrame], path: str, writer: str = MAIN
) -> Callable[[DataFrame, int], None]:
    """Per batch: parse, score, write the attack alerts, put broken messages aside, record counts and the seconds of the write.

    One pass: good and broken messages are counted while the alerts are written (a task that a lost executor makes Spark repeat may count
    twice), the alerts from the footers of their files. Only a batch with broken messages is parsed again, for these. Everything is written by the executors under the writer (see ``writer_of``) and the batch id; a
    batch that is run again replaces its own output and no other. ``score`` returns attack rows with the score columns.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        parsed = parse_messages(batch, schema)
        counted = parsed.observe(seen, *_counts())
        started = time.monotonic()
        store_alerts(to_alerts(score(good_rows(counted, schema))), path, batch_id, writer=writer)
        write_seconds = time.monotonic() - started
        found = _observed(seen, parsed)
        if found["bad"]:
            bad_rows(parsed).write.mode("overwrite").text(f"{path}/quarantine/writer={writer}/commit={batch_id}")
        # A count of written files comes from their footers.
        attacks = spark.read.schema(ALERT_SCHEMA).parquet(f"{path}/alerts/writer={writer}/commit={batch_id}").count()
        counts = {**found, "attacks": attacks}
        row = [F.lit(n).cast("bigint").alias(c) for c, n in counts.items()]
        one = spark.range(0, 1, 1, 1).select(*row, F.lit(write_seconds).alias("write_seconds"))
        one.write.mode("overwrite").parquet(f"{path}/metrics/writer={writer}/commit={batch_id}")

    return on_batch


def running_stats(alerts: DataFrame) -> DataFrame:
    """Counts per session, severity and type; of a stream, counts that grow with it (update mode)."""
    return alerts.groupBy(*STATS_KEY).agg(F.count(F.lit(1)).alias("alerts"))


def folded_stats(path: str, writer: str = MAIN) -> Callable[[DataFrame, int], None]:
    """Counts per session, severity and type that each batch is folded into.

    A batch is counted by itself, without state in the stream; the counts of the base it finds are added and written as the base of this batch. Then
    the bases before its predecessor go, so a writer has two folders at most, of as many rows as there are keys. A batch that is run again
    finds its predecessor's base and replaces its own: nothing is counted twice.
    """
    folder = f"{path}/writer={writer}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bases = stored_commits(spark, folder)
        counts = running_stats(batch)
        if before := [b for b in bases if b < batch_id]:
            counts = counts.unionByName(spark.read.schema(counts.schema).parquet(f"{folder}/commit={max(before)}"))
            counts = counts.groupBy(*STATS_KEY).agg(F.sum("alerts").alias("alerts"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{folder}/commit={batch_id}")
        for old in before[:-1]:
            remove_folder(spark, f"{folder}/commit={old}")

    return on_batch


def read_folded_stats(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all writers, each from its newest base."""
    newest = [f"{w}/commit={max(found)}" for w in folders(spark, f"{path}/writer=*") if (found := stored_commits(spark, w))]
    counts = spark.read.schema("session_id string, severity string, attack_type string, alerts long").parquet(*newest)
    return counts.groupBy(*STATS_KEY).agg(F.sum("alerts").alias("alerts"))


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch under its id: a batch that is run again replaces itself, and of counts
    written in update mode the newest batch holds the truth for its keys. One folder, one stream."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/commit={batch_id}")

    return on_batch


def alert_writer(path: str, writer: str = MAIN) -> Callable[[DataFrame, int], None]:
    """Store each batch of alerts in the alert table; a key that comes again is the same alert, in
    whatever batch or stream it comes."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        store_alerts(batch, path, batch_id, writer=writer)

    return on_batch


def timeline(alerts: DataFrame, interval: int = 60, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Alerts per session and tumbling window; a window is final once the watermark passes it,
    and rows later than that are dropped."""
    return (
        alerts.withWatermark("alert_time", delay)
        .groupBy("session_id", F.window("alert_time", f"{interval} minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select("session_id", F.col("w.start").alias("bucket"), "alerts")
    )


def notifications(alerts: DataFrame, severity: str = "high") -> DataFrame:
    """Alerts of one severity as JSON messages."""
    return alerts.where(F.lower("severity") == severity).select(F.to_json(F.struct("*")).alias("value"))


def first_per_key(alerts: DataFrame, key: list[str], delay: str = DEFAULT_DELAY) -> DataFrame:
    """The first row of every key as soon as it comes. Copies that come within the delay of the key's time are dropped by the stream's state, later
    ones by the watermark; the state of a key goes when the watermark has passed it.

    Tasks drop the copies they hold themselves before the shuffle, by a state of their own, so a key that fills a batch does not fill a task.
    """
    part = alerts.withWatermark("alert_time", delay).withColumn("_part", F.spark_partition_id())
    return part.dropDuplicatesWithinWatermark([*key, "_part"]).drop("_part").dropDuplicatesWithinWatermark(key)


def once_per_key(alerts: DataFrame, key: list[str], delay: str = DEFAULT_DELAY) -> DataFrame:
    """One row per key; the event time must be part of the key.

    An aggregation in append mode: copies are combined before the shuffle, so a key that fills a
    batch does not fill a task, and state is dropped as the watermark passes the key's own time.
    """
    rest = [c for c in alerts.columns if c not in key]
    return (
        alerts.withWatermark("alert_time", delay)
        .groupBy(*key)
        .agg(F.max(F.struct(*rest)).alias("_row"))
        .select(*key, "_row.*")
        .select(*alerts.columns)
    )


def unexpired(alerts: DataFrame, as_of, hours: float = 1) -> DataFrame:
    """Rows not older than ``hours`` at ``as_of``: what a cache with that lifetime still holds."""
    return since(alerts, as_of, hours)
