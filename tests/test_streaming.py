import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from flowwarden.operators.cleanse import clean_features
from flowwarden.plans import score, train
from flowwarden.schemas import MESSAGE_SCHEMA
from flowwarden.session import work_path
from flowwarden.sources import alert_table, messages
from flowwarden.streaming import jobs, sources
from flowwarden.streaming.state import evictions, keyed_state


def rules(flows):
    return score.rule_scores(clean_features(flows, score.RULE_FEATURES))


def lines(spark, count, start=0, extra=()):
    rows = spark.range(start, start + count).select(
        F.col("id").cast("string").alias("record_id"), F.timestamp_seconds(F.col("id")).alias("event_time"),
        F.lit("s1").alias("session_id"), F.lit(400.0).alias("rate"), F.lit("tcp").alias("proto"),
    )
    text = messages.to_messages(rows)
    for line in extra:
        text = text.union(spark.createDataFrame([(line,)], "value string"))
    return text.coalesce(1)


def test_source_options():
    assert sources.source_options("kafka") == {"startingOffsets": "latest", "maxOffsetsPerTrigger": "100"}
    assert sources.source_options("kafka", "earliest", 0) == {"startingOffsets": "earliest"}
    assert sources.source_options("kafka", dt.datetime(2026, 1, 1), 0) == {"startingTimestamp": "1767225600000"}
    assert sources.source_options("text", cap=5) == {"latestFirst": "false", "maxFilesPerTrigger": "5"}
    assert "maxFilesPerTrigger" not in sources.source_options("text", cap=0)


def test_trigger_options():
    assert sources.trigger_options() == {"processingTime": "30 seconds"}
    assert sources.trigger_options("5 seconds") == {"processingTime": "5 seconds"}
    assert sources.trigger_options(None) == {"availableNow": True}


def test_broken_messages(spark):
    key = '"record_id": "1", "event_time": "2026-01-01T00:00:00.000000Z", "session_id": "s"'
    given = [f'{{"rate": 1.5, {key}}}', f'{{"rate": NaN, {key}}}', '{"rate": "x"}', "not json", None, "{}", '{"rate": 1.0}']
    rows = spark.createDataFrame([(v,) for v in given], "value string")
    parsed = messages.parse_messages(rows, MESSAGE_SCHEMA)
    good = [r.rate for r in messages.good_rows(parsed, MESSAGE_SCHEMA).collect()]
    assert good[0] == 1.5 and good[1] != good[1] and len(good) == 2
    assert sorted(r.value for r in messages.bad_rows(parsed).collect()) == sorted(["not json", '{"rate": "x"}', "{}", '{"rate": 1.0}'])


def test_messages_are_parsed_once(spark):
    """The conditions of a good message read what is parsed: pushed below it, each of them would parse the text again."""
    rows = spark.createDataFrame([('{"rate": 1.0}',)], "value string").localCheckpoint()
    good = messages.good_rows(messages.parse_messages(rows, MESSAGE_SCHEMA), MESSAGE_SCHEMA)
    assert good._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_failed_batch_is_run_again(spark):
    """An error after half the work stops the query; the restart loses nothing and doubles nothing."""
    folder, path, offsets = (work_path(spark, n) for n in ("in", "out", "offsets"))
    alert_table.create_tables(spark, path)
    messages.publish(lines(spark, 20, extra=["broken"]), "text", folder)
    stream = sources.message_stream(spark, folder, fmt="text", cap=0)
    job = jobs.scoring_batch(MESSAGE_SCHEMA, rules, path)
    failures = []

    def fails_once(batch, batch_id):
        job(batch, batch_id)
        if not failures:
            failures.append(batch_id)
            raise RuntimeError("lost executor")

    with pytest.raises(Exception, match="lost executor"):
        jobs.run_to_end(jobs.start(stream, fails_once, offsets, trigger=None))
    jobs.run_to_end(jobs.start(stream, fails_once, offsets, trigger=None))
    messages.publish(lines(spark, 5, start=20), "text", folder)
    jobs.run_to_end(jobs.start(stream, fails_once, offsets, trigger=None))
    rows = spark.read.parquet(f"{path}/alerts")
    assert rows.count() == rows.select("alert_id").distinct().count() == 25
    assert [r.value for r in spark.read.text(f"{path}/quarantine").collect()] == ["broken"]
    counts = spark.read.parquet(f"{path}/metrics").orderBy("commit").select("rows", "bad", "attacks").collect()
    assert list(map(tuple, counts)) == [(20, 1, 20), (5, 0, 5)]


def test_empty_batch_is_skipped_and_stop_is_graceful(spark):
    folder, offsets = work_path(spark, "in"), work_path(spark, "offsets")
    messages.publish(lines(spark, 3), "text", folder)
    stream = sources.message_stream(spark, folder, fmt="text", cap=0).where("value = 'none such'")
    calls = []
    query = jobs.start(stream, lambda batch, batch_id: calls.append(batch_id), offsets, trigger="1 second")
    query.processAllAvailable()
    jobs.run_to_end(query, timeout=1)
    assert calls == [] and not query.isActive


def test_fitted_models_score_a_stream(spark):
    rows = spark.range(400).select(
        (F.col("id") % 10).cast("double").alias("rate"), F.lit("tcp").alias("proto"), F.lit("-").alias("service"),
        F.lit("FIN").alias("state"), (F.col("id") % 10 >= 5).cast("double").alias("binary_label"),
        F.when(F.col("id") % 10 >= 5, 1.0 + F.col("id") % 2).otherwise(0.0).alias("class_label"),
    )
    small = {"numTrees": 2, "maxDepth": 3}
    binary = train.fit_binary_forest(rows, rows, ["rate"], params=small).model
    category = train.fit_category_forest(rows, rows, ["rate"], grid=[small]).model
    folder, path = work_path(spark, "in"), work_path(spark, "out")
    alert_table.create_tables(spark, path)
    for start in (0, 20):
        messages.publish(lines(spark, 20, start, extra=["broken"]), "text", folder)
    stream = sources.message_stream(spark, folder, fmt="text", cap=1)
    job = jobs.scoring_batch(MESSAGE_SCHEMA, lambda flows: score.cascade(flows, binary, category, ["rate"]), path)
    jobs.run_to_end(jobs.start(stream, job, work_path(spark, "offsets"), trigger=None))
    found = alert_table.read_alerts(spark, path)
    assert found.count() == 40 and {r.severity for r in found.collect()} == {"high"}
    counts = spark.read.parquet(f"{path}/metrics").select("rows", "bad", "attacks").collect()
    assert list(map(tuple, counts)) == [(20, 1, 20)] * 2


def texts(spark, out):
    return sorted(r.value for r in spark.read.schema("value string").parquet(out).collect())


def test_folder_from_a_time_on(spark):
    folder, out, offsets = (work_path(spark, n) for n in ("in", "out", "offsets"))
    publish = lambda word: messages.publish(spark.createDataFrame([(word,)], "value string").coalesce(1), "text", folder)
    publish("old")
    time.sleep(0.1)
    since = dt.datetime.now(dt.timezone.utc)
    publish("new")
    stream = sources.message_stream(spark, folder, fmt="text", starting=since)
    jobs.run_to_end(jobs.start(stream, jobs.batch_writer(out), work_path(spark, "offsets"), trigger=None))
    assert texts(spark, out) == ["new"]
    with pytest.raises(ValueError, match="checkpoint"):
        sources.message_stream(spark, folder, fmt="text", starting="latest")
    first = sources.start_of(spark, offsets)
    time.sleep(0.05)
    assert sources.start_of(spark, offsets) == first > since


def test_each_message_is_scored_once(spark):
    folder, path = work_path(spark, "in"), work_path(spark, "out")
    alert_table.create_tables(spark, path)
    messages.publish(lines(spark, 30, extra=["broken"]), "text", folder)
    looked_at = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counting(rates):
        looked_at.add(len(rates))
        return rates

    once = counting.asNondeterministic()  # else the optimizer may repeat the expression itself
    job = jobs.scoring_batch(MESSAGE_SCHEMA, lambda flows: rules(flows.withColumn("rate", once("rate"))), path)
    jobs.run_to_end(jobs.start(sources.message_stream(spark, folder, fmt="text", cap=0), job, work_path(spark, "offsets"), trigger=None))
    row = spark.read.parquet(f"{path}/metrics").first()
    assert looked_at.value == 30 and (row.rows, row.bad, row.attacks) == (30, 1, 30) and row.write_seconds > 0


START = dt.datetime(2026, 1, 1)
SEEN = "name string, alert_time timestamp"


def batches_of(spark, *batches):
    """A stream that gives these (name, seconds) one batch after the other."""
    folder = work_path(spark, "batches")
    for rows in batches:
        frame = spark.createDataFrame([(n, START + dt.timedelta(seconds=s)) for n, s in rows], SEEN)
        frame.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    return spark.readStream.schema(SEEN).option("maxFilesPerTrigger", 1).parquet(folder)


def test_first_per_key_comes_at_once_and_once(spark):
    stream = batches_of(spark, [("a", 0), ("a", 0), ("b", 5)], [("a", 0), ("c", 20)], [("b", 5), ("d", 25)], [("e", 500), ("a", 0)], [("b", 5), ("f", 501)])
    out = work_path(spark, "first")
    jobs.run_to_end(jobs.start(jobs.first_per_key(stream, ["name", "alert_time"]), jobs.batch_writer(out), work_path(spark, "o"), trigger=None, skip_empty=False))
    found = sorted((r.name, r.commit) for r in spark.read.parquet(out).collect())
    assert [n for n, _ in found] == ["a", "b", "c", "d", "e", "f"]
    assert dict(found)["f"] == 4  # the newest is not held back


@pytest.mark.parametrize("cut", [[2, 4, 6, 8], [8], [1, 2, 3, 4, 5, 6, 7, 8]])
def test_evictions_do_not_depend_on_batches(spark, cut):
    rows = [("a", 0), ("b", 10), ("a", 50), ("a", 149), ("b", 110), ("a", 300), ("c", 320), ("z", 1000)]
    parts = [rows[a:b] for a, b in zip([0, *cut], cut)]
    out = work_path(spark, "evicted")
    with keyed_state(spark):
        gone = evictions(batches_of(spark, *parts), ["name"], 100, "60 seconds", cap=2)
        jobs.run_to_end(jobs.start(gone, jobs.batch_writer(out), work_path(spark, "o"), trigger=None, skip_empty=False))
    found = sorted((r.name, (r.evicted_at - START).total_seconds(), r.entries) for r in spark.read.parquet(out).collect())
    assert found == [("a", 249, 2), ("a", 400, 1), ("b", 110, 1), ("b", 210, 1), ("c", 420, 1)]


def test_state_of_evicted_keys_is_gone(spark):
    out, offsets = work_path(spark, "evicted"), work_path(spark, "o")
    with keyed_state(spark):
        gone = evictions(batches_of(spark, [("a", 0)], [("z", 1000)]), ["name"], 100, "60 seconds", cap=2)
        jobs.run_to_end(jobs.start(gone, jobs.batch_writer(out), offsets, trigger=None, skip_empty=False))
        held = spark.read.format("statestore").option("stateVarName", "held").load(offsets)
        assert [r.key.name for r in held.collect()] == ["z"]
