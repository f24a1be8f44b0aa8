import datetime as dt
import json

from pyspark.sql import functions as F

from flowwarden.operators import analytics, ranking
from flowwarden.session import work_path
from flowwarden.sources import alert_table as A
from flowwarden.sources.folders import folders, rename_folder

NOON = dt.datetime(2026, 1, 1, 12, 0)


def alert(minute=0, **changes):
    """A worm seen ``minute`` minutes after noon."""
    seen = {"alert_time": NOON + dt.timedelta(minutes=minute), "attack_type": "Worms", "severity": "medium"}
    ends = {"src_ip": "192.168.7.7", "src_port": 50000, "dst_ip": "192.168.7.9", "dst_port": 443, "protocol": "udp"}
    said = {"binary_prediction": 1, "binary_probability": 0.75, "attack_confidence": 0.6, "sbytes": 17, "dbytes": 34, "rate": 2.25}
    return seen | ends | said | changes


def new_table(spark):
    path = work_path(spark, "test")
    A.create_tables(spark, path)
    return path


def ids(rows):
    return sorted(r.alert_id for r in rows.collect())


def test_counts_of_one_session(spark):
    path = new_table(spark)
    for minute, kind in ((3, "Worms"), (61, "DoS"), (62, "Worms")):
        A.store_alert(spark, alert(minute, alert_id=f"m{minute}", attack_type=kind), path, minute, "left")
    A.store_alert(spark, alert(5, alert_id="other"), path, 5, "right")
    rows = A.read_alerts(spark, path, "left")
    assert [r.alert_id for r in A.latest_alerts(spark, path, "left", 2).collect()] == ["m62", "m61"]
    facets = {(r.facet, r.name): r.alerts for r in analytics.alert_stats(rows, hours=None).collect()}
    assert facets[("attack_type", "Worms")] == 2 and facets[("total", "all")] == 3
    assert [r.alerts for r in analytics.timeline(rows, 60, hours=None).collect()] == [1, 2]


def test_delete_hides_what_was_there(spark):
    path = new_table(spark)
    A.store_alert(spark, alert(alert_id="old"), path, 500, "s1")
    assert A.delete_session(spark, path, "s1", 100).first().removed_alerts == 1
    assert ids(A.read_alerts(spark, path, "s1")) == [] and A.latest_alerts(spark, path).count() == 0
    A.store_alert(spark, alert(alert_id="new"), path, 0, "s1", writer="stream")
    A.store_alert(spark, alert(alert_id="old"), path, 1, "s1", writer="stream")
    assert ids(A.read_alerts(spark, path)) == ["new", "old"]
    assert A.delete_session(spark, path, "unknown", 101).first().removed_alerts == 0


def test_writers_do_not_meet(spark):
    path, small = new_table(spark), work_path(spark, "small")
    for writer in ("a", "b"):
        for i in range(2):
            A.store_alert(spark, alert(i, alert_id=f"{writer}{i}"), path, i, "s1", writer=writer)
    A.compact(spark, path, small)
    A.store_alert(spark, alert(9, alert_id="late"), small, 1, "s1", writer="a")
    assert ids(A.read_alerts(spark, small)) == ["a0", "a1", "b0", "b1", "late"]


def test_last_of_several_writers_counts(spark):
    path = new_table(spark)
    for i, (writer, rate) in enumerate((("a", 1.0), ("b", 2.0), ("a", 3.0))):
        A.store_alert(spark, alert(alert_id="same", rate=rate), path, i, "s1", writer=writer)
    assert [r.rate for r in A.read_alerts(spark, path).collect()] == [3.0]
    assert [r.rate for r in A.latest_alerts(spark, path).collect()] == [3.0]


def test_repeated_replication_keeps_its_rows(spark):
    source, target = new_table(spark), new_table(spark)
    for i in range(4):
        A.store_alert(spark, alert(i, alert_id=str(i)), source, i, "s1")
    for _ in range(2):
        A.replicate(spark, source, target, "s1", 7, n=3)
        assert ids(A.read_alerts(spark, target)) == ["1", "2", "3"]


def test_reads_do_not_sort_before_the_first_shuffle(spark):
    path = new_table(spark)
    A.store_alert(spark, alert(alert_id="x"), path, 1, "s1")
    for rows in (A.read_alerts(spark, path), A.latest_alerts(spark, path, n=100)):
        plan = rows._jdf.queryExecution().sparkPlan().toString()
        assert "SortAggregate" not in plan


def test_ingest_keeps_every_alert(spark, tmp_path):
    path = new_table(spark)
    times = ["2026-01-01T10:00:00Z", "bad", "", None]
    given = [{"alert_id": i, "alert_time": t, "attack_type": "DoS"} for i in ("", None) for t in times] * 2
    (tmp_path / "p.json").write_text(json.dumps({"session_id": "s1", "alerts": given, "sessions": [{"session_id": "s1"}]}))
    schema = "session_id string, alerts array<struct<alert_id string, alert_time string, attack_type string>>, sessions array<struct<session_id string, dataset string>>"
    for _ in range(2):
        A.ingest(spark.read.schema(schema).json(str(tmp_path / "p.json")), path, 1, "local-session")
    rows = A.read_alerts(spark, path).collect()
    assert len(rows) == len({r.alert_id for r in rows}) == 16 and "" not in {r.alert_id for r in rows}
    clocks = [r.alert_time for r in rows]
    assert clocks.count(dt.datetime(2026, 1, 1, 10)) == 4 and clocks.count(dt.datetime(1970, 1, 1)) == 8


def test_delete_all(spark):
    path = new_table(spark)
    one = spark.createDataFrame([("s1", "flows", NOON), ("s2", "flows", NOON)], "session_id string, dataset string, created_at timestamp")
    A.store_sessions(one, path, 1)
    for session in ("s1", "s2", "s3"):
        A.store_alert(spark, alert(alert_id=session), path, int(session[1]), session)
    gone = A.delete_all(spark, path, 3).first()
    assert (gone.removed_sessions, gone.removed_alerts) == (2, 3)
    assert A.read_alerts(spark, path).count() == 0 and A.read_sessions(spark, path).count() == 0


def test_defaults_are_filled(spark):
    path = new_table(spark)
    A.store_alert(spark, {"attack_type": "Worms", "alert_time": NOON}, path, 1, "s1")
    row = A.read_alerts(spark, path).first()
    assert (row.src_port, row.sbytes, row.rate, row.src_ip, row.severity) == (0, 0, 0.0, "", "")
    assert row.alert_id and row.alert_time == NOON


def test_commit_again_replaces(spark):
    path = new_table(spark)
    for _ in range(2):
        A.store_alert(spark, alert(alert_id="a"), path, 1, "s1")
    assert spark.read.parquet(f"{path}/alerts").count() == 1
    A.create_tables(spark, path)
    assert A.read_alerts(spark, path).count() == 1


def test_one_key_with_many_copies(spark):
    path = new_table(spark)
    rows = spark.range(3000).select(
        F.lit("s1").alias("session_id"), F.lit(NOON).alias("alert_time"),
        F.when(F.col("id") < 2000, "same").otherwise(F.col("id").cast("string")).alias("alert_id"),
        F.col("id").cast("double").alias("rate"),
    )
    A.store_alerts(rows, path, 1)
    assert A.read_alerts(spark, path).count() == 1001


def test_since_selects_months(spark):
    path = new_table(spark)
    for i, month in enumerate((1, 2, 3)):
        A.store_alert(spark, alert(alert_time=dt.datetime(2026, month, 15), alert_id=str(month)), path, i, "s1")
    rows = A.read_alerts(spark, path, "s1", since=dt.datetime(2026, 2, 15))
    assert {r.alert_id for r in rows.collect()} == {"2", "3"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "alert_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_recent_list_is_capped(spark):
    path = new_table(spark)
    rows = spark.range(50).select(
        F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("session_id"),
        F.timestamp_seconds(F.col("id")).alias("alert_time"), F.col("id").cast("string").alias("alert_id"),
    )
    A.store_alerts(rows, path, 1)
    kept = A.recent_alerts(spark, path, cap=3).collect()
    assert sorted(int(r.alert_id) for r in kept) == [44, 45, 46, 47, 48, 49]


def test_session_ids_differ():
    ids = {A.new_session_id() for _ in range(50)}
    assert len(ids) == 50 and all(len(i) == 18 and i.startswith("session-") for i in ids)


def month_alerts(spark, path):
    """Ten alerts a month over a year, each month a commit of its own."""
    for i, month in enumerate(range(1, 13)):
        rows = spark.range(10).select(
            F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("session_id"),
            F.make_timestamp(F.lit(2026), F.lit(month), F.col("id").cast("int") + 1, F.lit(0), F.lit(0), F.lit(0)).alias("alert_time"),
            F.concat(F.lit(f"{month}-"), F.col("id").cast("string")).alias("alert_id"),
        )
        A.store_alerts(rows, path, i)


def test_newest_rows_open_the_newest_months(spark):
    path = new_table(spark)
    month_alerts(spark, path)
    for session, n in ((None, 3), (None, 25), ("s1", 2), ("s1", 12), (None, 500), ("none such", 5)):
        rows = A.latest_alerts(spark, path, session, n)
        want = ranking.latest(A.read_alerts(spark, path, session), n)
        assert [r.alert_id for r in rows.collect()] == [r.alert_id for r in want.collect()]
    rows = A.latest_alerts(spark, path, None, 3)
    assert len(rows.inputFiles()) <= 2 + 1  # two sessions of one month, and what the deletes have
    A.delete_session(spark, path, "s0", 99)
    assert [r.alert_id for r in A.latest_alerts(spark, path, n=6).collect()] == ["12-9", "12-7", "12-5", "12-3", "12-1", "11-9"]
    assert [r.alert_id for r in A.latest_alerts(spark, path, n=3, since=dt.datetime(2026, 12, 9)).collect()] == ["12-9"]


def test_merged_commits_read_the_same(spark):
    path = new_table(spark)
    for i in range(5):
        A.store_alert(spark, alert(i, alert_id=str(i), rate=1.0), path, i, "s1", writer="a")
        A.store_alert(spark, alert(0, alert_id="same", rate=float(i)), path, i, "s/1:*", writer="b")
    before = sorted((r.alert_id, r.rate) for r in A.read_alerts(spark, path).collect())
    assert A.merge_commits(spark, path, "a", upto=2) == 2 and A.merge_commits(spark, path, "b") == 3
    assert sorted((r.alert_id, r.rate) for r in A.read_alerts(spark, path).collect()) == before
    assert [r.rate for r in A.latest_alerts(spark, path, "s/1:*").collect()] == [4.0]
    # The stream runs a merged batch again: its rows are there already.
    A.store_alert(spark, alert(1, alert_id="1", rate=9.0), path, 1, "s1", writer="a")
    assert sorted((r.alert_id, r.rate) for r in A.read_alerts(spark, path).collect()) == before
    A.store_alert(spark, alert(0, alert_id="0", rate=5.0), path, 5, "s1", writer="a")
    assert A.merge_commits(spark, path, "a") == 4
    assert dict(sorted((r.alert_id, r.rate) for r in A.read_alerts(spark, path, "s1").collect())) == {"0": 5.0, "1": 1.0, "2": 1.0, "3": 1.0, "4": 1.0}
    assert len(folders(spark, f"{path}/alerts/writer=a*/commit=*")) == 2
    A.delete_session(spark, path, "s1", 1)
    assert ids(A.read_alerts(spark, path)) == ["same"]


def test_merge_that_broke_off(spark):
    """The merged folder is there, the old ones too: reads take each row once, and the next merge tidies up."""
    path = new_table(spark)
    for i in range(4):
        A.store_alert(spark, alert(i, alert_id=str(i)), path, i, "s1")
    copy = work_path(spark, "copy")
    for folder in folders(spark, f"{path}/alerts/writer=main/commit=*"):
        number = folder.rsplit("=", 1)[1]
        spark.read.parquet(folder).write.partitionBy("session_id", "alert_month").parquet(f"{copy}/commit={number}")
    A.merge_commits(spark, path)
    for i in range(3):
        rename_folder(spark, f"{copy}/commit={i}", f"{path}/alerts/writer=main/commit={i}")
    assert ids(A.read_alerts(spark, path)) == ["0", "1", "2", "3"]
    assert A.read_alerts(spark, path).count() == 4
    assert A.merge_commits(spark, path) == 2
    assert len(folders(spark, f"{path}/alerts/writer=*/commit=*")) == 2


def test_recent_rows_are_cut_before_they_are_joined(spark):
    path = new_table(spark)
    month_alerts(spark, path)
    want = ranking.top_n_per_key(A.read_alerts(spark, path), ["session_id"], ranking.newest_first(), 7)
    assert ids(A.recent_alerts(spark, path, cap=7)) == ids(want)
