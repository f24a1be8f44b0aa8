import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowwarden import schemas
from flowwarden.functions import scalars as S
from flowwarden.operators import analytics, cleanse, joins

INF, NAN = float("inf"), float("nan")


def column(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_finite_or_zero(spark):
    assert column(spark, [None, NAN, INF, -INF, 1.0], "double", S.finite_or_zero) == [0, 0, 0, 0, 1.0]


def test_safe_int(spark):
    whole = lambda c: S.safe_int(c, 7)
    assert column(spark, [None, NAN, INF, 3.7, -3.7, 1e300], "double", whole) == [7, 7, 7, 3, -3, 7]
    assert column(spark, ["3.7", "x", " 12 ", ""], "string", whole) == [7, 7, 12, 7]


def test_category(spark):
    values = [None, "", "  ", " DoS "]
    assert column(spark, values, "string", S.category_or) == ["Normal", "Normal", "Normal", "DoS"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-01-01T10:00:00Z", "2026-01-01 10:00:00"),
        ("2026-01-01T10:00:00+05:30", "2026-01-01 04:30:00"),
        ("2026-01-01T10:00:00-0230", "2026-01-01 12:30:00"),
        ("2026-01-01T10:00:00.123456", "2026-01-01 10:00:00.123456"),
        ("2026-01-01 10:00", "2026-01-01 10:00:00"),
        ("20260101T100000", "2026-01-01 10:00:00"),
        ("2026-01-01", "2026-01-01 00:00:00"),
        ("2026-01", "1970-01-01 00:00:00"),
        ("2026-02-30", "1970-01-01 00:00:00"),
        ("2026", "1970-01-01 00:00:00"),
        ("bad", "1970-01-01 00:00:00"),
        ("", "1970-01-01 00:00:00"),
        (None, "1970-01-01 00:00:00"),
    ],
)
def test_parse_iso(spark, text, expected):
    assert column(spark, [text], "string", lambda c: S.parse_iso(c).cast("string"))[0] == expected.removesuffix(".0")


def minutes(spark, interval):
    times = [dt.datetime(2026, 1, 1, 5, m, 13, 7) for m in (0, 44, 45, 59)]
    return [t.minute for t in column(spark, times, "timestamp_ntz", lambda c: S.floor_in_hour(c, interval))]


def test_floor_in_hour(spark):
    assert minutes(spark, 45) == [0, 0, 45, 45]
    assert minutes(spark, 120) == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        S.floor_in_hour(F.col("v"), 0)


def test_lookup_of_empty_map(spark):
    assert column(spark, [1, 2], "int", lambda c: S.lookup(c, {}, "Unknown")) == ["Unknown", "Unknown"]


def test_severity_defaults_and_alias(spark):
    assert column(spark, ["Backdoor", "Mystery"], "string", joins.severity_of) == ["high", "medium"]
    assert column(spark, ["Mystery"], "string", lambda c: joins.severity_of(c, "info")) == ["info"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "v double")
    got = sorted((r.v for r in cleanse.clip_outliers(df, ["v", "absent"], 0.1, 0.9).collect()), key=lambda v: (v is None, v))
    assert got[0] == 10.0 and got[-2] == 90.0 and got[-1] is None


def test_median_of_integers_is_not_truncated(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert sorted(r.v for r in cleanse.fill_medians(df).collect()) == [1.0, 1.5, 2.0]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert cleanse.missing_columns(df, ["a", "c"]) == ["c"]
    with pytest.raises(ValueError, match="c"):
        cleanse.require_columns(df, ["a", "c"])
    assert cleanse.clean_features(df, ["b", "z"]).columns == ["a", "b", "z"]


def test_stats_without_rows(spark):
    df = spark.createDataFrame([], schemas.ALERT_SCHEMA)
    assert [tuple(r) for r in analytics.alert_stats(df, None).collect()] == [("total", "all", 0)]
    assert analytics.timeline(df, 60, None).count() == 0


def test_fixed_values():
    assert len(schemas.FEATURES) == len(set(schemas.FEATURES)) == 39
    assert len(schemas.FLOW_SCHEMA) == 44
    assert len(schemas.ATTACK_TYPES) == 10 and schemas.ATTACK_TYPES[0] == "Normal"
    assert set(schemas.ATTACK_TYPES.values()) == set(schemas.SEVERITIES)
    assert set(schemas.SEVERITIES.values()) <= set(schemas.SEVERITY_LEVELS)
    assert 0 < schemas.HIGH_CONFIDENCE < 1
