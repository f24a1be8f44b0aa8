"""Rows as JSON messages and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds survive the round trip; the default format keeps milliseconds only.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
CORRUPT = "_corrupt_record"
#: Fields that identify a flow or an alert.
KEYS = ("record_id", "event_time", "alert_id", "alert_time", "session_id")


def to_messages(df: DataFrame, drop: tuple[str, ...] = ("id",)) -> DataFrame:
    """One JSON text per row in column ``value``; NaN must have been made null before."""
    rows = df.drop(*drop)
    return rows.select(F.to_json(F.struct("*"), JSON_TIMES).alias("value"))


def publish(messages: DataFrame, fmt: str, target: str, options: dict[str, str] | None = None) -> None:
    """Append messages to a topic (``kafka``, where the connector is installed) or to files."""
    writer = messages.write.format(fmt).mode("append").options(**(options or {}))
    writer.option("topic", target).save() if fmt == "kafka" else writer.save(target)


def parse_messages(df: DataFrame, schema: T.StructType, required: tuple[str, ...] | None = None) -> DataFrame:
    """Column ``row`` with the parsed struct and ``bad`` for text that does not fit the schema.

    The schema carries a corrupt-record field: without it a broken message would come out as a
    row of nulls and be scored as zeros. So would a message without its ``required`` fields (by default
    key, time and session, where the schema has them): it is bad, too.

    The text is parsed behind an explode of one entry, which filters are not pushed through: else each condition of ``bad`` would parse it again.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_TIMES}
    parsed = df.where(F.col("value").isNotNull()).withColumn("row", F.explode(F.array(F.from_json("value", full, options))))
    bad = F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()
    for c in KEYS if required is None else required:
        if c in schema.names:
            bad |= F.col(f"row.{c}").isNull()
    return parsed.withColumn("bad", bad)


def good_rows(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    return parsed.where(~F.col("bad")).select([F.col(f"row.{c}").alias(c) for c in schema.names])


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where("bad").select("value")
