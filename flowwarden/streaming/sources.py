"""Stream sources and query options."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TRIGGER = "30 seconds"
DEFAULT_DELAY = "30 seconds"
DEFAULT_CAP = 100
#: Where a stream starts that is not told: a topic at its end, a folder with everything in it.
LATEST, EARLIEST = "latest", "earliest"


def source_options(fmt: str, starting: str | dt.datetime = LATEST, cap: int = DEFAULT_CAP) -> dict[str, str]:
    """Reader options: where to start and how much a trigger takes at most (0 = no cap)."""
    if fmt == "kafka":
        options = {"startingTimestamp": str(_millis(starting))} if isinstance(starting, dt.datetime) else {"startingOffsets": starting}
        return {**options, "maxOffsetsPerTrigger": str(cap)} if cap > 0 else options
    options = {"latestFirst": "false"}
    return {**options, "maxFilesPerTrigger": str(cap)} if cap > 0 else options


def _millis(time: dt.datetime) -> int:
    """A time without a zone is UTC, as everywhere in this package."""
    return int((time if time.tzinfo else time.replace(tzinfo=dt.timezone.utc)).timestamp() * 1000)


def start_of(spark: SparkSession, checkpoint: str) -> dt.datetime:
    """When the query with this checkpoint was first started: now, at its first start.

    It is kept beside the offsets, so a restart takes up what came while the query was down, as it does for a topic.
    """
    path = f"{checkpoint.rstrip('/')}-start"
    kept = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not kept.getFileSystem(spark._jsc.hadoopConfiguration()).exists(kept):
        spark.createDataFrame([(_millis(dt.datetime.now(dt.timezone.utc)),)], "at long").coalesce(1).write.mode("ignore").parquet(path)
    return dt.datetime.fromtimestamp(spark.read.parquet(path).first()[0] / 1000, dt.timezone.utc)


def message_stream(
    spark: SparkSession,
    source: str,
    fmt: str = "kafka",
    starting: str | dt.datetime | None = None,
    cap: int = DEFAULT_CAP,
    options: dict[str, str] | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """A stream with the message text in column ``value``, from a topic or from text files.

    ``starting`` is "earliest", "latest" or a time, for both kinds: a topic starts at its offsets, a folder with the files written since then. For
    a folder "latest" is the first start of the query with ``checkpoint``.
    """
    starting = starting or (LATEST if fmt == "kafka" else EARLIEST)
    reader = spark.readStream.format(fmt).options(**source_options(fmt, starting, cap), **(options or {}))
    if fmt == "kafka":
        return reader.option("subscribe", source).load().selectExpr("CAST(value AS STRING) AS value")
    files = reader.load(source)
    if starting == EARLIEST:
        return files.select("value")
    if starting == LATEST:
        if checkpoint is None:
            raise ValueError("a folder needs the query's checkpoint to start at the latest file")
        starting = start_of(spark, checkpoint)
    # The file source has no such option for streams; the file's own time skips whole files.
    since = F.timestamp_millis(F.lit(_millis(starting)))
    return files.where(F.col("_metadata.file_modification_time") >= since).select("value")


def trigger_options(interval: str | None = DEFAULT_TRIGGER) -> dict:
    """A processing-time trigger, or with ``None`` one run over everything available."""
    return {"processingTime": interval} if interval else {"availableNow": True}
