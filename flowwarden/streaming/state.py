"""Keyed state with expiry: what a cache with a lifetime per key holds, kept by the stream itself."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State with timers needs this store.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_MICROS = "datetime64[us]"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries that are started inside keep their state in the store that knows timers; others are not touched."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


class ExpiringCounts(StatefulProcessor):
    """Entries per key since the key was last idle for a lifetime.

    The state of a key is its number of entries (at most ``cap``) and the newest time. A timer on the event clock stands at that time plus the
    lifetime; an entry that comes first moves it, else the key's state goes. A batch may hold entries on both sides of an idle time:
    these are told apart by their times, so the result does not depend on how the stream is cut into batches.
    """

    def __init__(self, keys: list[str], time: str, seconds: int, cap: int) -> None:
        self.keys, self.time, self.lifetime, self.cap = keys, time, pd.Timedelta(seconds=seconds), cap

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "entries long, last timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = pd.concat([part[self.time] for part in rows]).astype(_MICROS).sort_values(ignore_index=True)
        entries, last = self.held.get() if self.held.exists() else (0, None)
        gone = []
        # Runs of entries that follow each other within the lifetime.
        run = (times.diff() >= self.lifetime).cumsum()
        for _, part in times.groupby(run):
            if last is not None and part.iloc[0] - last >= self.lifetime:
                gone.append((last, entries))
                entries = 0
            entries, last = min(self.cap, entries + len(part)), part.iloc[-1] if last is None else max(last, part.iloc[-1])
        self.held.update((int(entries), last.to_pydatetime()))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(_millis(last + self.lifetime))
        yield self._rows(key, gone)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        entries, last = self.held.get()
        self.held.clear()
        yield self._rows(key, [(pd.Timestamp(last), entries)])

    def _rows(self, key, gone: list[tuple[pd.Timestamp, int]]) -> pd.DataFrame:
        out = {name: pd.Series([value] * len(gone), dtype=object) for name, value in zip(self.keys, key)}
        out["evicted_at"] = pd.Series([last + self.lifetime for last, _ in gone], dtype=_MICROS)
        out["entries"] = pd.Series([n for _, n in gone], dtype="int64")
        return pd.DataFrame(out)

    def close(self) -> None:
        pass


def _millis(time: pd.Timestamp) -> int:
    """The first full millisecond that is not before ``time``: watermarks have no finer steps."""
    return -(-time.value // 1_000_000)


def evictions(alerts: DataFrame, keys: list[str], seconds: int, delay: str, cap: int, time: str = "alert_time") -> DataFrame:
    """One row per key and idle time of a lifetime: the keys, evicted_at and the entries that went. The state of such keys is dropped.

    Start the query inside ``keyed_state``. One key's rows of a trigger meet in one task, so the trigger's cap bounds them.
    """
    kinds = {f.name: f.dataType for f in alerts.schema.fields}
    out = T.StructType([*(T.StructField(k, kinds[k]) for k in keys), T.StructField("evicted_at", T.TimestampType()), T.StructField("entries", T.LongType())])
    return (
        alerts.select(*keys, time).withWatermark(time, delay).groupBy(*keys)
        .transformWithStateInPandas(ExpiringCounts(keys, time, seconds, cap), out, "Append", "EventTime")
    )
