"""Sessions and alerts as arbitrary state of a stream, with timers.

A meter's readings are put in order of time by the watermark: what lies behind
it cannot change, so sessions close and readings are scored once it has passed them.
State is a meter's open sessions, or its readings that still wait, the last one
scored and the last few uses; timers let it go, one at a time: the next one is set when it fires. A stream that is restarted on its
checkpoint goes on with both, and its output is what the batch functions of
``plans.marts`` give for the same readings.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: One bound for the native memory of all of an executor's stores, which otherwise grows with their number.
_BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR = 3_600_000_000


@contextmanager
def state_store(spark: SparkSession):
    """The state store that arbitrary and large state need, on disk and bounded in memory, for queries started inside."""
    before, bounded = spark.conf.get(_PROVIDER), spark.conf.get(_BOUNDED, "false")
    spark.conf.set(_PROVIDER, _ROCKS)
    spark.conf.set(_BOUNDED, "true")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)
        spark.conf.set(_BOUNDED, bounded)


def _frame(rows: list[tuple], columns: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns.split())


class Sessions(StatefulProcessor):
    """Open sessions of a meter; one closes when the watermark is ``gap`` microseconds past its last reading."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle) -> None:
        self.handle, self.open = handle, handle.getListState("open", "started long, ended long, n_rows long")

    def _held(self) -> list[list[int]]:
        return [list(x) for x in self.open.get()] if self.open.exists() else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._held() + [[int(t), int(t), 1] for part in rows for t in part["micros"]]
        merged: list[list[int]] = []
        for started, ended, n in sorted(held):
            if merged and started < merged[-1][1] + self.gap:
                last = merged[-1]
                last[1], last[2] = max(last[1], ended), last[2] + n
            else:
                merged.append([started, ended, n])
        self.open.put([tuple(x) for x in merged])
        self._wake(merged)
        return iter(())

    def _wake(self, held: list[list[int]]) -> None:
        """When the first of the open sessions closes; they are in order of time."""
        self.handle.registerTimer(-(-(held[0][1] + self.gap) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark, held = timerValues.getCurrentWatermarkInMs() * 1000, self._held()
        closed, left = [x for x in held if x[1] + self.gap <= mark], [x for x in held if x[1] + self.gap > mark]
        if left:
            self._wake(left)
        if closed:
            if left:
                self.open.put([tuple(x) for x in left])
            else:
                self.open.clear()
            yield _frame([(key[0], *x) for x in closed], "meter_id started ended n_rows")

    def close(self) -> None:
        pass


class Alerts(StatefulProcessor):
    """Readings of a meter that wait for the watermark, and what the next one is scored against.

    A use over ``threshold`` times the greatest of the ``last`` before is a spike; no
    reading for ``silence`` microseconds is a meter gone silent. A meter that stays silent
    keeps one last value and its uses.
    """

    def __init__(self, threshold: float, last: int, silence: int):
        self.threshold, self.last, self.silence = threshold, last, silence

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "micros long, liters double")
        self.before = handle.getValueState("before", "micros long, liters double, told boolean")
        self.uses = handle.getListState("uses", "used double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = [(int(t), float(v)) for part in rows for t, v in zip(part["micros"], part["liters"], strict=True)]
        if came:
            self.waiting.appendList(came)
            self.handle.registerTimer(-(-min(came)[0] // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted(tuple(x) for x in self.waiting.get()) if self.waiting.exists() else []
        ready, later = [x for x in held if x[0] <= mark], [x for x in held if x[0] > mark]
        before = tuple(self.before.get()) if self.before.exists() else None
        uses = [x[0] for x in self.uses.get()] if self.uses.exists() else []
        out = []
        for micros, liters in ready:
            if before and not before[2] and micros - before[0] >= self.silence:
                out.append((key[0], before[0], "silent", None, None))
            used = max(liters - before[1], 0.0) if before else 0.0
            top = max(uses, default=0.0)
            if top > 0 and used / top > self.threshold:
                out.append((key[0], micros, "spike", used, used / top))
            uses = [*uses, used][-self.last :]
            before = (micros, liters, False)
        if before and not before[2] and not later and before[0] + self.silence <= mark:
            out.append((key[0], before[0], "silent", None, None))
            before = (before[0], before[1], True)
        if ready:
            self.uses.put([(u,) for u in uses])
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        if before:
            self.before.update(before)
        # the next one is that of the next reading, or of the silence if none waits
        if later:
            self.handle.registerTimer(-(-later[0][0] // 1000))
        elif before and not before[2]:
            self.handle.registerTimer(max(-(-(before[0] + self.silence) // 1000), mark // 1000 + 1))
        if out:
            yield _frame(out, "meter_id micros kind used_liters score")

    def close(self) -> None:
        pass


def _timed(rows: DataFrame, late: str) -> DataFrame:
    return rows.filter("meter_id is not null and reading_timestamp is not null").withWatermark("reading_timestamp", late).withColumn("micros", F.unix_micros("reading_timestamp"))


def session_stream(rows: DataFrame, gap_micros: int, *, late: str = "1 hour") -> DataFrame:
    """(meter_id, started, ended, n_rows) of a stream of readings, each session once it is closed; ``ended`` is its last reading."""
    keyed = _timed(rows, late).select("meter_id", "reading_timestamp", "micros").groupBy("meter_id")
    closed = keyed.transformWithStateInPandas(Sessions(gap_micros), "meter_id string, started long, ended long, n_rows long", "Append", "EventTime")
    return closed.select("meter_id", F.timestamp_micros("started").alias("started"), F.timestamp_micros("ended").alias("ended"), "n_rows")


def alert_stream(rows: DataFrame, *, threshold: float = 3.0, last: int = 12, silence_micros: int = 24 * HOUR, late: str = "1 hour") -> DataFrame:
    """(meter_id, reading_timestamp, kind, used_liters, score) of a stream of Silver's readings: spikes and silences."""
    keyed = _timed(rows, late).select("meter_id", "reading_timestamp", "micros", F.col("reading_value_liters").alias("liters")).groupBy("meter_id")
    told = keyed.transformWithStateInPandas(Alerts(threshold, last, silence_micros), "meter_id string, micros long, kind string, used_liters double, score double", "Append", "EventTime")
    return told.select("meter_id", F.timestamp_micros("micros").alias("reading_timestamp"), "kind", "used_liters", "score")
