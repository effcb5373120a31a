"""Windowed telemetry over a stream: the batch operators behind a watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

LATE_LIMIT = "168 hours"


def timed(events: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Event time as TIMESTAMP behind a watermark; a repeated event is dropped."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return stamped.dropDuplicatesWithinWatermark(["event_id"]) if "event_id" in events.columns else stamped


def cold_starts(events: DataFrame, forget_after: timedelta = timedelta(days=30)) -> DataFrame:
    """(endpoint, worker_id, ts): the first request of each worker.

    A worker's first time is held until the watermark has passed it, so that an
    earlier request that arrives later still counts. A worker is remembered until it
    has been silent for ``forget_after``; then its next request is a cold start again.
    State is three numbers per worker.
    """
    keep = int(forget_after.total_seconds() * 1000)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, told = state.get if state.exists else (None, None, False)
        if not state.hasTimedOut:
            for batch in batches:
                if len(batch):
                    stamps = batch["ts"].astype("datetime64[us]").astype("int64")
                    first = min(int(stamps.min()), first if first is not None else int(stamps.min())) if not told else first
                    last = max(int(stamps.max()), last if last is not None else int(stamps.max()))
        now = state.getCurrentWatermarkMs()
        out = []
        if not told and first is not None and now * 1000 > first:
            told, out = True, [(*key, pd.Timestamp(first, unit="us"))]
        if told and now >= last // 1000 + keep:
            if state.exists:
                state.remove()
        else:
            state.update((first, last, told))
            state.setTimeoutTimestamp(max((last // 1000 + keep if told else first // 1000) + 1, now + 1))
        yield pd.DataFrame(out, columns=["endpoint", "worker_id", "ts"])

    keyed = events.select("endpoint", "worker_id", "ts").groupBy("endpoint", "worker_id")
    return keyed.applyInPandasWithState(
        update, "endpoint string, worker_id string, ts timestamp", "first bigint, last bigint, told boolean", "append", GroupStateTimeout.EventTimeTimeout
    )


class _FirstRequests(StatefulProcessor):
    """First time of one worker; told once the watermark has passed it, forgotten after a long silence."""

    def __init__(self, keep_ms: int):
        self.keep = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "first bigint, last bigint, told boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = self.seen.get() if self.seen.exists() else None
        stamps = [batch["ts"].astype("datetime64[us]").astype("int64") for batch in rows if len(batch)]
        low, high = min(int(s.min()) for s in stamps), max(int(s.max()) for s in stamps)
        first, last, told = old or (low, high, False)
        new = (first if told else min(first, low), max(last, high), told)
        if new != old:
            self.seen.update(new)
            # Timers are few: one to tell the first time, then one to forget.
            for due in self.handle.listTimers():
                self.handle.deleteTimer(due)
            self.handle.registerTimer(self._due(new))
        return iter(())

    def _due(self, seen: tuple) -> int:
        first, last, told = seen
        return (last // 1000 + self.keep if told else first // 1000) + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, last, told = self.seen.get()
        if told:
            self.seen.clear()
            return
        self.seen.update((first, last, True))
        self.handle.registerTimer(self._due((first, last, True)))
        yield pd.DataFrame({"endpoint": [key[0]], "worker_id": [key[1]], "ts": [pd.Timestamp(first, unit="us")]})

    def close(self) -> None:
        pass


def first_requests(events: DataFrame, forget_after: timedelta = timedelta(days=30)) -> DataFrame:
    """``cold_starts`` with an event time, so that windows can follow in the same stream."""
    keyed = events.select("endpoint", "worker_id", "ts").groupBy("endpoint", "worker_id")
    return keyed.transformWithStateInPandas(
        _FirstRequests(int(forget_after.total_seconds() * 1000)),
        "endpoint string, worker_id string, ts timestamp", "append", "EventTime", eventTimeColumnName="ts",
    )


def run_windows(
    events: DataFrame,
    metric: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append finished windows of any ``operators.telemetry`` metric to parquet.

    A window is written once, when the watermark has passed its end.
    """
    writer = metric(events).writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return writer.option("path", path).trigger(**(trigger or {"availableNow": True})).start()
