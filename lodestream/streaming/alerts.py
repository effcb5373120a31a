"""Alerts over a stream of true ticks, and notices over a stream of changes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState as SparkState
from pyspark.sql.streaming.state import GroupStateTimeout

from lodestream.operators import alerts
from lodestream.operators.alert_state import AlertState, GroupState
from lodestream.operators.notify import GROUP_KEYS, NOTICE_SCHEMA
from lodestream.streaming import telemetry

_CHANGE = (
    "alertname string, severity string, endpoint string, action string, status string, "
    "starts_at timestamp, changed_at timestamp, value double"
)
_ALERT_STATE = "since bigint, last bigint, value double, fired boolean, ticks array<bigint>, values array<double>"
_GROUP_STATE = "severity string, active map<string,boolean>, notified array<string>, next_flush bigint, last_sent bigint"


def _seconds(stamps: pd.Series) -> list[int]:
    return [int(t.timestamp()) for t in stamps]


_CHANGE_COLUMNS = ["alertname", "severity", "endpoint", "action", "status", "starts_at", "changed_at", "value"]


def _change_rows(alertname: str, severity: str, endpoint: str, action: str, changes: list[tuple]) -> pd.DataFrame:
    stamp = lambda seconds: pd.Timestamp(seconds, unit="s")
    rows = [(alertname, severity, endpoint, action, status, stamp(since), stamp(at), value) for status, since, at, value in changes]
    return pd.DataFrame(rows, columns=_CHANGE_COLUMNS)


def _follow_alert(saved: tuple | None, arrived: list[tuple[int, float]], now_ms: int, hold: int, gap: int) -> tuple[list[tuple], tuple | None, int]:
    """Changes (status, starts_at, at, value) of one alert, its new state and when to wake it (seconds).

    Arrived ticks wait in the state until the watermark has passed them and are then
    taken in order of time; of equal ticks the greatest value counts.
    """
    machine, waiting = AlertState(), {}
    if saved:
        *numbers, ticks, values = saved
        machine, waiting = AlertState(*numbers), dict(zip(ticks, values))
    for at, value in arrived:
        waiting[at] = max(waiting.get(at, value), value)
    changes = []
    for at in sorted(t for t in waiting if t * 1000 <= now_ms):
        value = waiting.pop(at)
        if machine.last is None or at > machine.last:
            changes += machine.tick(at, value, hold, gap)
    changes += machine.silent(now_ms // 1000, gap)
    if machine.since is None and not waiting:
        return changes, None, 0
    ticks = sorted(waiting)
    due = ticks[:1] + ([machine.last + gap] if machine.since is not None else [])
    return changes, (machine.since, machine.last, machine.value, machine.fired, ticks, [waiting[t] for t in ticks]), min(due)


def _arrivals(batches: Iterator[pd.DataFrame]) -> list[tuple[int, float]]:
    return [pair for batch in batches for pair in zip(_seconds(batch["tick"]), map(float, batch["value"]))]


def _follow_silence(starts: list[int], quiet_since: int | None, fired: bool, now_ms: int, limit: int, tick: int) -> tuple[list[tuple], int | None, bool]:
    """Changes (status, silent_since, at) of one endpoint, and its new state.

    ``starts`` are the ticks in which it had events; a silence that has lasted the
    limit by ``now_ms`` fires without waiting for the next event.
    """
    out = []
    for at in sorted(starts):
        if quiet_since is not None and at >= quiet_since:
            if not fired and at - quiet_since >= limit:
                out.append(("firing", quiet_since, quiet_since + limit))
                fired = True
            if fired:
                out.append(("resolved", quiet_since, at))
                fired = False
        quiet_since = at + tick if quiet_since is None else max(quiet_since, at + tick)
    if not fired and quiet_since is not None and now_ms > (quiet_since + limit) * 1000:
        out.append(("firing", quiet_since, quiet_since + limit))
        fired = True
    return out, quiet_since, fired


def alert_changes(true_ticks: DataFrame, tick_seconds: int = 30, silence_seconds: int | None = None, delay: str = "1 minute") -> DataFrame:
    """Changes of every alert instance, from rows (alertname, severity,
    endpoint, action, for_seconds, tick, value) at which its rule holds.

    Ticks may arrive in any order: they wait in the state until the watermark
    has passed them and are then taken in order of time, the greatest value of a
    tick counts. An instance without a true tick for ``silence_seconds`` (one tick unless
    given) is resolved, also when nothing more arrives for it: the event-time
    timeout wakes it up. State is four numbers per instance and the ticks the
    watermark has not passed.
    """
    gap = silence_seconds or tick_seconds

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: SparkState) -> Iterator[pd.DataFrame]:
        *names, hold = key
        arrived, now = [] if state.hasTimedOut else _arrivals(batches), state.getCurrentWatermarkMs()
        changes, saved, due = _follow_alert(state.get if state.exists else None, arrived, now, int(hold), gap)
        if saved:
            state.update(saved)
            state.setTimeoutTimestamp(max(due * 1000 + 1, now + 1))
        elif state.exists:
            state.remove()
        yield _change_rows(*names, changes)

    keyed = true_ticks.withWatermark("tick", delay).groupBy("alertname", "severity", "endpoint", "action", "for_seconds")
    return keyed.applyInPandasWithState(update, _CHANGE, _ALERT_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def absence_changes(events: DataFrame, limit_seconds: int = 120, tick_seconds: int = 30, delay: str = "1 minute") -> DataFrame:
    """An endpoint silent for the limit fires; its next event resolves it.

    ``events`` (endpoint, ts) carry no watermark yet: time runs in ticks here,
    so one row per endpoint and tick reaches the keyed step.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: SparkState) -> Iterator[pd.DataFrame]:
        starts = [] if state.hasTimedOut else [t for rows in batches for t in _seconds(rows["ts"])]
        saved = state.get if state.exists else (None, False)
        out, quiet_since, fired = _follow_silence(starts, *saved, state.getCurrentWatermarkMs(), limit_seconds, tick_seconds)
        state.update((quiet_since, fired))
        if not fired:
            state.setTimeoutTimestamp(max((quiet_since + limit_seconds) * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(
            [(key[0], status, pd.Timestamp(since, unit="s"), pd.Timestamp(at, unit="s")) for status, since, at in out],
            columns=["endpoint", "status", "silent_since", "changed_at"],
        )

    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    ticks = events.select("endpoint", F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(tick_seconds))).alias("ts"))
    thin = ticks.withWatermark("ts", delay).dropDuplicates(["endpoint", "ts"])
    return thin.groupBy("endpoint").applyInPandasWithState(
        update,
        "endpoint string, status string, silent_since timestamp, changed_at timestamp",
        "quiet_since bigint, fired boolean",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


class _LiveAlerts(StatefulProcessor):
    """State of one alert, or of the silence of one endpoint where the key has a limit."""

    def __init__(self, tick_seconds: int, gap: int):
        self.tick, self.gap = tick_seconds, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.saved = handle.getValueState("saved", _ALERT_STATE)

    def _wake(self, due_ms: int) -> None:
        """One timer an instance, independent of what arrives."""
        known = list(self.handle.listTimers())
        for old in known:
            if old != due_ms:
                self.handle.deleteTimer(old)
        if due_ms not in known:
            self.handle.registerTimer(due_ms)

    def _step(self, key: tuple, arrived: list[tuple[int, float]], now: int) -> Iterator[pd.DataFrame]:
        *names, hold, limit = key
        saved = self.saved.get() if self.saved.exists() else None
        if limit < 0:
            changes, saved, due = _follow_alert(saved, arrived, now, int(hold), self.gap)
            wake = due * 1000 + 1 if saved else None
        else:
            limit = int(limit)
            quiet_since, fired = (saved[0], saved[3]) if saved else (None, False)
            out, quiet_since, fired = _follow_silence([at for at, _ in arrived], quiet_since, fired, now, limit, self.tick)
            changes, saved = [], (quiet_since, None, None, fired, [], [])
            for status, since, at in out:
                both = ("pending", "firing") if status == "firing" else (status,)
                changes += [(each, since + limit, at, float(at - since)) for each in both]
            wake = None if fired else (quiet_since + limit) * 1000 + 1
        if saved:
            self.saved.update(saved)
        else:
            self.saved.clear()
        if wake is not None:
            self._wake(max(wake, now + 1))
        if changes:
            yield _change_rows(*names, changes)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        return self._step(key, _arrivals(rows), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._step(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def live_changes(events: DataFrame, rules: DataFrame, tick_seconds: int = 30, silence_seconds: int | None = None) -> DataFrame:
    """Changes of all alerts straight from request events, in one stream of chained stateful steps.

    ``events`` carry a watermark on ``ts`` (see ``telemetry.timed``). They are counted
    into steps, steps are added to windows (``metric_ticks``, with first requests of
    workers from keyed state), closed windows meet the rules, and what holds goes to
    the state of its alert. Rules on silence see the closed steps in which their endpoint
    had events. The rows equal ``operators.alerts.all_changes`` as far as the watermark
    has come; limits on silence are whole ticks. State is in RocksDB (``streaming.session.state_settings``).
    """
    columns = ("alertname", "severity", "endpoint", "action", "for_seconds", "tick", "value")
    ticks = alerts.metric_ticks(events, starts=telemetry.first_requests(events))
    held = alerts.met(ticks, rules).select("at", *columns, F.lit(-1).cast("bigint").alias("limit"))
    steps = events.groupBy(F.window("ts", f"{tick_seconds} seconds").alias("w"), "endpoint").agg(F.count("*").alias("n"))
    silent = F.broadcast(rules.where(F.col("metric") == "silent_seconds").withColumn("limit", F.col("threshold").cast("bigint")))
    active = steps.select(F.window_time("w").alias("at"), F.col("w.start").alias("tick"), "endpoint").join(silent, "endpoint")
    active = active.withColumns({"action": F.lit(""), "value": F.lit(0.0)}).select("at", *columns, "limit")
    keyed = held.unionByName(active).groupBy("alertname", "severity", "endpoint", "action", "for_seconds", "limit")
    return keyed.transformWithStateInPandas(_LiveAlerts(tick_seconds, silence_seconds or tick_seconds), _CHANGE, "append", "EventTime")


def notice_stream(changes: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Notices due for each (alertname, severity, endpoint) as time passes.

    Changes are held back until the watermark has passed them by the group's
    own timeout, so repeats go out without new input for the group.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: SparkState) -> Iterator[pd.DataFrame]:
        machine = GroupState(key[1] or "")
        if state.exists:
            severity, active, notified, next_flush, last_sent = state.get
            machine = GroupState(severity, dict(active), list(notified), next_flush, last_sent)
        sent = []
        if state.hasTimedOut:
            sent += machine.until(state.getCurrentWatermarkMs() // 1000)
        else:
            rows = pd.concat([b for b in batches if len(b)])
            for at, member, status in sorted(zip(_seconds(rows["changed_at"]), rows["action"], rows["status"])):
                sent += machine.until(at)
                machine.change(at, member, status)
        if machine.next_flush is None:
            if state.exists:
                state.remove()
        else:
            saved = asdict(machine)
            state.update(tuple(saved[c] for c in ("severity", "active", "notified", "next_flush", "last_sent")))
            state.setTimeoutTimestamp(max(machine.next_flush * 1000 + 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(
            [(*key, *notice) for notice in sent],
            columns=["alertname", "severity", "endpoint", "sent_at", "kind", "firing", "resolved"],
        )

    ready = changes.where(F.col("status").isin("firing", "resolved")).withWatermark("changed_at", delay)
    return ready.groupBy(*GROUP_KEYS).applyInPandasWithState(
        update, NOTICE_SCHEMA, _GROUP_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
