"""The two small state machines behind alerts, over plain values.

They are used per key: by the streaming operators with saved state, and by
``notices`` over a finished table of transitions. Times are epoch seconds.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class AlertState:
    """Pending → firing → resolved of one alert instance."""

    since: int | None = None
    last: int | None = None
    value: float = 0.0
    fired: bool = False

    def resolve(self, at: int) -> list[tuple[str, int, int, float]]:
        out = [("resolved", self.since, at, self.value)] if self.fired else []
        self.since, self.last, self.fired = None, None, False
        return out

    def tick(self, at: int, value: float, hold: int, gap: int) -> list[tuple[str, int, int, float]]:
        """Changes (status, starts_at, at, value) caused by a true tick.

        A hole of more than ``gap`` seconds since the last true tick means the
        condition was false in between.
        """
        out = []
        if self.since is not None and at - self.last > gap:
            out += self.resolve(self.last + gap)
        if self.since is None:
            self.since = at
            out.append(("pending", at, at, value))
        self.last, self.value = at, value
        if not self.fired and at - self.since >= hold:
            self.fired = True
            out.append(("firing", self.since, at, value))
        return out

    def silent(self, now: int, gap: int) -> list[tuple[str, int, int, float]]:
        """Changes once time has passed the last true tick by ``gap``."""
        if self.since is not None and now > self.last + gap:
            return self.resolve(self.last + gap)
        return []


# Fixed delivery settings, in seconds.
GROUP_WAIT = {"critical": 0, "warning": 30}
DEFAULT_GROUP_WAIT = 10
REPEAT = {"critical": 3600, "warning": 4 * 3600, "info": 24 * 3600}
DEFAULT_REPEAT = 4 * 3600
GROUP_INTERVAL = 300


@dataclass
class GroupState:
    """Notices of one group (alertname, severity, endpoint)."""

    severity: str
    active: dict[str, bool] = field(default_factory=dict)  # member → firing
    notified: list[str] = field(default_factory=list)
    next_flush: int | None = None
    last_sent: int | None = None

    def change(self, at: int, member: str, status: str) -> None:
        if status == "firing":
            self.active[member] = True
            if self.next_flush is None:
                self.next_flush = at + GROUP_WAIT.get(self.severity, DEFAULT_GROUP_WAIT)
        elif member in self.active:
            self.active[member] = False

    def _flush(self, at: int) -> list[tuple[int, str, int, int]]:
        firing = sorted(m for m, on in self.active.items() if on)
        resolved = [m for m, on in self.active.items() if not on and m in self.notified]
        kind = None
        if set(firing) - set(self.notified):
            kind = "firing"
        elif resolved:
            kind = "firing" if firing else "resolved"
        elif firing and at - self.last_sent >= REPEAT.get(self.severity, DEFAULT_REPEAT):
            kind = "repeat"
        self.active = dict.fromkeys(firing, True)
        self.next_flush = at + GROUP_INTERVAL if firing else None
        if kind is None:
            return []
        self.notified, self.last_sent = firing, at
        return [(at, kind, len(firing), len(resolved))]

    def until(self, now: int, inclusive: bool = False) -> list[tuple[int, str, int, int]]:
        """Notices (sent_at, kind, firing, resolved) due before ``now``."""
        out = []
        while self.next_flush is not None and (self.next_flush < now or (inclusive and self.next_flush == now)):
            out += self._flush(self.next_flush)
        return out
