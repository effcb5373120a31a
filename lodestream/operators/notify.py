"""Notices to send for alert transitions: grouping, waiting, repeating."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.operators.alert_state import GROUP_INTERVAL, GroupState

GROUP_KEYS = ("alertname", "severity", "endpoint")
NOTICE_SCHEMA = (
    "alertname string, severity string, endpoint string, sent_at bigint, kind string, firing int, resolved int"
)


def replay(state: GroupState, changes: list[tuple[int, str, str]]) -> list[tuple[int, str, int, int]]:
    """Feed (at, member, status) in time order; notices due in between come out."""
    out = []
    for at, member, status in sorted(changes):
        out += state.until(at)
        state.change(at, member, status)
    return out


def notices(transitions: DataFrame) -> DataFrame:
    """All notices of a finished table of transitions.

    A group sees state changes only, a handful per incident, never events.
    """

    def per_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        alertname, severity, endpoint = key
        state = GroupState(severity or "")
        sent = replay(state, list(zip(rows["at_s"], rows["action"], rows["status"])))
        sent += state.until(int(rows["at_s"].max()) + GROUP_INTERVAL, inclusive=True)
        return pd.DataFrame(
            [(alertname, severity, endpoint, *notice) for notice in sent],
            columns=["alertname", "severity", "endpoint", "sent_at", "kind", "firing", "resolved"],
        )

    changes = transitions.where(F.col("status").isin("firing", "resolved")).select(
        *GROUP_KEYS, F.coalesce("action", F.lit("")).alias("action"), "status",
        F.unix_seconds(F.col("changed_at").cast("timestamp")).alias("at_s"),
    )
    return changes.groupBy(*GROUP_KEYS).applyInPandas(per_group, NOTICE_SCHEMA)
