from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lodestream.operators import alerts, histogram, notify, telemetry
from lodestream.operators.alert_state import AlertState, GroupState

T0 = datetime(2024, 1, 1)


def test_histogram_golden(spark):
    df = spark.createDataFrame([(v, "e") for v in (0.01, 0.02, 0.3, 11.0)], "v double, endpoint string")
    rows = {r.le: r.bucket_count for r in histogram.histogram(df, "v", histogram.LATENCY_BOUNDS, ["endpoint"]).collect()}
    assert (rows["0.01"], rows["0.05"], rows["0.5"], rows["10.0"], rows["+Inf"]) == (1, 2, 3, 3, 4)


@pytest.mark.parametrize(
    "values,bounds,q,expected",
    [([0.5] * 4, (1.0, 2.0), 0.5, 0.5), ([0.5, 1.5], (1.0, 2.0), 0.75, 1.5), ([5.0], (1.0, 2.0), 0.5, 2.0),
     ([], (1.0, 2.0), 0.5, None), ([-1.0, 0.0], (0.0, 1.0), 0.5, 0.0)],
)
def test_quantile(spark, values, bounds, q, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    agg = df.agg(*[c.alias(n) for n, c in histogram.bucket_columns(F.col("v"), bounds).items()])
    assert agg.select(histogram.quantile(histogram.bucket_counts(bounds), bounds, q)).first()[0] == expected


def ticks(spark, offsets, hold=300):
    rows = [("A", "e", "x", hold, "critical", T0 + timedelta(seconds=s), float(s)) for s in offsets]
    return spark.createDataFrame(rows, "alertname string, endpoint string, action string, for_seconds bigint, severity string, tick timestamp, value double")


def brute(offsets, hold=300):
    state, out = AlertState(), []
    for s in offsets:
        out += state.tick(s, float(s), hold, 30)
    return sorted(out + state.silent(10**9, 30))


@pytest.mark.parametrize(
    "offsets",
    [range(0, 301, 30), range(0, 300, 30), [0, 30, 90, 120], [*range(0, 400, 30), *range(480, 900, 30)], [0]],
)
def test_sustained(spark, offsets):
    out = alerts.transitions(alerts.episodes(ticks(spark, offsets)))
    sec = lambda t: int((t - T0).total_seconds())
    assert sorted((r.status, sec(r.starts_at), sec(r.changed_at), r.value) for r in out.collect()) == brute(offsets)


def test_group_machine():
    group = GroupState("warning")
    group.change(0, "a", "firing")
    assert group.until(30) == [] and group.until(31) == [(30, "firing", 1, 0)]
    group.change(100, "b", "firing")
    assert group.until(14000) == [(330, "firing", 2, 0)]
    assert group.until(15000) == [(330 + 14400, "repeat", 2, 0)]
    group.change(15000, "a", "resolved")
    group.change(15001, "b", "resolved")
    assert group.until(16000) == [(15030, "resolved", 0, 2)] and group.next_flush is None
    quiet = GroupState("warning")
    quiet.change(0, "a", "firing")
    quiet.change(10, "a", "resolved")
    assert quiet.until(1000) == []


def test_notices(spark):
    changes = alerts.transitions(alerts.episodes(ticks(spark, range(0, 8000, 30))))
    rows = sorted((r.sent_at - 1704067200, r.kind) for r in notify.notices(changes).collect())
    assert rows == [(300, "firing"), (3900, "repeat"), (7500, "repeat"), (8100, "resolved")]


def test_inhibition(spark):
    rows = [("A", "e", "critical"), ("A", "e", "warning"), ("A", "f", "warning"), ("B", "e", "info")]
    df = spark.createDataFrame(rows, "alertname string, endpoint string, severity string")
    assert sorted(tuple(r) for r in alerts.inhibit(df).collect()) == [rows[0], rows[2], rows[3]]


def test_messages(spark):
    schema = "batch_id int, alertname string, severity string, category string, endpoint string, status string, startsAt string, annotations map<string,string>"
    rows = [
        (1, "Down", "critical", "cost", "e", "firing", "2024-01-02T03:04:05.123Z", {"summary": "s", "runbook_url": "u"}),
        (1, "X", "odd", None, None, "resolved", "bad", {}),
        (2, "X", "info", "cost", "e", "resolved", "", {}),
        (2, "Y", "info", "cost", "f", "resolved", "", {}),
    ]
    df = spark.createDataFrame(rows, schema)
    text = {r.alertname + str(r.batch_id): r.message for r in alerts.alert_message(df).collect()}
    assert text["Down1"].startswith("🚨 *FIRING* 🔴 💰\n\n*Alert:* `Down`\n*Endpoint:* `e`")
    assert "\n⏰ *Time:* 2024-01-02 03:04:05 UTC\n" in text["Down1"] and text["Down1"].endswith("\n📖 [Runbook](u)\n")
    assert text["X1"] == "✅ *RESOLVED* ❓ 📊\n\n*Alert:* `X`\n*Endpoint:* `unknown`\n*Severity:* odd\n*Category:* unknown\n"
    sent = {(r.batch_id, r.kind): r.message for r in alerts.delivery_messages(df).collect()}
    assert sent[(1, "resolved")] == text["X1"]
    assert sent[(2, "resolved")] == "✅ *RESOLVED* - 2 alerts\n\n• `X` (e)\n• `Y` (f)\n"


def test_bands(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.9,), (None,)], "v double")
    got = [r[0] for r in df.select(telemetry.banded(F.col("v"), [(0, "red"), (0.5, "yellow"), (0.9, "green")])).collect()]
    assert got == ["red", "yellow", "green", None]


def test_open_silence_is_reported(spark):
    rows = [("a", T0), ("a", T0 + timedelta(days=1)), ("b", T0)]
    found = alerts.absences(spark.createDataFrame(rows, "endpoint string, ts timestamp"))
    got = {(r.endpoint, r.silent_since, r.resolved_at) for r in found.collect()}
    began = T0 + timedelta(seconds=30)
    assert got == {("a", began, T0 + timedelta(days=1)), ("b", began, None)}


def test_alert_rows_fill_placeholders(spark):
    rule = {r[0]: r for r in alerts.RULES}["BiEncoderHighErrorRate"]
    row = (rule[0], "bi-encoder", "embed", "critical", rule[7], rule[8], rule[9], "firing", T0, 0.5)
    schema = "alertname string, endpoint string, action string, severity string, category string, summary string, description string, status string, changed_at timestamp, value double"
    made = alerts.alert_rows(spark.createDataFrame([row, (*row[:6], None, "pending", T0, 0.5), (*row[:6], None, "resolved", T0, 0.5)], schema)).collect()
    assert {r.status: r.annotations for r in made} == {
        "firing": {"summary": rule[8], "description": "Error rate is 0.500000 for endpoint bi-encoder"}, "resolved": {"summary": rule[8]}
    }
