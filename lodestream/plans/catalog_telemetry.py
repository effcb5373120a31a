"""Checked queries: request telemetry, alerts, messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.operators import alerts, notify, rerank, telemetry
from lodestream.operators import histogram as hist
from lodestream.plans import views
from lodestream.plans.registry import query

_E = f"e AS ({views.REQUEST_EVENTS_SQL})"


def _windows(steps: int, source: str = "e") -> str:
    """Every event in each sliding window that holds it, straight from rows."""
    return (
        f"w AS (SELECT *, time_bucket(INTERVAL '30 seconds', ts) - i * INTERVAL 30 SECOND AS window_start, "
        f"time_bucket(INTERVAL '30 seconds', ts) - i * INTERVAL 30 SECOND + {steps} * INTERVAL 30 SECOND AS window_end "
        f"FROM {source}, range(0, {steps}) t(i))"
    )


# --- counters, gauges, histograms -------------------------------------------------


@query("request_counts", f"WITH {_E} SELECT endpoint, action, status, count(*) AS requests FROM e GROUP BY ALL")
def request_counts(spark, sf):
    """A26."""
    return telemetry.request_counts(views.request_events(spark, sf))


def _histogram_sql(value: str, bounds, by: str) -> str:
    labels = hist.bucket_labels(bounds)
    rows = ", ".join(f"('{label}', {label.replace('+Inf', chr(39) + 'inf' + chr(39))}::DOUBLE)" for label in labels)
    return f"""
    WITH {_E}, b(le, bound) AS (VALUES {rows}),
    t AS (SELECT {by}, round(sum({value}), 6) AS total_sum, count(*) AS total_count FROM e GROUP BY ALL)
    SELECT t.*, le, (SELECT count(*) FROM e WHERE {" AND ".join(f"e.{c.strip()} = t.{c.strip()}" for c in by.split(","))}
      AND e.{value} <= bound) AS bucket_count FROM t, b
    """


def _rounded(rows):
    return rows.withColumn("total_sum", F.round(F.col("total_sum").cast("double"), 6))


@query("latency_histogram", _histogram_sql("duration_s", hist.LATENCY_BOUNDS, "endpoint, action"))
def latency_histogram(spark, sf):
    """A27."""
    return _rounded(hist.histogram(views.request_events(spark, sf), "duration_s", hist.LATENCY_BOUNDS, ["endpoint", "action"]))


@query("inference_histogram", _histogram_sql("inference_s", hist.INFERENCE_BOUNDS, "endpoint, action"))
def inference_histogram(spark, sf):
    """A27."""
    return _rounded(hist.histogram(views.request_events(spark, sf), "inference_s", hist.INFERENCE_BOUNDS, ["endpoint", "action"]))


@query("batch_size_histogram", _histogram_sql("batch_size", hist.BATCH_SIZE_BOUNDS, "endpoint").replace("round(sum(batch_size), 6)", "CAST(sum(batch_size) AS DOUBLE)"))
def batch_size_histogram(spark, sf):
    """A27."""
    return _rounded(hist.histogram(views.request_events(spark, sf), "batch_size", hist.BATCH_SIZE_BOUNDS, ["endpoint"]))


@query(
    "score_histogram",
    _histogram_sql("score", hist.SCORE_BOUNDS, "endpoint").replace(
        _E, f"e0 AS ({views.REQUEST_EVENTS_SQL}), e AS (SELECT endpoint, unnest([score, score / 2]) AS score FROM e0)"
    ),
)
def score_histogram(spark, sf):
    """Two scores per request."""
    events = views.request_events(spark, sf).withColumn("scores", F.array("score", F.col("score") / 2)).drop("score")
    return _rounded(hist.histogram(telemetry.score_observations(events), "score", hist.SCORE_BOUNDS, ["endpoint"]))


def _quantile_sql(name: str, q: float, bounds) -> str:
    edges = "([" + ", ".join(str(b) for b in bounds) + "]::DOUBLE[])"
    m = len(bounds)
    j = f"list_position(list_transform(c, lambda x: x >= {q} * n), true)"
    below = f"CASE WHEN {j} = 1 THEN 0 ELSE c[{j} - 1] END"
    lower = f"CASE WHEN {j} = 1 THEN 0 ELSE {edges}[{j} - 1] END"
    return (
        f"round(CASE WHEN n = 0 THEN NULL WHEN {j} > {m} THEN {float(bounds[-1])} ELSE {lower} + ({edges}[{j}] - {lower}) * "
        f"({q} * n - {below}) / (c[{j}] - {below}) END, 9) AS {name}"
    )


def _bucket_list(value: str, bounds) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {value} <= {b})" for b in bounds)
    return f"[{counts}, count(*)]::DOUBLE[] AS c, CAST(count(*) AS DOUBLE) AS n"


_P = [("p50", 0.5), ("p95", 0.95), ("p99", 0.99)]


@query(
    "latency_quantiles",
    f"""
    WITH {_E}, g AS (SELECT endpoint, action, {_bucket_list("duration_s", hist.LATENCY_BOUNDS)} FROM e GROUP BY ALL)
    SELECT endpoint, action, {", ".join(_quantile_sql(n, q, hist.LATENCY_BOUNDS) for n, q in _P)} FROM g
    """,
)
def latency_quantiles(spark, sf):
    """A30 over all events."""
    counted = views.request_events(spark, sf).groupBy("endpoint", "action").agg(
        *[c.alias(n) for n, c in hist.bucket_columns(F.col("duration_s"), hist.LATENCY_BOUNDS).items()]
    )
    counts = hist.bucket_counts(hist.LATENCY_BOUNDS)
    return counted.select(
        "endpoint", "action", *[F.round(hist.quantile(counts, hist.LATENCY_BOUNDS, q), 9).alias(n) for n, q in _P]
    )


@query("latency_percentiles")
def latency_percentiles(spark, sf):
    """A30, from raw events by a mergeable sketch (approximate, so no SQL)."""
    return telemetry.exact_quantiles(views.request_events(spark, sf), ["endpoint", "action"])


@query(
    "gauge_last",
    f"""
    WITH {_E} SELECT endpoint, arg_max(dimension, event_id) AS last_dimension, round(arg_max(score / 2, event_id), 6) AS last_score_min,
      round(arg_max(score, event_id), 6) AS last_score_max, round(arg_max(cost, event_id), 9) AS last_cost FROM e GROUP BY endpoint
    """,
)
def gauge_last(spark, sf):
    """A28."""
    events = views.request_events(spark, sf).withColumn("scores", F.array("score", F.col("score") / 2))
    last = telemetry.last_values(telemetry.with_score_range(events))
    return last.select(
        "endpoint", "last_dimension", F.round("last_score_min", 6).alias("last_score_min"),
        F.round("last_score_max", 6).alias("last_score_max"), F.round("last_cost", 9).alias("last_cost"),
    )


@query(
    "cost_per_1k",
    f"""
    WITH {_E} SELECT endpoint, round(sum(cost) / count(*), 9) AS cost_per_request, round(1000 * sum(cost) / count(*), 6) AS cost_per_1k
    FROM e GROUP BY endpoint
    """,
)
def cost_per_1k(spark, sf):
    """A29."""
    rows = telemetry.cost_summary(views.request_events(spark, sf))
    return rows.select("endpoint", F.round("cost_per_request", 9).alias("cost_per_request"), F.round("cost_per_1k", 6).alias("cost_per_1k"))


@query(
    "cold_starts",
    f"""
    WITH {_E} SELECT endpoint, worker_id, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY endpoint, worker_id ORDER BY ts) AS r FROM e) WHERE r = 1
    """,
)
def cold_starts(spark, sf):
    """W5."""
    return telemetry.cold_starts(views.request_events(spark, sf))


@query(
    "status_bands",
    f"""
    WITH {_E} SELECT endpoint, action, round(count(*) FILTER (WHERE status = 'error') / count(*), 6) AS error_rate,
      CASE WHEN count(*) FILTER (WHERE status = 'error') / count(*) >= 0.20 THEN 'red'
           WHEN count(*) FILTER (WHERE status = 'error') / count(*) >= 0.19 THEN 'yellow' ELSE 'green' END AS band
    FROM e GROUP BY endpoint, action
    """,
)
def status_bands(spark, sf):
    """P17, R3."""
    rate = F.count_if(F.col("status") == "error") / F.count("*")
    rows = views.request_events(spark, sf).groupBy("endpoint", "action").agg(rate.alias("error_rate"))
    band = telemetry.banded(F.col("error_rate"), [(0.0, "green"), (0.19, "yellow"), (0.20, "red")])
    return rows.select("endpoint", "action", F.round("error_rate", 6).alias("error_rate"), band.alias("band"))


@query(
    "call_outcomes",
    f"""
    WITH {_E} SELECT event_id, status, round(duration_s, 6) AS duration_s FROM e
    """,
)
def call_outcomes(spark, sf):
    """Status, duration and error of every handled call."""
    calls = views.request_events(spark, sf).select(
        "event_id",
        F.when(F.col("status") == "error", "failed").alias("error"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("duration_s") * 1e6).cast("bigint")).alias("finished_at"),
    )
    return rerank.call_outcome(calls).select("event_id", "status", F.round("duration_s", 6).alias("duration_s"))


# --- sliding windows -----------------------------------------------------------------


@query(
    "request_rate_1m",
    f"""
    WITH {_E}, {_windows(2)} SELECT window_start, window_end, endpoint, action, status, round(count(*) / 60.0::DOUBLE, 6) AS rate
    FROM w GROUP BY ALL
    """,
)
def request_rate_1m(spark, sf):
    """R1."""
    return telemetry.request_rate(views.request_events(spark, sf)).withColumn("rate", F.round("rate", 6))


@query(
    "success_rate_5m",
    f"""
    WITH {_E}, {_windows(10)} SELECT window_start, window_end, endpoint, action,
      round(count(*) FILTER (WHERE status = 'success') / count(*), 6) AS success_rate,
      round(count(*) FILTER (WHERE status <> 'success') / count(*), 6) AS error_rate FROM w GROUP BY ALL
    """,
)
def success_rate_5m(spark, sf):
    """R2, R3, J7."""
    rows = telemetry.success_rate(views.request_events(spark, sf))
    return rows.withColumns({c: F.round(c, 6) for c in ("success_rate", "error_rate")})


@query(
    "avg_latency_5m",
    f"""
    WITH {_E}, {_windows(10)} SELECT window_start, window_end, endpoint, action, round(avg(duration_s), 9) AS avg_latency
    FROM w GROUP BY ALL
    """,
)
def avg_latency_5m(spark, sf):
    """R4, A31."""
    return telemetry.average_latency(views.request_events(spark, sf)).withColumn("avg_latency", F.round("avg_latency", 9))


@query(
    "latency_quantiles_5m",
    f"""
    WITH {_E}, {_windows(10)},
    g AS (SELECT window_start, window_end, endpoint, action, {_bucket_list("duration_s", hist.LATENCY_BOUNDS)} FROM w GROUP BY ALL)
    SELECT window_start, window_end, endpoint, action, {", ".join(_quantile_sql(n, q, hist.LATENCY_BOUNDS) for n, q in _P)} FROM g
    """,
)
def latency_quantiles_5m(spark, sf):
    """R5."""
    rows = telemetry.latency_quantiles(views.request_events(spark, sf))
    return rows.withColumns({n: F.round(n, 9) for n, _ in _P})


@query(
    "cold_starts_1h",
    f"""
    WITH {_E}, c AS (SELECT endpoint, worker_id, min(ts) AS ts FROM e GROUP BY ALL), {_windows(120, "c")}
    SELECT window_start, window_end, endpoint, count(*) AS increase, round(count(*) / 3600.0::DOUBLE, 9) AS rate FROM w GROUP BY ALL
    """,
)
def cold_starts_1h(spark, sf):
    """R6."""
    rows = telemetry.cold_start_rate(telemetry.cold_starts(views.request_events(spark, sf)))
    return rows.withColumn("rate", F.round("rate", 9))


def _bucket_rate_sql(value: str, bounds) -> str:
    rows = ", ".join(
        f"('{label}', {label.replace('+Inf', chr(39) + 'inf' + chr(39))}::DOUBLE)" for label in hist.bucket_labels(bounds)
    )
    return f"""
    WITH {_E}, b(le, bound) AS (VALUES {rows}), w AS (SELECT *, time_bucket(INTERVAL '5 minutes', ts) AS window_start FROM e)
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, endpoint, le,
      round(count(*) FILTER (WHERE {value} <= bound) / 300.0::DOUBLE, 6) AS rate
    FROM w, b GROUP BY ALL
    """


@query("batch_size_rates_5m", _bucket_rate_sql("batch_size", hist.BATCH_SIZE_BOUNDS))
def batch_size_rates_5m(spark, sf):
    """R7, drawn every five minutes."""
    rows = telemetry.bucket_rates(views.request_events(spark, sf), "batch_size", hist.BATCH_SIZE_BOUNDS, step="5 minutes")
    return rows.withColumn("rate", F.round("rate", 6))


@query("score_heatmap_5m", _bucket_rate_sql("score", hist.SCORE_BOUNDS))
def score_heatmap_5m(spark, sf):
    """R7, drawn every five minutes."""
    rows = telemetry.bucket_rates(views.request_events(spark, sf), "score", hist.SCORE_BOUNDS, step="5 minutes")
    return rows.withColumn("rate", F.round("rate", 6))


@query(
    "inference_load_5m",
    f"""
    WITH {_E}, r AS (SELECT * FROM e WHERE action = 'rerank'), {_windows(10, "r")}
    SELECT window_start, window_end, endpoint, round(sum(inference_s) / 300.0::DOUBLE, 6) AS inference_load FROM w GROUP BY ALL
    """,
)
def inference_load_5m(spark, sf):
    """R8."""
    return telemetry.inference_load(views.request_events(spark, sf)).withColumn("inference_load", F.round("inference_load", 6))


@query(
    "score_spread_5m",
    f"""
    WITH {_E}, {_windows(10)} SELECT window_start, window_end, endpoint, round(stddev_pop(score), 6) AS score_stddev FROM w GROUP BY ALL
    """,
)
def score_spread_5m(spark, sf):
    """A32."""
    return telemetry.score_spread(views.request_events(spark, sf)).withColumn("score_stddev", F.round("score_stddev", 6))


@query(
    "late_events",
    "SELECT event_id, ts FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 168 HOURS",
)
def late_events(spark, sf):
    """Events that would be rejected at the time of the newest one."""
    events = views.request_events(spark, sf)
    newest = events.agg(F.max("ts")).scalar()
    return telemetry.late_split(events, newest)[1].select("event_id", "ts")


# --- alerts --------------------------------------------------------------------------

# Written out here, so that the operator's own table is checked too.
_RULES = """rules(alertname, endpoint, metric, op, threshold, for_seconds, severity, category) AS (VALUES
    ('BiEncoderHighErrorRate', 'bi-encoder', 'error_rate', '>', 0.01, 300, 'critical', 'reliability'),
    ('BiEncoderHighLatency', 'bi-encoder', 'latency_p95', '>', 0.1, 300, 'warning', 'performance'),
    ('BiEncoderSlowInference', 'bi-encoder', 'inference_mean', '>', 0.05, 300, 'warning', 'performance'),
    ('BiEncoderInvalidDimension', 'bi-encoder', 'dimension', '!=', 768, 60, 'critical', 'model_quality'),
    ('BiEncoderFrequentRestarts', 'bi-encoder', 'cold_start_rate', '>', 0.1, 600, 'warning', 'operability'),
    ('BiEncoderHighCost', 'bi-encoder', 'cost_per_1k', '>', 0.1, 3600, 'info', 'cost'),
    ('CrossEncoderHighErrorRate', 'cross-encoder', 'error_rate', '>', 0.01, 300, 'critical', 'reliability'),
    ('CrossEncoderHighLatency', 'cross-encoder', 'latency_p95', '>', 0.3, 300, 'warning', 'performance'),
    ('CrossEncoderInvalidScores', 'cross-encoder', 'score_min', '<', 0, 60, 'critical', 'model_quality'),
    ('CrossEncoderInvalidScores', 'cross-encoder', 'score_max', '>', 1, 60, 'critical', 'model_quality'),
    ('CrossEncoderScoreDistribution', 'cross-encoder', 'score_stddev', '<', 0.05, 900, 'warning', 'model_quality'))"""
_SCORED = f"e AS ({views.SCORED_EVENTS_SQL})"
_CONDITIONS = f"""
    {_SCORED}, {_windows(10)}, {_RULES},
    pa AS (SELECT window_end AS tick, endpoint, action, count(*) FILTER (WHERE status <> 'success') / count(*) AS error_rate,
             {_bucket_list("duration_s", hist.LATENCY_BOUNDS)} FROM w GROUP BY ALL),
    pq AS (SELECT *, {_quantile_sql("latency_p95", 0.95, hist.LATENCY_BOUNDS)} FROM pa),
    pe AS (SELECT window_end AS tick, endpoint, '' AS action, avg(inference_s) AS inference_mean, 1000 * sum(cost) / count(*) AS cost_per_1k,
             CAST(arg_max(dimension, event_id) AS DOUBLE) AS dimension, arg_max(least(s1, s2), event_id) AS score_min,
             arg_max(greatest(s1, s2), event_id) AS score_max,
             sqrt(greatest((sum(s1 * s1) + sum(s2 * s2)) / (2 * count(*)) - ((sum(s1) + sum(s2)) / (2 * count(*))) ** 2, 0)) AS score_stddev
           FROM w GROUP BY ALL),
    cs AS (SELECT endpoint, worker_id, min(ts) AS ts FROM e GROUP BY ALL),
    cw AS (SELECT time_bucket(INTERVAL '30 seconds', ts) + (120 - i) * INTERVAL 30 SECOND AS tick, endpoint, '' AS action,
             count(*) / 3600.0 AS cold_start_rate FROM cs, range(0, 120) t(i) GROUP BY ALL),
    m AS (SELECT tick, endpoint, action, 'error_rate' AS metric, error_rate AS value FROM pq
      UNION ALL SELECT tick, endpoint, action, 'latency_p95', latency_p95 FROM pq
      UNION ALL SELECT tick, endpoint, action, 'inference_mean', inference_mean FROM pe
      UNION ALL SELECT tick, endpoint, action, 'cost_per_1k', cost_per_1k FROM pe
      UNION ALL SELECT tick, endpoint, action, 'dimension', dimension FROM pe
      UNION ALL SELECT tick, endpoint, action, 'score_min', score_min FROM pe
      UNION ALL SELECT tick, endpoint, action, 'score_max', score_max FROM pe
      UNION ALL SELECT tick, endpoint, action, 'score_stddev', score_stddev FROM pe
      UNION ALL SELECT tick, endpoint, action, 'cold_start_rate', cold_start_rate FROM cw),
    cond AS (SELECT alertname, m.endpoint, action, tick, for_seconds, severity, category, max(value) AS value FROM m
      JOIN rules r ON r.endpoint = m.endpoint AND r.metric = m.metric
      WHERE CASE op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold WHEN '!=' THEN value <> threshold END GROUP BY ALL)
"""


def changes_sql(known: str = "true", gap: int = 30) -> str:
    """CTEs up to ``tr``: the changes of the runs of true ticks, from the ticks that are ``known``."""
    return f"""
    {_CONDITIONS},
    marked AS (SELECT *, CASE WHEN tick - lag(tick) OVER k <= INTERVAL {gap} SECOND THEN 0 ELSE 1 END AS starts FROM cond WHERE {known}
               WINDOW k AS (PARTITION BY alertname, endpoint, action ORDER BY tick)),
    runs AS (SELECT *, sum(starts) OVER (PARTITION BY alertname, endpoint, action ORDER BY tick) AS run FROM marked),
    begun AS (SELECT *, min(tick) OVER (PARTITION BY alertname, endpoint, action, run) AS started FROM runs),
    ep AS (SELECT alertname, endpoint, action, severity, started, max(tick) AS last_true, arg_max(value, tick) AS last_value,
             arg_min(value, tick) AS start_value, min(tick) FILTER (WHERE tick >= started + for_seconds * INTERVAL 1 SECOND) AS fired,
             arg_min(value, tick) FILTER (WHERE tick >= started + for_seconds * INTERVAL 1 SECOND) AS fire_value
           FROM begun GROUP BY alertname, endpoint, action, severity, run, started),
    tr AS (SELECT alertname, endpoint, action, severity, 'pending' AS status, started AS starts_at, started AS changed_at, start_value AS value FROM ep
      UNION ALL SELECT alertname, endpoint, action, severity, 'firing', started, fired, fire_value FROM ep WHERE fired IS NOT NULL
      UNION ALL SELECT alertname, endpoint, action, severity, 'resolved', started, last_true + INTERVAL {gap} SECOND, last_value FROM ep
        WHERE fired IS NOT NULL)
"""


# The bi-encoder is down once it has been silent for two minutes.
DOWN_SQL = """
    quiet AS (SELECT s + INTERVAL 30 SECOND AS since, lead(s) OVER (ORDER BY s) AS resolved_at
              FROM (SELECT DISTINCT time_bucket(INTERVAL '30 seconds', ts) AS s FROM e WHERE endpoint = 'bi-encoder')),
    down AS (SELECT *, since + INTERVAL 120 SECOND AS fired_at FROM quiet
             WHERE epoch(coalesce(resolved_at, (SELECT max(ts) FROM e)))::BIGINT - epoch(since)::BIGINT >= 120),
    dn AS (SELECT 'BiEncoderDown' AS alertname, 'bi-encoder' AS endpoint, '' AS action, 'critical' AS severity, status, fired_at AS starts_at,
             fired_at AS changed_at, 120.0::DOUBLE AS value FROM down, (VALUES ('pending'), ('firing')) s(status)
      UNION ALL SELECT 'BiEncoderDown', 'bi-encoder', '', 'critical', 'resolved', fired_at, resolved_at,
             (epoch(resolved_at)::BIGINT - epoch(since)::BIGINT)::DOUBLE FROM down WHERE resolved_at IS NOT NULL)
"""
# All that has happened by the newest event.
_TRANSITIONS = f"""{changes_sql()}, {DOWN_SQL},
    al0 AS (SELECT * FROM (SELECT * FROM tr UNION ALL SELECT * FROM dn) WHERE changed_at <= (SELECT max(ts) FROM e))
"""


def _conditions(spark, sf):
    ticks = alerts.metric_ticks(views.scored_events(spark, sf))
    return alerts.conditions(ticks, alerts.rule_table(spark))


def _transitions(spark, sf):
    return alerts.all_changes(views.scored_events(spark, sf), alerts.rule_table(spark))


@query(
    "alert_rules",
    f"WITH {_CONDITIONS} SELECT alertname, endpoint, action, tick, severity, category, round(value, 9) AS value FROM cond",
)
def alert_rules(spark, sf):
    """Rule table joined with windowed metrics: where each expression holds."""
    rows = _conditions(spark, sf)
    return rows.select("alertname", "endpoint", "action", "tick", "severity", "category", F.round("value", 9).alias("value"))


@query(
    "alert_sustained",
    f"WITH {_TRANSITIONS} SELECT alertname, endpoint, action, severity, status, starts_at, changed_at, round(value, 9) AS value FROM al0",
)
def alert_sustained(spark, sf):
    """W6, batch form of R10 and R11: all changes up to the newest event."""
    rows = _transitions(spark, sf)
    return rows.select("alertname", "endpoint", "action", "severity", "status", "starts_at", "changed_at", F.round("value", 9).alias("value"))


@query(
    "alert_absence",
    f"""
    WITH {_E}, t AS (SELECT DISTINCT endpoint, time_bucket(INTERVAL '30 seconds', ts) AS s FROM e),
    g AS (SELECT endpoint, s + INTERVAL 30 SECOND AS silent_since, lead(s) OVER (PARTITION BY endpoint ORDER BY s) AS resolved_at FROM t)
    SELECT endpoint, silent_since, silent_since + INTERVAL 120 SECOND AS fired_at, resolved_at FROM g
    WHERE epoch(coalesce(resolved_at, (SELECT max(ts) FROM e)))::BIGINT - epoch(silent_since)::BIGINT >= 120
    """,
)
def alert_absence(spark, sf):
    """R11, batch form."""
    return alerts.absences(views.request_events(spark, sf))


@query(
    "alert_inhibit",
    f"""
    WITH {_CONDITIONS}
    SELECT endpoint, action, tick, severity, count(*) AS alerts FROM cond c
    WHERE severity <> 'warning' OR NOT EXISTS (
      SELECT 1 FROM cond k WHERE k.severity = 'critical' AND k.endpoint = c.endpoint AND k.action = c.action AND k.tick = c.tick)
    GROUP BY ALL
    """,
)
def alert_inhibit(spark, sf):
    """J8 with equal endpoint, action and tick."""
    kept = alerts.inhibit(_conditions(spark, sf), ["endpoint", "action", "tick"])
    return kept.groupBy("endpoint", "action", "tick", "severity").agg(F.count("*").alias("alerts"))


def _alerts(spark, sf):
    """An alert of each firing or resolved transition, and its delivery."""
    rows = alerts.alert_rows(_transitions(spark, sf))
    return rows.withColumns(
        {"batch_id": F.date_format("changed_at", "yyyy-MM-dd"), "endpoint": F.concat("endpoint", F.lit("/"), "action")}
    )


def _alerts_sql() -> str:
    quoted = lambda v: "NULL" if v is None else f"'{v}'"
    notes = ", ".join("(" + ", ".join(map(quoted, (r[0], *r[7:10]))) + ")" for r in dict((r[0], r) for r in alerts.RULES).values())
    return f"""
    {_TRANSITIONS}, notes(alertname, category, summary, description) AS (VALUES {notes}),
    al AS (SELECT strftime(changed_at, '%Y-%m-%d') AS batch_id, alertname, severity, category, endpoint || '/' || action AS endpoint, status, changed_at,
             summary, replace(replace(description, '{{value}}', printf('%.6f', value)), '{{endpoint}}', endpoint) AS description
           FROM al0 JOIN notes USING (alertname) WHERE status <> 'pending'),
    msg AS (SELECT *, CASE status WHEN 'firing' THEN '🚨 *FIRING* ' ELSE '✅ *RESOLVED* ' END
        || CASE severity WHEN 'critical' THEN '🔴 ' WHEN 'warning' THEN '⚠️ ' ELSE 'ℹ️ ' END
        || CASE category WHEN 'reliability' THEN '💀' WHEN 'performance' THEN '⚡' WHEN 'model_quality' THEN '🎯' WHEN 'operability' THEN '🔧'
             WHEN 'cost' THEN '💰' ELSE '📊' END || chr(10) || chr(10)
        || '*Alert:* `' || alertname || '`' || chr(10) || '*Endpoint:* `' || endpoint || '`' || chr(10)
        || '*Severity:* ' || severity || chr(10) || '*Category:* ' || category || chr(10)
        || chr(10) || '📝 *Summary:*' || chr(10) || summary || chr(10)
        || CASE WHEN description IS NULL THEN '' ELSE chr(10) || '💬 *Details:*' || chr(10) || description || chr(10) END
        || chr(10) || '⏰ *Time:* ' || strftime(changed_at, '%Y-%m-%d %H:%M:%S') || ' UTC' || chr(10) AS message FROM al)
    """


@query("alert_messages", f"WITH {_alerts_sql()} SELECT batch_id, alertname, endpoint, status, message FROM msg")
def alert_messages(spark, sf):
    """F10."""
    return alerts.alert_message(_alerts(spark, sf)).select("batch_id", "alertname", "endpoint", "status", "message")


@query(
    "delivery_messages",
    f"""
    WITH {_alerts_sql()}
    SELECT batch_id, 'firing' AS kind, message FROM msg WHERE status = 'firing'
    UNION ALL SELECT batch_id, 'resolved', CASE WHEN count(*) = 1 THEN any_value(message) ELSE
      '✅ *RESOLVED* - ' || count(*) || ' alerts' || chr(10) || chr(10)
      || string_agg('• `' || alertname || '` (' || endpoint || ')' || chr(10), '' ORDER BY alertname, endpoint) END
    FROM msg WHERE status = 'resolved' GROUP BY batch_id
    """,
)
def delivery_messages(spark, sf):
    """One delivery a day."""
    return alerts.delivery_messages(_alerts(spark, sf))


@query("alert_status_counts", f"WITH {_alerts_sql()} SELECT alertname, status, count(*) AS n FROM al GROUP BY ALL")
def alert_status_counts(spark, sf):
    """A33."""
    return alerts.status_counts(_alerts(spark, sf), ["alertname"])


@query("alert_notices")
def alert_notices(spark, sf):
    """R12 over a finished table: what is sent, and when."""
    return notify.notices(_transitions(spark, sf))
