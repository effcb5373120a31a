"""Alert rules as data: conditions per tick, sustained alerts, inhibition,
message texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.operators import telemetry
from lodestream.operators.histogram import LATENCY_BOUNDS, bucket_counts, bucket_columns, quantile

TICK_SECONDS = 30
KEYS = ("alertname", "endpoint", "action")

RULE_SCHEMA = (
    "alertname string, endpoint string, metric string, op string, threshold double, for_seconds bigint, "
    "severity string, category string, summary string, description string"
)

# Fixed values of the shipped rules.
RULES = [
    ("BiEncoderHighErrorRate", "bi-encoder", "error_rate", ">", 0.01, 300, "critical", "reliability",
     "Bi-Encoder error rate > 1%", "Error rate is {value} for endpoint {endpoint}"),
    ("BiEncoderDown", "bi-encoder", "silent_seconds", ">=", 120.0, 0, "critical", "reliability",
     "Bi-Encoder endpoint is down", None),
    ("BiEncoderHighLatency", "bi-encoder", "latency_p95", ">", 0.1, 300, "warning", "performance",
     "Bi-Encoder P95 latency > 100ms", "P95 latency is {value}s"),
    ("BiEncoderSlowInference", "bi-encoder", "inference_mean", ">", 0.05, 300, "warning", "performance",
     "Bi-Encoder inference time > 50ms", None),
    ("BiEncoderInvalidDimension", "bi-encoder", "dimension", "!=", 768.0, 60, "critical", "model_quality",
     "Bi-Encoder returning wrong embedding dimension", "Expected 768, got {value}"),
    ("BiEncoderFrequentRestarts", "bi-encoder", "cold_start_rate", ">", 0.1, 600, "warning", "operability",
     "Bi-Encoder cold starts > 6/hour", None),
    ("BiEncoderHighCost", "bi-encoder", "cost_per_1k", ">", 0.10, 3600, "info", "cost",
     "Bi-Encoder cost > $0.10 per 1k requests", None),
    ("CrossEncoderHighErrorRate", "cross-encoder", "error_rate", ">", 0.01, 300, "critical", "reliability",
     "Cross-Encoder error rate > 1%", None),
    ("CrossEncoderHighLatency", "cross-encoder", "latency_p95", ">", 0.3, 300, "warning", "performance",
     "Cross-Encoder P95 latency > 300ms", None),
    ("CrossEncoderInvalidScores", "cross-encoder", "score_min", "<", 0.0, 60, "critical", "model_quality",
     "Cross-Encoder returning invalid scores", None),
    ("CrossEncoderInvalidScores", "cross-encoder", "score_max", ">", 1.0, 60, "critical", "model_quality",
     "Cross-Encoder returning invalid scores", None),
    ("CrossEncoderScoreDistribution", "cross-encoder", "score_stddev", "<", 0.05, 900, "warning", "model_quality",
     "Cross-Encoder scores have low variance", "Might indicate model degradation"),
]

# Fixed display marks.
SEVERITY_EMOJI = {"critical": "🔴", "warning": "⚠️", "info": "ℹ️"}
CATEGORY_EMOJI = {
    "reliability": "💀",
    "performance": "⚡",
    "model_quality": "🎯",
    "operability": "🔧",
    "cost": "💰",
    "security": "🔒",
    "scalability": "📈",
}
STATUS_EMOJI = {"FIRING": "🚨", "RESOLVED": "✅"}


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULE_SCHEMA)


def with_score_gauges(events: DataFrame) -> DataFrame:
    """Count, sums and range of each event's scores, from ``scores`` (a batch) or ``score``."""
    if "scores" in events.columns:
        seen = F.filter("scores", lambda v: v.isNotNull())
        zero = F.lit(0.0)
        parts = {
            "_scores": F.coalesce(F.size(seen), F.lit(0)),
            "_score_sum": F.aggregate(F.coalesce(seen, F.array().cast("array<double>")), zero, lambda a, v: a + v),
            "_score_squares": F.aggregate(F.coalesce(seen, F.array().cast("array<double>")), zero, lambda a, v: a + v * v),
        }
        return telemetry.with_score_range(events.withColumns(parts))
    score = F.col("score")
    parts = {"_scores": F.when(score.isNull(), 0).otherwise(1), "_score_sum": F.coalesce(score, F.lit(0.0)),
             "_score_squares": F.coalesce(score * score, F.lit(0.0)), "score_min": score, "score_max": score}
    return events.withColumns(parts)


def metric_ticks(events: DataFrame, length: str = "5 minutes", starts: DataFrame | None = None) -> DataFrame:
    """(at, tick, endpoint, action, metric, value): what the rules look at, per 30 s.

    Rates and quantiles are kept per action, the rest per endpoint (action '').
    The events are read once: steps of (30 s, endpoint, action) are rolled up both
    ways as they are added to windows. Dimension and score bounds are gauges: those of the
    newest event of the window, by time and then by ``event_id``; score bounds are the
    least and the greatest of its batch. ``starts`` are the first requests of the workers
    (found in ``events`` unless given, as a stream must). The same plan serves a batch
    and a stream; ``at`` is the window's event time, just before the tick.
    """
    newest = ["ts", *(["event_id"] if "event_id" in events.columns else []), "dimension", "score_min", "score_max"]
    partials = {
        "n": F.count("*"), "failed": F.count_if(F.col("status") != "success"),
        **bucket_columns(F.col("duration_s"), LATENCY_BOUNDS),
        "inference": F.sum("inference_s"), "inferences": F.count("inference_s"), "cost": F.sum("cost"),
        "seen": F.max(F.struct(*newest)),
        "s": F.sum("_score_sum"), "ss": F.sum("_score_squares"), "scores": F.sum("_scores"),
    }
    steps = with_score_gauges(events).groupBy(F.window("ts", telemetry.STEP).alias("w"), "endpoint", "action").agg(
        *[c.alias(n) for n, c in partials.items()]
    )
    scopes = F.explode(F.array(F.struct(F.lit(False).alias("whole"), "action"), F.struct(F.lit(True).alias("whole"), F.lit("").alias("action"))))
    both = steps.withColumn("_scope", scopes).select("w", "endpoint", "_scope.*", *partials)
    windows = both.groupBy(F.window(F.window_time("w"), length, telemetry.STEP).alias("w"), "endpoint", "whole", "action").agg(
        *[(F.max if n == "seen" else F.sum)(n).alias(n) for n in partials]
    )
    mean = F.try_divide(F.col("s"), F.col("scores"))
    spread = F.sqrt(F.greatest(F.try_divide(F.col("ss"), F.col("scores")) - mean * mean, F.lit(0.0)))
    per_action = {"error_rate": F.col("failed") / F.col("n"), "latency_p95": quantile(bucket_counts(LATENCY_BOUNDS), LATENCY_BOUNDS, 0.95)}
    per_endpoint = {
        "inference_mean": F.try_divide(F.col("inference"), F.col("inferences")),
        "cost_per_1k": 1000 * F.col("cost") / F.col("n"),
        "dimension": F.col("seen.dimension").cast("double"),
        "score_min": F.col("seen.score_min"),
        "score_max": F.col("seen.score_max"),
        "score_stddev": spread,
    }
    measured = _long(windows, {**{m: F.when(~F.col("whole"), v) for m, v in per_action.items()}, **{m: F.when(F.col("whole"), v) for m, v in per_endpoint.items()}})
    first = telemetry.cold_starts(events) if starts is None else starts
    hourly = telemetry.sliding(first, ["endpoint"], {"increase": F.count("*")}, "1 hour", keep="w").withColumn("action", F.lit(""))
    return measured.unionByName(_long(hourly, {"cold_start_rate": F.col("increase") / telemetry.seconds_of("1 hour")}))


def _long(windows: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    # Not unpivot: the window's event time must stay the same column in a stream.
    values = F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()])
    rows = windows.select(F.window_time("w").alias("at"), F.col("w.end").alias("tick"), "endpoint", "action", F.explode(values).alias("_m"))
    return rows.select("at", "tick", "endpoint", "action", "_m.metric", "_m.value").where(F.col("value").isNotNull())


def _holds(op: Column, value: Column, threshold: Column) -> Column:
    return (
        F.when(op == ">", value > threshold)
        .when(op == ">=", value >= threshold)
        .when(op == "<", value < threshold)
        .when(op == "!=", value != threshold)
    )


def met(ticks: DataFrame, rules: DataFrame) -> DataFrame:
    """Ticks joined with the rules that hold at them. ``rules`` is a short fixed table."""
    return ticks.join(F.broadcast(rules), ["endpoint", "metric"]).where(_holds(F.col("op"), F.col("value"), F.col("threshold")))


def conditions(ticks: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per alert instance and tick at which its expression is true.

    Rules of one name are alternatives.
    """
    meta = ["for_seconds", "severity", "category", "summary", "description"]
    return met(ticks, rules).groupBy(*KEYS, "tick", *meta).agg(F.max("value").alias("value"))


def episodes(true_ticks: DataFrame, tick_seconds: int = TICK_SECONDS, gap_seconds: int | None = None) -> DataFrame:
    """Runs of true ticks per alert instance: start, end, and the tick and value at
    which the run has lasted ``for_seconds`` (else null).

    Ticks more than ``gap_seconds`` apart (one tick unless given) are different runs.
    """
    gap = gap_seconds or tick_seconds
    carried = [c for c in ("for_seconds", "severity", "category", "summary", "description") if c in true_ticks.columns]
    seconds = F.unix_seconds(F.col("tick").cast("timestamp"))
    order = Window.partitionBy(*KEYS).orderBy("tick")
    begins = F.coalesce(seconds - F.lag(seconds).over(order) > gap, F.lit(True))
    marked = true_ticks.withColumn("_begin", F.when(begins, F.col("tick"))).withColumn("_first", F.last("_begin", ignorenulls=True).over(order))
    age = seconds - F.unix_seconds(F.col("_first").cast("timestamp"))
    at = F.struct("tick", "value")
    grouped = marked.groupBy(*KEYS, "_first", *carried).agg(
        F.max("tick").alias("last_true"),
        F.min_by("value", "tick").alias("start_value"),
        F.max_by("value", "tick").alias("last_value"),
        F.min(F.when(age >= F.col("for_seconds"), at)).alias("_fire"),
    )
    named = {"started": F.col("_first"), "fired": F.col("_fire.tick"), "fire_value": F.col("_fire.value")}
    return grouped.withColumns(named).drop("_first", "_fire")


def transitions(runs: DataFrame, gap_seconds: int = TICK_SECONDS, until: Column | None = None) -> DataFrame:
    """Rows (…, status, starts_at, changed_at, value) for pending, firing, resolved.

    What would come after ``until`` (the time up to which there are events) has not
    happened: a run that is still true then is not resolved.
    """
    step = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    row = lambda status, at, value: F.struct(
        F.lit(status).alias("status"), at.alias("changed_at"), value.alias("value")
    )
    changes = F.array(
        row("pending", F.col("started"), F.col("start_value")),
        row("firing", F.col("fired"), F.col("fire_value")),
        row("resolved", F.when(F.col("fired").isNotNull(), F.col("last_true") + step), F.col("last_value")),
    )
    meta = [c for c in ("severity", "category", "summary", "description") if c in runs.columns]
    rows = runs.select(*KEYS, *meta, F.col("started").alias("starts_at"), F.inline(changes)).where(F.col("changed_at").isNotNull())
    return rows if until is None else rows.where(F.col("changed_at") <= until)


def down_changes(silences: DataFrame, rules: DataFrame, until: Column | None = None) -> DataFrame:
    """Changes of the rules on ``silent_seconds``, from ``absences`` of the rules' thresholds.

    Such an alert is pending and firing once the silence has lasted the threshold,
    and resolved by the next event.
    """
    down = F.broadcast(rules.where(F.col("metric") == "silent_seconds"))
    since = F.unix_seconds(F.col("silent_since").cast("timestamp"))
    waited = F.unix_seconds(F.col("fired_at").cast("timestamp")) - since
    mine = silences.join(down, "endpoint").where(waited == F.col("threshold"))
    runs = F.array(
        *[F.struct(F.lit(status).alias("status"), F.col("fired_at").alias("changed_at"), F.col("threshold").alias("value")) for status in ("pending", "firing")],
        F.struct(F.lit("resolved").alias("status"), F.col("resolved_at").alias("changed_at"),
                 (F.unix_seconds(F.col("resolved_at").cast("timestamp")) - since).cast("double").alias("value")),
    )
    rows = mine.select(
        "alertname", "endpoint", F.lit("").alias("action"), "severity", "category", "summary", "description", F.col("fired_at").alias("starts_at"), F.inline(runs)
    ).where(F.col("changed_at").isNotNull())
    return rows if until is None else rows.where(F.col("changed_at") <= until)


def all_changes(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Every change of every alert up to the newest event, silences included."""
    newest = events.agg(F.max("ts")).scalar()
    changes = transitions(episodes(conditions(metric_ticks(events), rules)), until=newest)
    for limit in silence_limits(rules):
        changes = changes.unionByName(down_changes(absences(events, limit, until=newest), rules, newest))
    return changes


def silence_limits(rules: DataFrame) -> list[int]:
    """Thresholds of the rules on silence; ``rules`` is a short fixed table."""
    return sorted({int(r["threshold"]) for r in rules.where(F.col("metric") == "silent_seconds").select("threshold").collect()})


def absences(
    events: DataFrame, limit_seconds: int = 120, tick_seconds: int = TICK_SECONDS, until: Column | None = None
) -> DataFrame:
    """Silences of an endpoint that lasted the limit: fired at, resolved at.

    Ticks with traffic are found first, so the ordering step sees at most one
    row per endpoint and tick however busy the endpoint is. A silence that lasts
    until now (``until``, or the newest event of any endpoint) is open: resolved null.
    """
    now = F.unix_seconds((events.agg(F.max("ts")).scalar() if until is None else until).cast("timestamp"))
    active = events.groupBy("endpoint", F.window("ts", f"{tick_seconds} seconds").alias("w")).agg(F.count("*").alias("n"))
    order = Window.partitionBy("endpoint").orderBy("w_start")
    flat = active.select("endpoint", F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"))
    gaps = flat.withColumn("resolved_at", F.lead("w_start").over(order))
    quiet = F.coalesce(F.unix_seconds(F.col("resolved_at").cast("timestamp")), now) - F.unix_seconds(F.col("w_end").cast("timestamp"))
    fired = F.col("w_end") + F.expr(f"INTERVAL {limit_seconds} SECONDS")
    return gaps.where(quiet >= limit_seconds).select(
        "endpoint", F.col("w_end").alias("silent_since"), fired.alias("fired_at"), "resolved_at"
    )


def inhibit(active: DataFrame, equal: Sequence[str] = ("alertname", "endpoint")) -> DataFrame:
    """Drop warnings while a critical alert with equal keys is active."""
    critical = active.where(F.col("severity") == "critical").select(*equal).distinct()
    warnings = active.where(F.col("severity") == "warning").join(critical, list(equal), "left_anti")
    return active.where(F.coalesce(F.col("severity") != "warning", F.lit(True))).unionByName(warnings)


def alert_rows(changes: DataFrame) -> DataFrame:
    """One alert per firing or resolved transition, as messages need it.

    The rule's category, summary and description come along; ``{value}`` and
    ``{endpoint}`` in them are filled in.
    """
    value = F.format_string("%.6f", F.col("value"))

    def filled(text: str) -> Column:
        return F.replace(F.replace(F.col(text), F.lit("{value}"), value), F.lit("{endpoint}"), F.col("endpoint"))

    notes = F.map_filter(
        F.create_map(F.lit("summary"), filled("summary"), F.lit("description"), filled("description")), lambda _, v: v.isNotNull()
    )
    rows = changes.where(F.col("status").isin("firing", "resolved"))
    return rows.select(
        *KEYS, "severity", "category", "status", "changed_at",
        F.concat(F.date_format("changed_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("startsAt"), notes.alias("annotations"),
    )


# --- messages ------------------------------------------------------------------


def _mark(table: dict[str, str], key: Column, default: str) -> Column:
    mapping = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, key), F.lit(default))


def alert_message(alert: DataFrame) -> DataFrame:
    """Add ``message``, the full text of one alert.

    Columns: alertname, severity, category, endpoint, status, startsAt (ISO
    text), annotations (map with summary, description, runbook_url).
    """
    text = lambda c, default: F.coalesce(F.col(c), F.lit(default))
    status = F.upper(text("status", "unknown"))
    severity, category = text("severity", "info"), text("category", "unknown")
    note = lambda k: F.try_element_at("annotations", F.lit(k))
    optional = lambda value, *parts: F.when(value.isNotNull(), F.concat(*parts)).otherwise(F.lit(""))
    # Any ISO form; the wall-clock part is printed as it was written.
    wall = F.try_to_timestamp(
        F.replace(F.regexp_extract("startsAt", r"^(\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d)", 1), F.lit("T"), F.lit(" ")),
        F.lit("yyyy-MM-dd HH:mm:ss"),
    )
    head = F.concat(
        _mark(STATUS_EMOJI, status, "❓"), F.lit(" *"), status, F.lit("* "),
        _mark(SEVERITY_EMOJI, severity, "❓"), F.lit(" "), _mark(CATEGORY_EMOJI, category, "📊"), F.lit("\n\n"),
        F.lit("*Alert:* `"), text("alertname", "Unknown"), F.lit("`\n"),
        F.lit("*Endpoint:* `"), text("endpoint", "unknown"), F.lit("`\n"),
        F.lit("*Severity:* "), severity, F.lit("\n"),
        F.lit("*Category:* "), category, F.lit("\n"),
    )
    summary, detail, runbook = note("summary"), note("description"), note("runbook_url")
    stamp = F.date_format(wall, "yyyy-MM-dd HH:mm:ss 'UTC'")
    return alert.withColumn(
        "message",
        F.concat(
            head,
            optional(summary, F.lit("\n📝 *Summary:*\n"), summary, F.lit("\n")),
            optional(detail, F.lit("\n💬 *Details:*\n"), detail, F.lit("\n")),
            optional(stamp, F.lit("\n⏰ *Time:* "), stamp, F.lit("\n")),
            optional(runbook, F.lit("\n📖 [Runbook]("), runbook, F.lit(")\n")),
        ),
    )


def status_counts(alerts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return alerts.groupBy(*by, "status").agg(F.count("*").alias("n"))


def delivery_messages(alerts: DataFrame, batch: str = "batch_id") -> DataFrame:
    """(batch_id, kind, message) to send for each delivered batch of alerts.

    A firing alert is one message, a lone resolved alert is one full message,
    several resolved alerts share one list. A batch is one delivery.
    """
    texted = alert_message(alerts)
    firing = texted.where(F.col("status") == "firing").select(batch, F.lit("firing").alias("kind"), "message")
    line = F.concat(
        F.lit("• `"), F.coalesce("alertname", F.lit("Unknown")), F.lit("` ("), F.coalesce("endpoint", F.lit("unknown")), F.lit(")\n")
    )
    resolved = texted.where(F.col("status") == "resolved").groupBy(batch).agg(
        F.count("*").alias("n"),
        F.max("message").alias("single"),
        F.array_join(F.array_sort(F.collect_list(line)), "").alias("lines"),
    )
    listed = F.concat(F.lit("✅ *RESOLVED* - "), F.col("n").cast("string"), F.lit(" alerts\n\n"), F.col("lines"))
    together = resolved.select(
        batch, F.lit("resolved").alias("kind"), F.when(F.col("n") == 1, F.col("single")).otherwise(listed).alias("message")
    )
    return firing.unionByName(together)
