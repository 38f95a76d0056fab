"""Queries for monitoring: counters, alert rules, silence, lag and health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.monitor import (
    CHECKPOINT_DURATION,
    CHECKPOINT_FAILURES,
    RESTART_LOOP,
    SKETCH_ERROR,
    AlertRule,
    alert,
    alert_state,
    alert_transitions,
    checkpoint_summary,
    increase,
    job_health,
    metric_latest,
    metric_series,
    metric_sketches,
    offset_lag,
    rule_values,
    silence,
    sketch_quantiles,
    source_lag,
)
from changeflow.plans.expected import with_inputs
from changeflow.plans.registry import query
from changeflow.sources import derived

METRICS = ["num_restarts", "num_failed_checkpoints", "num_completed_checkpoints", "last_checkpoint_duration"]
NOW = "2024-02-01 00:00:00"


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return derived.job_metrics(derived.events(spark, folder))


def _increase_sql(metric: str) -> str:
    """CTE ``inc``: the growth of a counter summed over five-minute windows that start every minute."""
    return f"""steps AS (SELECT job_name, ts, {metric} AS v, lag({metric}) OVER (PARTITION BY job_name ORDER BY ts) AS p FROM f_met),
        growth AS (SELECT job_name, time_bucket(INTERVAL 1 MINUTE, ts) AS m,
            sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS g FROM steps GROUP BY 1, 2),
        inc AS (SELECT job_name, m - k * INTERVAL 1 MINUTE AS window_start,
                m - k * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE AS window_end, CAST(sum(g) AS BIGINT) AS increase
            FROM growth, (SELECT unnest([0, 1, 2, 3, 4]) AS k) ks GROUP BY 1, 2, 3)"""


def _values_sql(rule: AlertRule) -> str:
    if rule.over:
        return f"{_increase_sql(rule.metric)}, vals AS (SELECT job_name, window_end AS minute, increase AS value FROM inc)"
    return f"""vals AS (SELECT job_name, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS minute,
        CAST(arg_max({rule.metric}, ts) AS BIGINT) AS value FROM f_met GROUP BY 1, 2)"""


def _state_sql(rule: AlertRule) -> str:
    """CTE ``states``: islands of breached minutes, firing from the hold time on."""
    return f"""{_values_sql(rule)},
        flagged AS (SELECT *, value > {rule.above} AS hit FROM vals),
        islands AS (SELECT *, minute - INTERVAL 1 MINUTE * row_number() OVER (PARTITION BY job_name ORDER BY minute) AS island
            FROM flagged WHERE hit),
        begun AS (SELECT *, min(minute) OVER (PARTITION BY job_name, island) AS since FROM islands),
        states AS (SELECT f.job_name, f.minute, f.value,
            CASE WHEN b.since IS NULL THEN 'ok' WHEN f.minute >= b.since + INTERVAL {rule.hold_minutes} MINUTE THEN 'firing'
                ELSE 'pending' END AS state
            FROM flagged f LEFT JOIN begun b ON f.job_name = b.job_name AND f.minute = b.minute)"""


@query(
    "metric_increase",
    with_inputs("f_met", select=f"WITH {_increase_sql('num_restarts')} SELECT * FROM inc"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return increase(_metrics(spark, folder), "num_restarts")


def alert_sql(rule: AlertRule) -> str:
    return with_inputs("f_met", select=f"WITH {_state_sql(rule)} SELECT * FROM states")


@query("alert_restart_loop", alert_sql(RESTART_LOOP))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return alert(_metrics(spark, folder), RESTART_LOOP)


@query("alert_checkpoint_duration", alert_sql(CHECKPOINT_DURATION))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return alert(_metrics(spark, folder), CHECKPOINT_DURATION)


@query("alert_checkpoint_failures", alert_sql(CHECKPOINT_FAILURES))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return alert(_metrics(spark, folder), CHECKPOINT_FAILURES)


# Slow checkpoints of any length, held for three minutes.
SLOW = AlertRule("slow", "last_checkpoint_duration", None, 3000, 3, "warning")


@query(
    "alert_state",
    with_inputs(
        "f_met",
        select=f"""WITH {_state_sql(SLOW)} SELECT job_name, state, CAST(count(*) AS BIGINT) AS minutes,
            min(minute) AS first_minute, max(minute) AS last_minute FROM states GROUP BY 1, 2""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    values = rule_values(_metrics(spark, folder), SLOW)
    states = alert_state(values, F.col("value") > SLOW.above, SLOW.hold_minutes)
    return states.groupBy("job_name", "state").agg(
        F.count("*").alias("minutes"), F.min("minute").alias("first_minute"), F.max("minute").alias("last_minute")
    )


@query(
    "alert_transitions",
    with_inputs(
        "f_met",
        select=f"""WITH {_state_sql(CHECKPOINT_DURATION)},
            seen AS (SELECT *, lag(state) OVER w AS s, lag(minute) OVER w AS m FROM states
                WINDOW w AS (PARTITION BY job_name ORDER BY minute)),
            gaps AS (SELECT *, m IS NOT NULL AND minute > m + INTERVAL 1 MINUTE AS gap FROM seen),
            starts AS (SELECT *, CASE WHEN gap THEN 'ok' ELSE COALESCE(s, 'ok') END AS start FROM gaps)
            SELECT job_name, m + INTERVAL 1 MINUTE AS minute, s AS from_state, 'ok' AS to_state FROM gaps
                WHERE gap AND s <> 'ok'
            UNION ALL SELECT job_name, minute, start, state FROM starts WHERE start <> state""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return alert_transitions(alert(_metrics(spark, folder), CHECKPOINT_DURATION))


@query(
    "silence_gaps",
    """SELECT job_name, minute + INTERVAL 1 MINUTE AS silent_from, following AS silent_until,
            CAST(epoch(following - minute) / 60 - 1 AS BIGINT) AS silent_minutes
        FROM (SELECT *, lead(minute) OVER (PARTITION BY job_name ORDER BY minute) AS following
            FROM (SELECT DISTINCT event_type AS job_name, time_bucket(INTERVAL 1 MINUTE, ts) AS minute FROM events) a) b
        WHERE following > minute + INTERVAL 1 MINUTE""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return silence(derived.events(spark, folder), "event_type")


@query(
    "silence_open",
    f"""SELECT job_name, minute + INTERVAL 1 MINUTE AS silent_from, COALESCE(following, TIMESTAMP '{NOW}') AS silent_until,
            following IS NULL AS still_silent, CAST(epoch(COALESCE(following, TIMESTAMP '{NOW}') - minute) / 60 - 1 AS BIGINT) AS silent_minutes
        FROM (SELECT *, lead(minute) OVER (PARTITION BY job_name ORDER BY minute) AS following
            FROM (SELECT DISTINCT event_type AS job_name, time_bucket(INTERVAL 1 MINUTE, ts) AS minute FROM events) a) b
        WHERE COALESCE(following, TIMESTAMP '{NOW}') > minute + INTERVAL 1 MINUTE""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return silence(derived.events(spark, folder), "event_type", now=F.lit(NOW).cast("timestamp_ntz"))


@query(
    "source_lag",
    f"""SELECT event_type AS job_name, max(ts) AS last_event,
        CAST(date_diff('microseconds', max(ts), TIMESTAMP '{NOW}') // 1000 AS BIGINT) AS lag_ms FROM events GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return source_lag(derived.events(spark, folder), F.lit(NOW).cast("timestamp_ntz"), "event_type")


@query(
    "offset_lag",
    """SELECT job_name, log_end, committed, log_end - COALESCE(committed, -1) AS lag FROM (
        SELECT 'job_' || (user_id % 5) AS job_name, max(event_id) AS log_end,
            max(event_id) FILTER (event_type = 'signup' AND value > 100) AS committed FROM events GROUP BY 1) a""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    log = derived.events(spark, folder).select(
        F.concat(F.lit("job_"), (F.col("user_id") % 5).cast("string")).alias("job_name"),
        F.col("event_id").alias("pos"),
        "event_type",
        "value",
    )
    # A job commits its position at each large signup.
    commits = log.where((F.col("event_type") == "signup") & (F.col("value") > 100))
    return offset_lag(log, commits, "pos")


@query(
    "job_health",
    with_inputs(
        "f_met",
        select="""SELECT job_name, completed, restarts, completed >= 1 AND restarts = 0 AS healthy FROM (
            SELECT job_name, CAST(arg_max(num_completed_checkpoints, ts) AS BIGINT) AS completed,
                CAST(arg_max(num_restarts, ts) AS BIGINT) AS restarts FROM f_met GROUP BY 1) a""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return job_health(_metrics(spark, folder))


@query(
    "metric_latest",
    with_inputs(
        "f_met",
        select=" UNION ALL ".join(
            f"SELECT job_name, '{m}' AS metric, CAST(arg_max({m}, ts) AS BIGINT) AS value FROM f_met GROUP BY 1"
            for m in METRICS
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return metric_latest(_metrics(spark, folder), METRICS)


@query(
    "metric_series",
    with_inputs(
        "f_met",
        select=" UNION ALL ".join(
            f"""SELECT job_name, time_bucket(INTERVAL 1 MINUTE, ts) AS minute, '{m}' AS metric,
                CAST(arg_max({m}, ts) AS BIGINT) AS value FROM f_met GROUP BY 1, 2"""
            for m in METRICS[:2]
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return metric_series(_metrics(spark, folder), METRICS[:2])


@query(
    "checkpoint_summary",
    with_inputs(
        "f_met",
        select="""SELECT job_name, CAST(arg_max(num_completed_checkpoints, ts) AS BIGINT) AS completed,
            CAST(arg_max(num_failed_checkpoints, ts) AS BIGINT) AS failed, CAST(count(*) AS BIGINT) AS samples,
            CAST(min(last_checkpoint_duration) AS BIGINT) AS min_duration,
            CAST(max(last_checkpoint_duration) AS BIGINT) AS max_duration,
            CAST(sum(last_checkpoint_duration) AS BIGINT) AS total_duration FROM f_met GROUP BY 1""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return checkpoint_summary(_metrics(spark, folder))


RANKS = (0.05, 0.5, 0.95)


@query(
    "metric_quantiles",
    with_inputs(
        "f_met",
        select="""SELECT job_name, time_bucket(INTERVAL 1 DAY, ts) AS day, CAST(count(*) AS BIGINT) AS samples, r.rank, TRUE AS within_error
            FROM f_met, (SELECT unnest([0.05::DOUBLE, 0.5, 0.95]) AS rank) r GROUP BY ALL""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of a day out of hourly sketches, and whether their exact rank is within the error of the sketch."""
    metrics, metric = _metrics(spark, folder), "last_checkpoint_duration"
    hourly = metric_sketches(metrics, metric).withColumn("day", F.date_trunc("day", "span_start").cast("timestamp_ntz"))
    daily = sketch_quantiles(hourly, ["job_name", "day"], list(RANKS))
    values = F.arrays_zip(F.array(*[F.lit(r) for r in RANKS]).alias("rank"), F.col("quantiles").alias("value"))
    asked = daily.select("job_name", "day", "samples", F.inline(values))
    placed = metrics.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz")).join(asked, ["job_name", "day"])
    # The exact rank of a value is the share of samples below it, up to the share of those that are not above it.
    ranked = placed.groupBy("job_name", "day", "samples", "rank").agg(
        F.avg((F.col(metric) < F.col("value")).cast("int")).alias("low"), F.avg((F.col(metric) <= F.col("value")).cast("int")).alias("high")
    )
    # One sample more or less is a rounding of the rank.
    error = F.lit(SKETCH_ERROR) + 1 / F.col("samples")
    within = F.col("rank").between(F.col("low") - error, F.col("high") + error)
    return ranked.select("job_name", "day", "samples", "rank", within.alias("within_error"))
