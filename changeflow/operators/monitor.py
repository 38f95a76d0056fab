"""Monitoring queries over job metrics: counters, alert rules, silence, lag and health.

Samples are reduced to one row per job and minute before anything looks across time. What is ordered per job is
therefore as long as the history in minutes, however many samples arrive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

def _minute(ts: str) -> Column:
    return F.window(ts, "1 minute")["start"]


def _per_job() -> WindowSpec:
    return Window.partitionBy("job_name").orderBy("minute")


def counter_growth(df: DataFrame, metric: str, ts: str = "ts", job: str = "job_name") -> DataFrame:
    """Growth of a counter per job and minute: ``job_name, minute, growth``.

    A value below the one before it is a reset and counts whole. Differences inside a minute are summed where the
    minute is; only the first and last value of each minute are compared across minutes.
    """
    samples = df.select(
        F.col(job).alias("job_name"), _minute(ts).alias("minute"), F.col(ts).alias("_ts"), F.col(metric).alias("_v")
    )
    before = F.lag("_v").over(Window.partitionBy("job_name", "minute").orderBy("_ts"))
    minutes = (
        samples.withColumn("_step", _step(before, F.col("_v")))
        .groupBy("job_name", "minute")
        .agg(F.sum("_step").alias("_inside"), F.min_by("_v", "_ts").alias("_first"), F.max_by("_v", "_ts").alias("_last"))
    )
    across = _step(F.lag("_last").over(_per_job()), F.col("_first"))
    return minutes.select("job_name", "minute", (F.col("_inside") + across).cast("bigint").alias("growth"))


def _step(before: Column, value: Column) -> Column:
    return F.when(before.isNull(), F.lit(0)).when(value < before, value).otherwise(value - before)


def increase(df: DataFrame, metric: str, window: str = "5 minutes", slide: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Growth of a counter in sliding windows ``[window_start, window_end)``: ``job_name, ..., increase``.

    Only windows that hold a sample appear.
    """
    slid = counter_growth(df, metric, ts).groupBy("job_name", F.window("minute", window, slide).alias("_w"))
    return slid.agg(F.sum("growth").cast("bigint").alias("increase")).select(
        "job_name", F.col("_w")["start"].alias("window_start"), F.col("_w")["end"].alias("window_end"), "increase"
    )


# --- alert rules --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class AlertRule:
    """A condition on one metric that has to hold for a time before it fires."""

    name: str
    metric: str
    over: str | None  # window of a counter's increase, or None for a gauge
    above: int
    hold_minutes: int
    severity: str


# The thresholds and hold times of the three alert rules.
RESTART_LOOP = AlertRule("restart_loop", "num_restarts", "5 minutes", 3, 1, "critical")
CHECKPOINT_DURATION = AlertRule("checkpoint_duration", "last_checkpoint_duration", None, 180_000, 2, "warning")
CHECKPOINT_FAILURES = AlertRule("checkpoint_failures", "num_failed_checkpoints", "5 minutes", 3, 1, "critical")


def rule_values(df: DataFrame, rule: AlertRule, ts: str = "ts") -> DataFrame:
    """What a rule looks at, once a minute: ``job_name, minute, value``.

    ``minute`` is when the rule is evaluated: the end of the window of an increase, the end of the minute whose last
    sample a gauge gives.
    """
    if rule.over:
        windows = increase(df, rule.metric, rule.over, "1 minute", ts)
        return windows.select("job_name", F.col("window_end").alias("minute"), F.col("increase").alias("value"))
    last = df.groupBy("job_name", F.window(ts, "1 minute")["end"].alias("minute"))
    return last.agg(F.max_by(rule.metric, ts).cast("bigint").alias("value"))


def alert_state(df: DataFrame, breached: Column, hold_minutes: int) -> DataFrame:
    """Add ``state`` to minutes of a job: ``ok``, ``pending`` since the breach began, ``firing`` once it has held.

    A minute without data is ok, so it ends a breach.
    """
    flagged = df.withColumn("_breached", F.coalesce(breached, F.lit(False)))
    last_minute = F.lag("minute").over(_per_job())
    goes_on = F.lag("_breached").over(_per_job()) & (last_minute == F.col("minute") - F.expr("INTERVAL 1 MINUTE"))
    begins = flagged.withColumn(
        "_begin", F.when(F.col("_breached") & ~F.coalesce(goes_on, F.lit(False)), F.col("minute"))
    )
    so_far = _per_job().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    since = begins.withColumn("_since", F.last("_begin", ignorenulls=True).over(so_far))
    held = F.col("minute") >= F.col("_since") + F.expr(f"INTERVAL {hold_minutes} MINUTE")
    state = (
        F.when(~F.col("_breached"), F.lit("ok")).when(held, F.lit("firing")).otherwise(F.lit("pending"))
    )
    return since.select(*df.columns, state.alias("state"))


def alert(df: DataFrame, rule: AlertRule, ts: str = "ts") -> DataFrame:
    """Evaluate a rule: ``job_name, minute, value, state``."""
    return alert_state(rule_values(df, rule, ts), F.col("value") > rule.above, rule.hold_minutes)


def alert_transitions(df: DataFrame) -> DataFrame:
    """Changes of the state of a job: ``job_name, minute, from_state, to_state``.

    Every job starts as ok. Where minutes are missing the state went to ok at the first of them.
    """
    step = F.expr("INTERVAL 1 MINUTE")
    seen = df.withColumns(
        {"_state": F.lag("state").over(_per_job()), "_minute": F.lag("minute").over(_per_job())}
    )
    before = F.coalesce("_state", F.lit("ok"))
    gap = F.coalesce(F.col("minute") > F.col("_minute") + step, F.lit(False))
    start = F.when(gap, F.lit("ok")).otherwise(before)

    def change(when: Column, at: Column, old: Column, new: Column) -> Column:
        return F.when(when, F.struct(at.alias("minute"), old.alias("from_state"), new.alias("to_state")))

    changes = F.array_compact(
        F.array(
            change(gap & (before != "ok"), F.col("_minute") + step, before, F.lit("ok")),
            change(start != F.col("state"), F.col("minute"), start, F.col("state")),
        )
    )
    return seen.select("job_name", F.inline(changes))


# --- silence, lag, health -----------------------------------------------------------------------------------------


def silence(df: DataFrame, job: str, ts: str = "ts", now: Column | None = None) -> DataFrame:
    """Spans of at least a whole minute in which a job consumed nothing, between minutes in which it did.

    With ``now`` the span after a job's last minute counts too, up to the minute of ``now``; ``still_silent`` marks it. So a job
    that stopped for good is reported.
    """
    minutes = df.select(F.col(job).alias("job_name"), _minute(ts).alias("minute")).distinct()
    step = F.expr("INTERVAL 1 MINUTE")
    following = F.lead("minute").over(_per_job())
    spans = minutes.select(
        "job_name",
        (F.col("minute") + step).alias("silent_from"),
        (following if now is None else F.coalesce(following, F.date_trunc("minute", now).cast("timestamp_ntz"))).alias("silent_until"),
        *([] if now is None else [following.isNull().alias("still_silent")]),
    ).where(F.col("silent_until") > F.col("silent_from"))
    return spans.withColumn(
        "silent_minutes", F.timestamp_diff("MINUTE", F.col("silent_from"), F.col("silent_until")).cast("bigint")
    )


def source_lag(df: DataFrame, now: Column, job: str, ts: str = "ts") -> DataFrame:
    """Milliseconds between ``now`` and the last event of each job."""
    last = df.groupBy(F.col(job).alias("job_name")).agg(F.max(ts).alias("last_event"))
    return last.withColumn(
        "lag_ms", F.timestamp_diff("MILLISECOND", F.col("last_event"), now).cast("bigint")
    )


def offset_lag(log: DataFrame, commits: DataFrame, pos: str, job: str = "job_name") -> DataFrame:
    """Latest position of the log minus last committed position, per job; a job without commits lags by the whole log."""
    ends = log.select(job, F.col(pos).alias("_end"), F.lit(None).cast("bigint").alias("_done"))
    done = commits.select(job, F.lit(None).cast("bigint").alias("_end"), F.col(pos).alias("_done"))
    both = ends.unionAll(done).groupBy(job).agg(F.max("_end").alias("log_end"), F.max("_done").alias("committed"))
    return both.withColumn("lag", F.col("log_end") - F.coalesce("committed", F.lit(-1).cast("bigint")))


def job_health(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Latest counters of each job; healthy is at least one completed checkpoint and no restart."""
    latest = df.groupBy("job_name").agg(
        F.max_by("num_completed_checkpoints", ts).cast("bigint").alias("completed"),
        F.max_by("num_restarts", ts).cast("bigint").alias("restarts"),
    )
    return latest.withColumn("healthy", (F.col("completed") >= 1) & (F.col("restarts") == 0))


def metric_latest(df: DataFrame, metrics: list[str], ts: str = "ts") -> DataFrame:
    """Latest value of each metric of each job, one row per job and metric."""
    wide = df.groupBy("job_name").agg(
        *[
            F.max_by(F.when(F.col(m).isNotNull(), F.col(m)), F.when(F.col(m).isNotNull(), F.col(ts))).cast("bigint").alias(m)
            for m in metrics
        ]
    )
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return wide.select("job_name", F.inline(pairs))


def metric_series(df: DataFrame, metrics: list[str], ts: str = "ts") -> DataFrame:
    """Last value of each metric in each minute, for a panel."""
    wide = df.groupBy("job_name", F.window(ts, "1 minute")["start"].alias("minute")).agg(
        *[F.max_by(m, ts).cast("bigint").alias(m) for m in metrics]
    )
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
    return wide.select("job_name", "minute", F.inline(pairs))


def checkpoint_summary(df: DataFrame, ts: str = "ts", quantile: float | None = None) -> DataFrame:
    """Checkpoints of each job: latest totals, and the spread of the durations in milliseconds.

    ``quantile`` adds an approximate quantile of the durations.
    """
    duration = F.col("last_checkpoint_duration")
    extra = [F.percentile_approx(duration, quantile).alias("duration_quantile")] if quantile is not None else []
    return df.groupBy("job_name").agg(
        F.max_by("num_completed_checkpoints", ts).cast("bigint").alias("completed"),
        F.max_by("num_failed_checkpoints", ts).cast("bigint").alias("failed"),
        F.count("*").cast("bigint").alias("samples"),
        F.min(duration).cast("bigint").alias("min_duration"),
        F.max(duration).cast("bigint").alias("max_duration"),
        F.sum(duration).cast("bigint").alias("total_duration"),
        *extra,
    )


# --- quantiles over time ------------------------------------------------------------------------------------------

# Fixed value: the error in rank of a merged sketch of this size, at 99 % confidence, as its public description gives it.
SKETCH_K, SKETCH_ERROR = 400, 0.0067


def metric_sketches(df: DataFrame, metric: str, ts: str = "ts", span: str = "1 hour", k: int = SKETCH_K) -> DataFrame:
    """A quantile sketch for each job and span: ``job_name, span_start, samples, sketch``.

    A sketch has a size that hardly grows with its samples, and those of any spans can be merged, so samples are read once
    and quantiles of a day or a month come from hourly sketches.
    """
    value = F.col(metric).cast("bigint")
    spans = df.where(value.isNotNull()).groupBy("job_name", F.window(ts, span)["start"].alias("span_start"))
    return spans.agg(F.count("*").alias("samples"), F.kll_sketch_agg_bigint(value, k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, by: list[str], ranks: list[float]) -> DataFrame:
    """Quantiles of merged sketches: ``<by>, samples, quantiles``, in the order of ``ranks``; no sample is read again."""
    merged = sketches.groupBy(*by).agg(F.sum("samples").alias("samples"), F.kll_merge_agg_bigint("sketch").alias("_merged"))
    wanted = F.array(*[F.lit(float(r)) for r in ranks])
    return merged.select(*by, "samples", F.kll_sketch_get_quantile_bigint("_merged", wanted).alias("quantiles"))
