from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from changeflow.operators.monitor import (
    CHECKPOINT_DURATION,
    RESTART_LOOP,
    alert,
    alert_state,
    alert_transitions,
    checkpoint_summary,
    counter_growth,
    increase,
    job_health,
    metric_latest,
    metric_series,
    offset_lag,
    silence,
    source_lag,
)

START = datetime(2024, 1, 1)


def at(minute: float) -> datetime:
    return START + timedelta(minutes=minute)


def samples(spark, rows):
    """Rows of (job, minute, restarts, duration)."""
    schema = """job_name STRING, ts TIMESTAMP_NTZ, num_restarts BIGINT, num_failed_checkpoints BIGINT,
        num_completed_checkpoints BIGINT, last_checkpoint_duration BIGINT"""
    return spark.createDataFrame([(j, at(m), r, 0, 1, d) for j, m, r, d in rows], schema)


def test_counter_growth_with_resets(spark):
    values = [(0.1, 5), (0.5, 7), (1.2, 7), (1.4, 2), (1.6, 3), (4.0, 1), (4.1, 1)]
    frame = samples(spark, [("j", m, v, 0) for m, v in values] + [("k", 0, 100, 0)])
    got = {(r.job_name, (r.minute - START).seconds // 60): r.growth for r in counter_growth(frame, "num_restarts").collect()}
    assert got == {("j", 0): 2, ("j", 1): 0 + 2 + 1, ("j", 4): 1, ("k", 0): 0}


def test_increase_slides(spark):
    frame = samples(spark, [("j", 0, 0, 0), ("j", 1, 4, 0), ("j", 7, 5, 0)])
    got = {(r.window_start - START).total_seconds() // 60: r.increase for r in increase(frame, "num_restarts").collect()}
    assert got[1] == 4 and got[-3] == 4 and got[-4] == 0 and got[3] == 1 and got[7] == 1 and 2 not in got
    assert all((r.window_end - r.window_start) == timedelta(minutes=5) for r in increase(frame, "num_restarts").collect())


def states(spark, flags, hold):
    frame = spark.createDataFrame([("j", at(m), f) for m, f in flags], "job_name STRING, minute TIMESTAMP_NTZ, hit BOOLEAN")
    return alert_state(frame, F.col("hit"), hold)


def test_alert_state_holds_before_it_fires(spark):
    flags = [(0, False), (1, True), (2, True), (3, True), (4, False), (5, True), (7, True), (8, True), (9, None)]
    got = {(r.minute - START).seconds // 60: r.state for r in states(spark, flags, 2).collect()}
    assert got == {0: "ok", 1: "pending", 2: "pending", 3: "firing", 4: "ok", 5: "pending", 7: "pending", 8: "pending", 9: "ok"}


def test_alert_transitions_close_over_gaps(spark):
    flags = [(0, True), (1, True), (5, False), (6, True), (9, True), (10, False)]
    got = sorted(((r.minute - START).seconds // 60, r.from_state, r.to_state) for r in alert_transitions(states(spark, flags, 1)).collect())
    assert got == [
        (0, "ok", "pending"), (1, "pending", "firing"), (2, "firing", "ok"),
        (6, "ok", "pending"), (7, "pending", "ok"), (9, "ok", "pending"), (10, "pending", "ok"),
    ]


def test_restart_loop_fires_above_three(spark):
    calm = [("calm", m, min(m, 3), 0) for m in range(10)]
    loop = [("loop", m, 2 * m, 0) for m in range(10)]
    got = alert(samples(spark, calm + loop), RESTART_LOOP).where("state = 'firing'").select("job_name").distinct().collect()
    assert [r.job_name for r in got] == ["loop"]


def test_checkpoint_duration_threshold_is_exclusive(spark):
    frame = samples(spark, [("edge", m, 0, 180_000) for m in range(5)] + [("slow", m, 0, 180_001) for m in range(5)])
    got = {}
    for row in alert(frame, CHECKPOINT_DURATION).collect():
        got.setdefault(row.job_name, []).append((row.minute, row.state))
    assert {s for _, s in got["edge"]} == {"ok"}
    assert [s for _, s in sorted(got["slow"])] == ["pending", "pending", "firing", "firing", "firing"]


def test_silence(spark):
    frame = samples(spark, [("j", m, 0, 0) for m in (0, 0.5, 1, 4.2, 5)] + [("k", 3, 0, 0)])
    got = [((r.silent_from - START).seconds // 60, (r.silent_until - START).seconds // 60, r.silent_minutes) for r in silence(frame, "job_name").collect()]
    assert got == [(2, 4, 2)]


def test_silence_of_a_job_that_stopped(spark):
    frame = samples(spark, [("j", 0, 0, 0), ("j", 3.5, 0, 0), ("k", 1, 0, 0), ("l", 9, 0, 0)])
    found = silence(frame, "job_name", now=F.lit(at(10.7))).collect()
    got = {(r.job_name, (r.silent_from - START).seconds // 60, r.silent_minutes, r.still_silent) for r in found}
    assert got == {("j", 1, 2, False), ("j", 4, 6, True), ("k", 2, 8, True)}


def test_lags(spark):
    frame = samples(spark, [("j", 1, 0, 0), ("j", 0, 0, 0)])
    assert source_lag(frame, F.lit(at(2.5)), "job_name").first().lag_ms == 90_000
    log = spark.createDataFrame([("a", 10), ("a", 12), ("b", 5)], "job_name STRING, pos BIGINT")
    done = spark.createDataFrame([("a", 11), ("a", 3)], "job_name STRING, pos BIGINT")
    got = {r.job_name: (r.log_end, r.committed, r.lag) for r in offset_lag(log, done, "pos").collect()}
    assert got == {"a": (12, 11, 1), "b": (5, None, 6)}


def test_health_latest_and_summary(spark):
    frame = samples(spark, [("well", 0, 0, 10), ("well", 1, 0, 30), ("ill", 0, 0, 5), ("ill", 1, 1, 7)])
    assert {r.job_name: r.healthy for r in job_health(frame).collect()} == {"well": True, "ill": False}
    latest = {(r.job_name, r.metric): r.value for r in metric_latest(frame, ["num_restarts", "last_checkpoint_duration"]).collect()}
    assert latest == {("well", "num_restarts"): 0, ("well", "last_checkpoint_duration"): 30,
                      ("ill", "num_restarts"): 1, ("ill", "last_checkpoint_duration"): 7}
    assert metric_series(frame, ["num_restarts"]).count() == 4
    row = checkpoint_summary(frame, quantile=0.5).where("job_name = 'well'").first()
    assert (row.completed, row.samples, row.min_duration, row.max_duration, row.total_duration, row.duration_quantile) == (1, 2, 10, 30, 40, 10)


def test_metric_latest_skips_missing_values(spark):
    frame = spark.createDataFrame([("j", at(0), 4), ("j", at(1), None)], "job_name STRING, ts TIMESTAMP_NTZ, m BIGINT")
    assert metric_latest(frame, ["m"]).first().value == 4
