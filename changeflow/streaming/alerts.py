"""Alert rules on a stream: one state machine a job, moved on by event time.

What a rule looks at is reduced to one row per job and minute first. The machine of a job holds the minutes of the rule's window and
since when a breach lasts, and is evaluated at the end of each minute that the watermark has passed, so the order in which
samples come does not matter: minutes come out after all before them, and a batch of them is worked off in one pass. The states are those of the batch form, ``operators.monitor.alert``.
"""

from __future__ import annotations

import heapq
import sys
from collections import deque
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changeflow.operators.monitor import AlertRule
from changeflow.streaming.live import MINUTE_MS, growth_minutes

# The processors travel to the executors whole, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OK, PENDING, FIRING = "ok", "pending", "firing"
# Rows that a job hands out at once.
ROWS = 10_000


class _Alert(StatefulProcessor):
    """Rows (minute_ms: start of a minute, value, known) of a job to rows (minute_ms: when evaluated, value, state).

    ``minutes`` is how many minutes a window sums up, 1 for a gauge.
    """

    def __init__(self, minutes: int, above: int, hold_minutes: int, transitions: bool) -> None:
        self.minutes, self.above, self.hold_ms, self.transitions = minutes, above, hold_minutes * MINUTE_MS, transitions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getMapState("values", "minute LONG", "value LONG")  # the end of the log alone
        self.last = handle.getValueState("last", "at LONG, since LONG, state STRING")
        self.timer = handle.getValueState("timer", "ms LONG")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = pd.concat(list(rows))
        if key[0] is not None:  # else a heartbeat
            yield from self._move(key, parts, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._move(key, None, timerValues.getCurrentWatermarkInMs())

    def _move(self, key, parts: pd.DataFrame | None, until: int) -> Iterator[pd.DataFrame]:
        """Evaluate all that the watermark has passed, in one pass over the minutes that are new."""
        held = {minute: value for (minute,), (value,) in list(self.values.iterator())}
        rows = sorted(held.items())
        if parts is not None:
            parts = parts.sort_values("minute_ms")
            new = zip(parts["minute_ms"].array, parts["value"].array, parts["known"].array)
            rows = heapq.merge(rows, ((int(m), int(v) if known else None) for m, v, known in new), key=lambda row: row[0])
        at, since, state = self.last.get() if self.last.exists() else (None, None, OK)
        inside: deque[tuple[int, int | None]] = deque()
        out = []
        rows = chain(rows, [None])
        row = next(rows)
        while row is not None:
            inside.append(row)
            minute, row = row[0], next(rows)
            for k in range(1, self.minutes + 2):
                now = minute + k * MINUTE_MS
                if now > until or row is not None and now > row[0]:
                    break
                if at is not None and now <= at:
                    continue
                while inside and inside[0][0] < now - self.minutes * MINUTE_MS:
                    inside.popleft()
                seen = [v for m, v in inside if m < now]
                known = [v for v in seen if v is not None]
                value = sum(known) if known else None
                before, state = state, OK
                if value is not None and value > self.above:
                    since = now if since is None or at != now - MINUTE_MS else since
                    state = FIRING if now >= since + self.hold_ms else PENDING
                else:
                    since = None
                at = now
                if self.transitions:
                    if state != before:
                        out.append((key[0], now, before, state))
                elif seen:
                    out.append((key[0], now, value, state))
                if len(out) == ROWS:
                    yield self._found(out)
                    out = []
        if out:
            yield self._found(out)
        if at is not None:
            self.last.update((at, since, state))
        kept = {m: v for m, v in inside if m + (self.minutes + 1) * MINUTE_MS > until}
        for minute in held.keys() - kept.keys():
            self.values.removeKey((minute,))
        for minute in kept.keys() - held.keys():
            self.values.updateValue((minute,), (kept[minute],))
        self._wait_for(max(min(kept) + MINUTE_MS, until // MINUTE_MS * MINUTE_MS + MINUTE_MS) if kept else None)

    def _found(self, rows: list[tuple]) -> pd.DataFrame:
        if self.transitions:
            return pd.DataFrame(rows, columns=["job_name", "minute_ms", "from_state", "to_state"])
        found = pd.DataFrame(rows, columns=["job_name", "minute_ms", "value", "state"], dtype=object)
        return found.astype({"minute_ms": "int64", "value": "Int64"})

    def _wait_for(self, ms: int | None) -> None:
        """One timer a job, for the next minute that is due."""
        old = self.timer.get()[0] if self.timer.exists() else None
        if old == ms:
            return
        if old is not None:
            self.handle.deleteTimer(old)
            self.timer.clear()
        if ms is not None:
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def close(self) -> None:
        pass


def _rule_minutes(samples: DataFrame, rule: AlertRule, ts: str, delay: str, bin_seconds: int) -> tuple[DataFrame, int]:
    """What a rule looks at, one row per job and minute, and how many minutes it sums up."""
    if rule.over:
        count, unit = rule.over.split()
        if not unit.startswith("minute"):
            raise ValueError(f"a window of whole minutes, not {rule.over!r}")
        minutes = growth_minutes(samples, rule.metric, ts, delay, bin_seconds)
        return minutes.withColumnRenamed("growth", "value"), int(count)
    rows = samples.select("job_name", F.col(ts).cast("timestamp").alias("_ts"), F.col(rule.metric).cast("bigint").alias("_value"))
    last = rows.withWatermark("_ts", delay).groupBy("job_name", F.window("_ts", "1 minute").alias("_w"))
    last = last.agg(F.max_by("_value", "_ts").alias("value"))
    return last.select("job_name", F.unix_millis(F.col("_w")["start"]).alias("minute_ms"), "value"), 1


def alert_live(samples: DataFrame, rule: AlertRule, ts: str = "ts", delay: str = "1 minute", bin_seconds: int = 10) -> DataFrame:
    """A rule on a stream of samples: ``job_name, minute, value, state`` of every minute that the watermark has passed.

    A minute without data in the rule's window is ok and is not reported. A sample without a job is a heartbeat that only moves the
    watermark; without one, a job that stops is evaluated as far as the samples of other jobs have moved it.
    """
    out = "job_name STRING, minute_ms BIGINT, value BIGINT, state STRING"
    return _machine(samples, rule, ts, delay, bin_seconds, False, out).select(
        "job_name", F.timestamp_millis("minute_ms").alias("minute"), "value", "state"
    )


def alert_transitions_live(samples: DataFrame, rule: AlertRule, ts: str = "ts", delay: str = "1 minute", bin_seconds: int = 10) -> DataFrame:
    """Changes of the state of a job as they come about: ``job_name, minute, from_state, to_state``.

    Every job starts as ok. A job whose data ends goes to ok a minute after the window that held the last of it.
    """
    out = "job_name STRING, minute_ms BIGINT, from_state STRING, to_state STRING"
    return _machine(samples, rule, ts, delay, bin_seconds, True, out).select(
        "job_name", F.timestamp_millis("minute_ms").alias("minute"), "from_state", "to_state"
    )


def _machine(samples: DataFrame, rule: AlertRule, ts: str, delay: str, bin_seconds: int, transitions: bool, out: str) -> DataFrame:
    if not samples.isStreaming:
        raise ValueError("live alerts take a stream; alert takes a batch")
    minutes, width = _rule_minutes(samples, rule, ts, delay, bin_seconds)
    # A null among numbers would make floats of them.
    known = minutes.select("job_name", "minute_ms", F.coalesce("value", F.lit(0)).alias("value"), F.col("value").isNotNull().alias("known"))
    return known.groupBy("job_name").transformWithStateInPandas(
        statefulProcessor=_Alert(width, rule.above, rule.hold_minutes, transitions),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
    )
