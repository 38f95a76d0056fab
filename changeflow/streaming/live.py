"""Live forms of operators that keep state: current state, lifecycle, silence and counter growth.

Aggregations reduce the input to one row per key, or per job and minute, before state written in Python sees it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from changeflow.streaming.sinks import FileTarget, StreamOptions, read_upsert, write_upsert

MINUTE_MS = 60_000

# The processors travel to the executors whole, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --- current state ------------------------------------------------------------------------------------------------


def write_state(
    changes: DataFrame,
    key_cols: list[str],
    value_cols: list[str],
    pos: str,
    deleted: Column,
    topic: str,
    target: FileTarget,
    options: StreamOptions,
) -> StreamingQuery:
    """Fold a stream of changes into the state of its keys, which is kept in versions and not in the query.

    Deleted keys stay in the state as tombstones, so an older update that arrives late cannot bring a row back.
    """
    return write_upsert(changes, key_cols, value_cols, pos, deleted, topic, target, options)


def read_state(spark: SparkSession, target: FileTarget, topic: str) -> DataFrame:
    """The live rows ``key, value`` that ``write_state`` has committed."""
    return read_upsert(spark, target, topic).select("key", "value")


# --- lifecycle ----------------------------------------------------------------------------------------------------

# What may follow an op: a create or a snapshot read opens a row, a delete closes it.
_LIVE = ("c", "r", "u")
_AFTER_LIVE = ("u", "d")
_AFTER_NONE = ("c", "r")
_FOUND = "id BIGINT, pos BIGINT, prev_op STRING, op STRING, late BOOLEAN"


class _Judge:
    """Tells which changes of a key do not fit the one before them, given the last change of the key so far."""

    def __init__(self, last: tuple[int | None, str | None]) -> None:
        self.pos, self.op = last

    def __call__(self, key: int, changes: list[tuple[int, str]]) -> Iterator[Row]:
        for pos, op in changes:
            if self.pos is not None and pos <= self.pos:
                # The order moves on from the last change, not from one that came too late.
                yield Row(id=key, pos=pos, prev_op=self.op, op=op, late=True)
                continue
            if op not in (_AFTER_LIVE if self.op in _LIVE else _AFTER_NONE):
                yield Row(id=key, pos=pos, prev_op=self.op, op=op, late=False)
            self.pos, self.op = pos, op


class _Lifecycle(StatefulProcessor):
    def __init__(self, once: bool = False) -> None:
        self.once = once  # one change stands for all of its position

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "pos LONG, op STRING")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # The changes of one key in one batch; the source limits what a batch admits.
        judge = _Judge(self.last.get() if self.last.exists() else (None, None))
        changes = sorted((row["pos"], row["op"]) for row in rows)
        yield from judge(key[0], list(dict(changes).items()) if self.once else changes)
        self.last.update((judge.pos, judge.op))

    def close(self) -> None:
        pass


def lifecycle_live(changes: DataFrame, key: str, pos: str = "pos", op: str = "op") -> DataFrame:
    """Changes of a stream that do not fit the one before them in their key: ``id, pos, prev_op, op, late``.

    Changes are judged as they come; ``late`` marks a change that came in a batch after a later one of its key. Read the source
    with a limit per batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``): a task holds the changes of one key in one batch.
    """
    if not changes.isStreaming:
        raise ValueError("lifecycle_live takes a stream; lifecycle_violations takes a batch")
    rows = changes.select(F.col(key).cast("bigint").alias("id"), F.col(pos).alias("pos"), F.col(op).alias("op"))
    return rows.groupBy("id").transformWithState(
        statefulProcessor=_Lifecycle(), outputStructType=_FOUND, outputMode="Append", timeMode="None"
    )


def lifecycle_ordered(
    changes: DataFrame, key: str, ts: str, delay: str, pos: str = "pos", op: str = "op", bin_seconds: int = 60
) -> DataFrame:
    """Changes that do not fit the one before them in their key, in the order of the log: ``id, pos, prev_op, op, late``.

    Changes may come out of order by up to ``delay`` of event time. Those of a key and bin of ``bin_seconds`` wait in an aggregate
    until the watermark has passed the bin; a bin comes out after all before it, so a key keeps its last change alone. Later
    changes are dropped by the watermark, and one change stands for all of its position. A row without an op is a heartbeat that
    only moves the watermark, so the end of a stream is judged too. ``ts`` does not fall as ``pos`` rises in a key.
    """
    if not changes.isStreaming:
        raise ValueError("lifecycle_ordered takes a stream; lifecycle_violations takes a batch")
    rows = changes.select(
        F.col(key).cast("bigint").alias("id"), F.col(pos).alias("pos"), F.col(op).alias("op"), F.col(ts).cast("timestamp").alias("_ts")
    ).withWatermark("_ts", delay)
    known = F.when(F.col("op").isNotNull(), F.struct("pos", "op"))
    binned = rows.groupBy("id", F.window("_ts", f"{bin_seconds} seconds")).agg(F.collect_set(known).alias("changes"))
    return binned.select("id", F.inline("changes")).groupBy("id").transformWithState(
        statefulProcessor=_Lifecycle(once=True), outputStructType=_FOUND, outputMode="Append", timeMode="None"
    )


# --- per job and minute -------------------------------------------------------------------------------------------


def _millis(column: Column) -> Column:
    return F.unix_millis(column)


class _Silence(StatefulProcessor):
    def __init__(self, hold_ms: int) -> None:
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "minute LONG, timer LONG, raised BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One row per minute with traffic.
        minutes = sorted(m for part in rows for m in part["minute"])
        last, timer, raised = self.last.get() if self.last.exists() else (None, None, False)
        out = []
        for minute in minutes:
            if last is not None and minute > last + MINUTE_MS:
                out.append((key[0], last + MINUTE_MS, minute))
            last = minute if last is None else max(last, minute)
        if timer is not None and not raised:
            self.handle.deleteTimer(timer)
        timer = last + MINUTE_MS + self.hold_ms
        self.handle.registerTimer(timer)
        self.last.update((last, timer, False))
        if out:
            yield pd.DataFrame(out, columns=["job_name", "from_ms", "until_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, timer, _ = self.last.get()
        if expiredTimerInfo.getExpiryTimeInMs() != timer:
            return
        self.last.update((last, timer, True))
        yield pd.DataFrame([(key[0], last + MINUTE_MS, None)], columns=["job_name", "from_ms", "until_ms"]).astype(
            {"until_ms": "Int64"}
        )

    def close(self) -> None:
        pass


def silence_live(events: DataFrame, job: str, ts: str, delay: str = "1 minute", hold_minutes: int = 1) -> DataFrame:
    """Silent spans of each job on a stream: ``job_name, silent_from, silent_until``.

    A span that goes on when ``hold_minutes`` of event time have passed is reported with a null end, and again with its
    end once the job is back. Events are first counted per job and minute, so a busy job costs its state one row a
    minute.
    """
    minutes = (
        events.select(F.col(job).alias("job_name"), F.col(ts).cast("timestamp").alias("_ts"))
        .withWatermark("_ts", delay)
        .groupBy("job_name", F.window("_ts", "1 minute").alias("_w"))
        .agg(F.count("*").alias("n"))
        .select("job_name", _millis(F.col("_w")["start"]).alias("minute"))
    )
    spans = minutes.groupBy("job_name").transformWithStateInPandas(
        statefulProcessor=_Silence(hold_minutes * MINUTE_MS),
        outputStructType="job_name STRING, from_ms BIGINT, until_ms BIGINT",
        outputMode="Append",
        timeMode="EventTime",
    )
    return spans.select(
        "job_name",
        F.timestamp_millis("from_ms").alias("silent_from"),
        F.timestamp_millis("until_ms").alias("silent_until"),
    )


def _step(before: Column, value: Column) -> Column:
    """Growth from one value of a counter to the next; a smaller one is a reset and counts whole."""
    return F.when(value < before, value).otherwise(value - before)


class _Minutes(StatefulProcessor):
    """Joins the segments of a job in their order: the growth between two segments belongs to the minute of the later one.

    A segment comes out after all before it, so a job keeps its last value and the minute that is not over.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "value LONG")
        self.minute = handle.getValueState("minute", "minute LONG, growth LONG")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = pd.concat(list(rows)).sort_values("bin")
        first, last = parts["first"].to_numpy("int64"), parts["last"].to_numpy("int64")
        before = np.concatenate([[self.last.get()[0] if self.last.exists() else first[0]], last[:-1]])
        grown = parts["growth"].to_numpy("int64") + np.where(first < before, first, first - before)
        minutes, starts = np.unique(parts["bin"].to_numpy("int64") // MINUTE_MS * MINUTE_MS, return_index=True)
        grown = np.add.reduceat(grown, starts)
        self.last.update((int(last[-1]),))
        if self.minute.exists():
            held, growth = self.minute.get()
            self.minute.clear()
            self.handle.deleteTimer(held + MINUTE_MS)
            if held == minutes[0]:
                grown[0] += growth
            else:
                minutes, grown = np.concatenate([[held], minutes]), np.concatenate([[growth], grown])
        if minutes[-1] + MINUTE_MS > timerValues.getCurrentWatermarkInMs():
            self.minute.update((int(minutes[-1]), int(grown[-1])))
            self.handle.registerTimer(int(minutes[-1]) + MINUTE_MS)
            minutes, grown = minutes[:-1], grown[:-1]
        if len(minutes):
            yield self._found(key, minutes, grown)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.minute.exists():
            minute, growth = self.minute.get()
            self.minute.clear()
            yield self._found(key, np.array([minute]), np.array([growth]))

    @staticmethod
    def _found(key, minutes: np.ndarray, grown: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"job_name": pd.Series([key[0]] * len(minutes), dtype=object), "minute_ms": minutes, "growth": grown})

    def close(self) -> None:
        pass


def counter_segments(samples: DataFrame, metric: str, ts: str = "ts", delay: str = "1 minute", bin_seconds: int = 10) -> DataFrame:
    """Segments of a counter on a stream, one for each job and bin: ``job_name, bin, at, first, last, growth``.

    A segment is what two neighbours need to be joined: first and last value, and the growth inside. Samples of a job and bin wait in
    an aggregate until the watermark has passed the bin, so a job with a third of all samples is spread over as many keys as it has
    bins. Of samples at one instant the largest stands. A sample without a value is a heartbeat that only moves the watermark.
    """
    rows = samples.select(
        "job_name", F.col(ts).cast("timestamp").alias("_ts"), F.col(metric).cast("bigint").alias("value")
    ).withWatermark("_ts", delay)
    known = F.when(F.col("value").isNotNull(), F.struct(F.unix_micros("_ts").alias("us"), "value"))
    binned = rows.groupBy("job_name", F.window("_ts", f"{bin_seconds} seconds").alias("_w")).agg(F.array_sort(F.collect_set(known)).alias("_all"))
    # The last of an instant is the one whose follower has another.
    stands = F.filter("_all", lambda x, i: F.coalesce(F.get("_all", i + 1)["us"] != x["us"], F.lit(True)))
    values = binned.withColumn("_v", F.transform(stands, lambda x: x["value"])).where(F.size("_v") > 0)
    steps = F.zip_with(F.slice("_v", 1, F.size("_v") - 1), F.slice("_v", 2, F.size("_v") - 1), _step)
    return values.select(
        "job_name",
        _millis(F.col("_w")["start"]).alias("bin"),
        F.col("_w")["end"].alias("at"),
        F.col("_v")[0].alias("first"),
        F.element_at("_v", -1).alias("last"),
        F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("growth"),
    )


def counter_growth_live(samples: DataFrame, metric: str, ts: str = "ts", delay: str = "1 minute", bin_seconds: int = 10) -> DataFrame:
    """Growth of a counter per job and minute on a stream: ``job_name, minute, growth``.

    A minute is closed when the watermark has passed it; later samples of it are dropped. Samples become segments of
    ``bin_seconds``, a divisor of a minute, and only segments meet in the state of a job.
    """
    grown = growth_minutes(samples, metric, ts, delay, bin_seconds)
    return grown.select("job_name", F.timestamp_millis("minute_ms").alias("minute"), "growth")


def growth_minutes(samples: DataFrame, metric: str, ts: str, delay: str, bin_seconds: int) -> DataFrame:
    """``counter_growth_live`` with what the next operator on a stream needs: ``job_name, minute_ms, growth``."""
    segments = counter_segments(samples, metric, ts, delay, bin_seconds).select("job_name", "bin", "first", "last", "growth")
    return segments.groupBy("job_name").transformWithStateInPandas(
        statefulProcessor=_Minutes(),
        outputStructType="job_name STRING, minute_ms BIGINT, growth BIGINT",
        outputMode="Append",
        timeMode="EventTime",
    )
