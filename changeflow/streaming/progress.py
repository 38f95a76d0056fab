"""Metric samples from running queries, in the form the monitoring operators read."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SAMPLE = (
    "job_name STRING, ts TIMESTAMP, num_restarts BIGINT, num_failed_checkpoints BIGINT, "
    "num_completed_checkpoints BIGINT, last_checkpoint_duration BIGINT"
)


class ProgressMetrics(StreamingQueryListener):
    """Keeps the counters of each named query and hands out their latest samples.

    A query that starts again under its name counts as restarted; one that ends with an error has failed to commit.
    """

    def __init__(self) -> None:
        self._names: dict[str, str] = {}
        self._starts: dict[str, int] = {}
        self._failed: dict[str, int] = {}
        self._completed: dict[str, int] = {}
        self._samples: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        name = event.name or str(event.id)
        self._names[str(event.runId)] = name
        self._starts[name] = self._starts.get(name, 0) + 1

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        self._completed[name] = self._completed.get(name, 0) + 1
        at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        self._add(name, at, int(progress.durationMs.get("triggerExecution", 0)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            name = self._names.get(str(event.runId), str(event.id))
            self._failed[name] = self._failed.get(name, 0) + 1
            # A query that fails for good makes no progress any more; the failure itself is a sample.
            self._add(name, datetime.now(UTC), 0)

    def _add(self, name: str, at: datetime, duration: int) -> None:
        restarts = self._starts.get(name, 1) - 1
        self._samples.append((name, at, restarts, self._failed.get(name, 0), self._completed.get(name, 0), duration))

    def drain(self, spark: SparkSession) -> DataFrame:
        """The samples since the last call: one per commit, so a handful per query and minute."""
        samples, self._samples = self._samples, []
        return spark.createDataFrame(samples, SAMPLE)
