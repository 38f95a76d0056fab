"""Sinks for topic records: append, upsert, routed, and several sinks in one recovery unit.

Files are exactly once: a batch that runs again after a failure replaces what it wrote before. Kafka is at least once,
so its consumers drop repeated deliveries by id. Batches become visible when they are committed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from changeflow.operators.changelog import compact
from changeflow.operators.envelope import to_upsert_record
from changeflow.streaming.delivery import with_headers
from changeflow.streaming.versioned import VersionedState

# Fixed value: seconds between two commits of a job.
COMMIT_INTERVAL = "30 seconds"


@dataclass(frozen=True)
class StreamOptions:
    """Where a job keeps its progress and how often it commits.

    The checkpoint and the name of the query follow from prefix and suffix, so that two deployments never share one. A
    query commits one batch at a time, and its checkpoint stays when it is stopped. ``interval`` None works off what is
    there and ends.
    """

    prefix: str
    suffix: str
    checkpoint_root: str
    interval: str | None = COMMIT_INTERVAL

    def __post_init__(self) -> None:
        for name in ("prefix", "suffix", "checkpoint_root"):
            if not getattr(self, name).strip():
                raise ValueError(f"{name} must not be blank")

    @property
    def query_name(self) -> str:
        return f"{self.prefix}-{self.suffix}"

    @property
    def checkpoint(self) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{self.query_name}"

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.queryName(self.query_name).option("checkpointLocation", self.checkpoint)
        return writer.trigger(processingTime=self.interval) if self.interval else writer.trigger(availableNow=True)


@dataclass(frozen=True)
class FileTarget:
    """Topics as directories of parquet files, which several jobs may share.

    Each job writes below a folder of its own, ``<path>/records/job=<job>/topic=<topic>``, since the commit log of a file
    sink belongs to one query; a second query in the same folder would take batches of the first for its own.
    ``<path>/jobs`` names the jobs, so that readers unite what each has committed. ``buckets`` is the number of parts an upsert topic
    is folded in.
    """

    path: str
    buckets: int = 16

    def records_of(self, job: str) -> str:
        return f"{self.path}/records/job={quote(job, safe='')}"

    def state_of(self, job: str, topic: str) -> VersionedState:
        """The versioned state that a job keeps of an upsert topic."""
        return VersionedState(f"{self.path}/states/job={quote(job, safe='')}/topic={quote(topic, safe='')}", self.buckets)

    def enter(self, spark: SparkSession, job: str) -> str:
        """Name a job in the target; returns the folder of its records. Entering again changes nothing."""
        one = spark.range(1).select(F.lit(job).alias("name"))
        one.write.mode("overwrite").parquet(f"{self.path}/jobs/{quote(job, safe='')}")
        return self.records_of(job)


@dataclass(frozen=True)
class KafkaTarget:
    """Topics of a broker; the Kafka package of Spark is on the classpath."""

    servers: str


Target = FileTarget | KafkaTarget


def _start(records: DataFrame, target: Target, options: StreamOptions) -> StreamingQuery:
    writer = options.apply(records.writeStream.outputMode("append"))
    if isinstance(target, KafkaTarget):
        records = with_headers(records) if "offset" in records.columns else records
        wire = [c for c in ("topic", "key", "value", "headers") if c in records.columns]
        kafka = records.select(*wire).writeStream.outputMode("append").format("kafka")
        return options.apply(kafka.option("kafka.bootstrap.servers", target.servers)).start()
    folder = target.enter(records.sparkSession, options.query_name)
    return writer.format("parquet").partitionBy("topic").start(folder)


def write_append(df: DataFrame, topic: str, target: Target, options: StreamOptions, value: str = "value") -> StreamingQuery:
    """One record per change to one topic, value only; nothing is shuffled."""
    return _start(df.select(F.lit(topic).alias("topic"), F.col(value).alias("value")), target, options)


def write_upsert(
    df: DataFrame,
    key_cols: list[str],
    value_cols: list[str],
    pos: str,
    deleted: Column,
    topic: str,
    target: Target,
    options: StreamOptions,
) -> StreamingQuery:
    """Changes to one upsert topic: the last value of each key, or null for a delete."""
    records = to_upsert_record(df.withColumn("_deleted", deleted), key_cols, value_cols, F.col("_deleted"))
    records = records.select(F.lit(topic).alias("topic"), F.col(pos).alias("offset"), "key", "value")
    return write_keyed(records, [topic], target, options)


def write_keyed(records: DataFrame, topics: list[str], target: Target, options: StreamOptions) -> StreamingQuery:
    """Keyed records ``topic, offset, key, value`` to upsert topics, each batch folded to one record a key and topic.

    Files keep a versioned state for each topic, so reading one does not cost its history. A broker gets the records of a key
    in the order of the batches, and no two from one batch, whichever task sends them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if isinstance(target, KafkaTarget):
            last = compact(batch.select("topic", "offset", "key", "value"), ["topic", "key"], "offset")
            kafka = with_headers(last).select("topic", "key", "value", "headers").write.format("kafka")
            kafka.option("kafka.bootstrap.servers", target.servers).save()
            return
        if len(topics) > 1:
            batch = batch.select(*[F.col(c).alias(c) for c in batch.columns]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for topic in topics:
                target.state_of(options.query_name, topic).apply(batch.where(F.col("topic") == topic), batch_id)
        finally:
            if len(topics) > 1:
                batch.unpersist()

    if isinstance(target, FileTarget):
        target.enter(records.sparkSession, options.query_name)
    return options.apply(records.writeStream.outputMode("append").foreachBatch(write)).start()


def _jobs(spark: SparkSession, target: FileTarget) -> list[str]:
    """The jobs that have entered a target: one short row each."""
    return sorted(r.name for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{target.path}/jobs").collect())


def read_topic(spark: SparkSession, target: FileTarget, topic: str | None = None) -> DataFrame:
    """The records of one topic (only its directories are read), or of all, as far as the jobs have committed them."""
    written = [frame for frame in (_committed_by(spark, target, job) for job in _jobs(spark, target)) if frame is not None]
    if not written:
        raise ValueError(f"no job has committed records to {target.path}")
    records = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), written)
    return records if topic is None else records.where(F.col("topic") == topic)


def _committed_by(spark: SparkSession, target: FileTarget, job: str) -> DataFrame | None:
    """The records of a job; None where it has not committed any."""
    path = target.records_of(job)
    try:
        # Topics are texts, also those that look like numbers or dates; a file knows its own columns.
        columns = [f for f in spark.read.parquet(path).schema.fields if f.name != "topic"]
        return spark.read.schema(T.StructType([*columns, T.StructField("topic", T.StringType())])).parquet(path)
    except AnalysisException as e:
        # A sink that has committed no rows has files of its own but none with a schema.
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") or "Unable to infer schema" in str(e):
            return None
        raise


def read_upsert(spark: SparkSession, target: FileTarget, topic: str) -> DataFrame:
    """The live rows of an upsert topic: the last value of each key that has one.

    One job's versioned state is read as it is; records of append jobs and states of several jobs are folded by position.
    """
    states, logs = [], []
    for job in _jobs(spark, target):
        state = target.state_of(job, topic)
        version, records = state.current(spark), _committed_by(spark, target, job)
        if version is not None:
            states.append(state.records(spark, version))
        if records is not None:
            logs.append(records.where(F.col("topic") == topic).select("key", "offset", "value"))
    if not states + logs:
        raise ValueError(f"no job has committed records to {target.path}")
    rows = reduce(DataFrame.unionByName, states + logs)
    folded = rows if len(states) == 1 and not logs else compact(rows, ["key"], "offset")
    return folded.where(F.col("value").isNotNull())


def write_routed(df: DataFrame, target: Target, options: StreamOptions, files_per_topic: int | None = None) -> StreamingQuery:
    """Each record to the topic it names.

    Every task writes what it holds, so a topic with most of the records is written by all of them. With thousands of
    topics that makes many small files; ``files_per_topic`` then gathers each topic in that many tasks instead of one.
    """
    records = df.select(*[c for c in ("topic", "offset", "key", "value") if c in df.columns])
    if files_per_topic and isinstance(target, FileTarget):
        salt = F.pmod(F.xxhash64("value"), F.lit(files_per_topic))
        records = records.withColumn("_salt", salt).repartition("topic", "_salt").drop("_salt")
    return _start(records, target, options)


# --- several sinks, one recovery unit -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Statement:
    """What one sink receives from each batch: topic records ``key, value`` (and ``offset``)."""

    topic: str
    select: Callable[[DataFrame], DataFrame]


def run_statement_set(
    source: DataFrame,
    statements: list[Statement],
    target: Target,
    options: StreamOptions,
    output_mode: str = "append",
) -> StreamingQuery:
    """Feed several sinks from one source with one checkpoint. Jobs that share a target have topics and commits of their own.

    The batch is read once and kept for all sinks. A batch that failed between two sinks runs again and replaces its
    own directories; ``read_committed`` shows a batch only once all of its sinks have it.
    """

    job = quote(options.query_name, safe="")

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(statements) > 1:
            # Under names of its own: the batch of a stateful query may claim an order over columns it does not have,
            # and a plan with such an order cannot be found again among the persisted ones.
            batch = batch.select(*[F.col(c).alias(c) for c in batch.columns]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for statement in statements:
                _write_batch(statement.select(batch), statement.topic, target, job, batch_id)
            if isinstance(target, FileTarget):
                marker = batch.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("committed"))
                marker.write.mode("overwrite").parquet(f"{target.path}/commits/job={job}/batch_id={batch_id}")
        finally:
            if len(statements) > 1:
                batch.unpersist()

    return options.apply(source.writeStream.outputMode(output_mode).foreachBatch(write)).start()


def _write_batch(records: DataFrame, topic: str, target: Target, job: str, batch_id: int) -> None:
    if isinstance(target, KafkaTarget):
        kafka = records.select(F.lit(topic).alias("topic"), "key", "value").write.format("kafka")
        kafka.option("kafka.bootstrap.servers", target.servers).save()
    else:
        records.write.mode("overwrite").parquet(f"{target.path}/topics/topic={topic}/job={job}/batch_id={batch_id}")


def read_committed(spark: SparkSession, target: FileTarget, topic: str) -> DataFrame:
    """The records of a topic from batches that reached every sink of their job."""
    records = spark.read.option("basePath", f"{target.path}/topics").parquet(f"{target.path}/topics/topic={topic}")
    commits = spark.read.parquet(f"{target.path}/commits")
    return records.join(commits, ["job", "batch_id"], "left_semi").drop("job", "batch_id")


def resume(start: Callable[[StreamOptions], StreamingQuery], options: StreamOptions) -> StreamingQuery:
    """Start a query again from its checkpoint: what it has committed is neither read nor written a second time."""
    return start(options)
