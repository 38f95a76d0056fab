"""Queries that run a stream over the given tables to its end and read back what its sink holds."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.topics import topic_name
from changeflow.operators.changelog import dedup_events
from changeflow.operators.enrich import tag_event
from changeflow.operators.envelope import parse_envelope, parse_flat, source_struct, to_envelope, to_upsert_record
from changeflow.operators.monitor import CHECKPOINT_DURATION, RESTART_LOOP, AlertRule
from changeflow.operators.route import route_outbox
from changeflow.plans.declared import patterns, run_pipeline, upsert_records, with_paths
from changeflow.plans.expected import with_inputs
from changeflow.plans.queries_audit import OUTBOX_PARITY, dual_outbox
from changeflow.plans.queries_changelog import FOLD
from changeflow.plans.queries_format import NOW, STREAM_PREFIX
from changeflow.plans.queries_monitor import alert_sql
from changeflow.plans.registry import query
from changeflow.session import work_dir
from changeflow.sources import derived
from changeflow.sources.tables import CUSTOMERS, ORDERS, read_parquet_stream
from changeflow.streaming.alerts import alert_live
from changeflow.streaming.delivery import HEADERS, from_headers, newer_only, with_headers
from changeflow.streaming.live import counter_growth_live, lifecycle_live, lifecycle_ordered, read_state, silence_live, write_state
from changeflow.streaming.parity import parity_outbox_live
from changeflow.streaming.sinks import (
    FileTarget,
    Statement,
    StreamOptions,
    read_committed,
    read_topic,
    read_upsert,
    resume,
    run_statement_set,
    write_append,
    write_keyed,
    write_routed,
    write_upsert,
)


def append_part(rows: DataFrame, by: str, path: str, write: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Append a part of a log, as ``write`` makes its records of the rows, in a file a core.

    A stretch of a table lies in few of its files; rows are dealt before records are made of them, or few tasks would do it.
    """
    write(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, by)).write.mode("append").parquet(path)


def files_a_batch(spark: SparkSession, path: str, parts: int) -> int:
    """How many files of a log that was written in so many parts a batch takes, so that there are about as many batches as parts.

    A batch costs what its rows and the state cost: it goes over all that waits for the watermark, and calls upon each key
    once. Were a batch a file, a larger log would have more of them and each would cost more.
    """
    files = len(spark.read.schema("value STRING").parquet(path).inputFiles())
    return max(1, -(-files // parts))


def _unit(spark: SparkSession, suffix: str) -> tuple[FileTarget, StreamOptions]:
    root = work_dir(spark, suffix)
    return FileTarget(f"{root}/out"), StreamOptions("shop", suffix, f"{root}/checkpoints", interval=None)


@query(
    "sink_append",
    with_inputs(
        "f_out",
        select="""SELECT id, destination, 'shop.stream.datastream.orders' AS topic, 'datastream-cdc' AS variant FROM f_out""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    target, options = _unit(spark, "append")
    changes = derived.outbox_envelopes(read_parquet_stream(spark, folder, "events"))
    topic = f"{STREAM_PREFIX}.datastream.orders"
    write_append(tag_event(changes, STREAM_PREFIX), topic, target, options).awaitTermination()
    records = read_topic(spark, target, topic)
    fields = F.from_json("value", "after STRUCT<id: BIGINT, destination: STRING>, variant STRING")
    return records.withColumn("e", fields).select("e.after.id", "e.after.destination", "topic", "e.variant")


@query(
    "sink_upsert",
    with_inputs(
        "f_log", select=FOLD.format(cols="id, after_amount AS amount, after_status AS status", where="", live="AND op <> 'd'")
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    target, options = _unit(spark, "upsert")
    changes = derived.account_upserts(read_parquet_stream(spark, folder, "events"))
    columns = ["id", "amount", "status"]
    topic = f"{STREAM_PREFIX}.table-api.accounts"
    write_upsert(changes, ["id"], columns, "pos", F.col("op") == "d", topic, target, options).awaitTermination()
    return parse_flat(read_upsert(spark, target, topic), derived.ACCOUNT_ROW).select("row.*")


@query("sink_routed", with_inputs("f_out", select="SELECT id, 'poc.kc.outbox.' || destination AS topic FROM f_out"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    target, options = _unit(spark, "routed")
    changes = derived.outbox_envelopes(read_parquet_stream(spark, folder, "events"))
    write_routed(route_outbox(changes, now=NOW), target, options).awaitTermination()
    return read_topic(spark, target).select(F.get_json_object("value", "$.after.id").cast("bigint").alias("id"), "topic")


def _database_stream(spark: SparkSession, folder: str) -> DataFrame:
    return derived.database_envelopes(
        derived.order_rows(read_parquet_stream(spark, folder, "orders")),
        derived.customer_rows(read_parquet_stream(spark, folder, "customer")),
        read_parquet_stream(spark, folder, "events"),
    )


def sql_records(changes: DataFrame, prefix: str) -> DataFrame:
    """Keyed records of orders and customers: the texts are parsed here, once for all sinks."""
    return upsert_records(changes, [ORDERS, CUSTOMERS], "sql-api", f"{prefix}.sql-api")


def sql_statements(prefix: str) -> list[Statement]:
    """Orders and customers, each to a keyed topic of its own, out of ``sql_records``."""

    def of(topic):
        return lambda batch: batch.where(F.col("topic") == topic).select("key", "value", "offset")

    return [Statement(topic, of(topic)) for topic in (f"{prefix}.sql-api.{spec.name}" for spec in (ORDERS, CUSTOMERS))]


@query(
    "statement_set",
    with_inputs(
        "f_ord", "f_cust",
        select="""SELECT 'orders' AS sink, id, status AS label, 'sql-api' AS job_variant FROM f_ord
            UNION ALL SELECT 'customers', id, email, 'sql-api' FROM f_cust""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    target, options = _unit(spark, "statements")
    statements = sql_statements(STREAM_PREFIX)
    records = sql_records(_database_stream(spark, folder), STREAM_PREFIX)
    run_statement_set(records, statements, target, options).awaitTermination()
    sinks = []
    for name, statement in zip(("orders", "customers"), statements, strict=True):
        rows = parse_flat(read_committed(spark, target, statement.topic), "id BIGINT, status STRING, email STRING, job_variant STRING")
        label = "row.status" if name == "orders" else "row.email"
        sinks.append(rows.select(F.lit(name).alias("sink"), "row.id", F.col(label).alias("label"), "row.job_variant"))
    return sinks[0].unionAll(sinks[1])


@query(
    "sink_envelope",
    with_inputs("f_ord", select="SELECT id, 'r' AS op, 'shop.stream.declared.orders' AS topic, FALSE AS tagged FROM f_ord"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    target, options = _unit(spark, "envelope")
    rows = derived.order_rows(read_parquet_stream(spark, folder, "orders"))
    topic = f"{STREAM_PREFIX}.declared.orders"
    write_append(to_envelope(derived.order_changes(rows)), topic, target, options).awaitTermination()
    parsed = parse_envelope(read_topic(spark, target, topic), "id BIGINT")
    tagged = F.get_json_object("value", "$.variant").isNotNull()
    return parsed.select("after.id", "op", "topic", tagged.alias("tagged"))


@query(
    "recovery_unit",
    """SELECT 'shop-recovery' AS query_name, CAST(count(*) AS BIGINT) AS records, TRUE AS checkpoint_kept FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    target, options = _unit(spark, "recovery")
    changes = derived.outbox_envelopes(read_parquet_stream(spark, folder, "events"))
    write_append(changes, "shop.recovery", target, options).awaitTermination()
    # The commit log of the query, one file per batch, is there after it has ended.
    commits = spark.read.text(f"{options.checkpoint}/commits").select(F.lit(0).alias("record"), F.lit(1).alias("commit"))
    records = read_topic(spark, target).select(F.lit(1).alias("record"), F.lit(0).alias("commit"))
    return records.unionAll(commits).agg(
        F.lit(options.query_name).alias("query_name"),
        F.sum("record").alias("records"),
        (F.sum("commit") > 0).alias("checkpoint_kept"),
    )


@query(
    "resume_no_dup",
    with_inputs(
        "f_out", select="SELECT id, CAST(1 AS BIGINT) AS emissions, destination FROM f_out"
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # The log grows while the job is down: each run finds a part of it that was not there before.
    target, options = _unit(spark, "resumed")
    events = derived.events(spark, folder)
    middle = F.lit(derived.SCHEMA_CHANGE).cast("timestamp_ntz")
    log = work_dir(spark, "growing-log")

    def start(unit: StreamOptions):
        growing = spark.readStream.schema(events.schema).parquet(log)
        return write_append(derived.outbox_envelopes(growing), "shop.resumed", target, unit)

    for part in (events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)):
        part.write.mode("append").parquet(log)
        resume(start, options).awaitTermination()
    fields = F.from_json("value", "after STRUCT<id: BIGINT, destination: STRING>")["after"]
    return (
        read_topic(spark, target, "shop.resumed")
        .select(fields.alias("row"))
        .groupBy("row.id", "row.destination")
        .agg(F.count("*").alias("emissions"))
    )


@query(
    "dedup_stream",
    "SELECT event_id AS id, event_type AS destination FROM events",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    target, options = _unit(spark, "dedup")
    events = read_parquet_stream(spark, folder, "events")
    copies = F.when(F.col("event_type") == "purchase", 2).otherwise(1)
    delivered = events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("destination"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    )
    once = dedup_events(delivered, ["id"], "ts", "1 hour")
    records = once.select(
        topic_name("shop.once", F.col("destination")).alias("topic"), F.to_json(F.struct("id", "destination")).alias("value")
    )
    write_routed(records, target, options).awaitTermination()
    return parse_flat(read_topic(spark, target), "id BIGINT, destination STRING").select("row.*")


# --- a log with updates and deletes, in many batches -------------------------------------------------------------------


def changing_orders(spark: SparkSession, folder: str, parts: int = 6) -> tuple[str, int]:
    """A written change log of orders and customers whose orders are updated and deleted; returns its folder and the files of a batch.

    Orders are read at position 0 and customers likewise. Then events change them in the order of their numbers: an error
    deletes the order of the event's user, any other event writes it with the event's value. Files hold stretches of the log, the
    later half of each before its earlier half, so positions come out of order within a batch and from one to the next.
    """
    path = work_dir(spark, "changing")
    events = derived.events(spark, folder).select("event_id", "user_id", "event_type", "value", "ts")
    last = events.agg(F.max("event_id")).first()[0] or 0
    row = F.struct(
        F.col("user_id").alias("id"),
        F.lit(None).cast("bigint").alias("customer_id"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("created_at"),
    )
    gone, pos = F.col("event_type") == "error", (F.col("event_id") + 1).cast("bigint")
    changes = events.select(
        F.col("event_id"),
        F.when(gone, row).alias("before"),
        F.when(~gone, row).alias("after"),
        F.when(gone, F.lit("d")).otherwise(F.lit("u")).alias("op"),
        source_struct(derived.DATABASE, ORDERS.name, F.lit(0).cast("bigint"), pos).alias("source"),
        F.lit(0).cast("bigint").alias("ts_ms"),
    )
    reads = [derived.order_changes(derived.orders(spark, folder)), derived.customer_changes(derived.customers(spark, folder))]
    for part in reads:
        start = part.withColumn("source", F.col("source").withField("pos", F.lit(0).cast("bigint")))
        append_part(start, "id", path, _texts)
    width = last // parts + 1
    for part in range(parts):
        # Halves change places: every second stretch comes before the one it follows.
        at = part + 1 if part % 2 == 0 and part + 1 < parts else part - 1 if part % 2 else part
        append_part(changes.where(F.col("event_id").between(at * width, at * width + width - 1)), "event_id", path, _texts)
    return path, files_a_batch(spark, path, len(reads) + parts)


def _texts(changes: DataFrame) -> DataFrame:
    return to_envelope(changes).select("value")


#: Orders after all changes: the last event of a user decides, and orders without events are as they were read.
_CHANGED = """changed AS (
    SELECT user_id AS id, event_type AS status, CAST(value AS DECIMAL(10,2)) AS amount FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
), final_orders AS (
    SELECT id, status, amount FROM changed WHERE status <> 'error'
    UNION ALL SELECT id, status, amount FROM f_ord WHERE id NOT IN (SELECT id FROM changed)
)"""


@query(
    "statement_set_ops",
    with_inputs(
        "f_ord", "f_cust",
        select=f"""WITH {_CHANGED} SELECT 'orders' AS sink, id, status AS label, amount FROM final_orders
            UNION ALL SELECT 'customers', id, email, NULL FROM f_cust""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Two keyed sinks fed by one job from a log with updates and deletes, in several batches."""
    target, options = _unit(spark, "statement-ops")
    path, files = changing_orders(spark, folder)
    log = spark.readStream.schema("value STRING").option("maxFilesPerTrigger", files).parquet(path)
    records, topics = sql_records(log, STREAM_PREFIX), [f"{STREAM_PREFIX}.sql-api.{spec.name}" for spec in (ORDERS, CUSTOMERS)]
    write_keyed(records, topics, target, options).awaitTermination()
    sinks = []
    for name, label, topic in zip(("orders", "customers"), ("status", "email"), topics, strict=True):
        rows = parse_flat(read_upsert(spark, target, topic), "id BIGINT, status STRING, email STRING, amount DECIMAL(10,2)")
        amount = F.col("row.amount") if name == "orders" else F.lit(None).cast("decimal(10,2)")
        sinks.append(rows.select(F.lit(name).alias("sink"), "row.id", F.col(f"row.{label}").alias("label"), amount.alias("amount")))
    return sinks[0].unionAll(sinks[1])


@query("declared_upsert_fold", with_inputs("f_ord", select=f"WITH {_CHANGED} SELECT id, status, amount, 'table-api' AS job_variant FROM final_orders"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The declared keyed job of orders as a stream over a log with updates and deletes."""
    root = work_dir(spark, "declared-upsert")
    job = patterns(derived.DATABASE, STREAM_PREFIX, STREAM_PREFIX)["stream-table"]
    path, files = changing_orders(spark, folder)
    spec = with_paths(job, path, f"{root}/out", f"{root}/checkpoints", True)
    spec["source"]["options"] = {"maxFilesPerTrigger": str(files)}
    run_pipeline(spark, spec).awaitTermination()
    found = read_upsert(spark, FileTarget(f"{root}/out"), f"{STREAM_PREFIX}.table-api.orders")
    rows = parse_flat(found, "id BIGINT, status STRING, amount DECIMAL(10,2), job_variant STRING")
    return rows.select("row.*")


# --- live state ---------------------------------------------------------------------------------------------------


def _in_parts(spark: SparkSession, folder: str, parts: int = 4) -> DataFrame:
    """The events as a stream of several batches, each a stretch of the log."""
    path, events = work_dir(spark, "events-in-parts"), derived.events(spark, folder)
    width = (events.agg(F.max("event_id")).first()[0] or 0) // parts + 1
    events.repartitionByRange(parts, "event_id").withColumn("part", F.expr(f"event_id div {width}")).write.partitionBy("part").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


_STATE = with_inputs(
    "f_log", select=FOLD.format(cols="id, after_amount AS amount, after_status AS status", where="", live="AND op <> 'd'")
)


def _state(spark: SparkSession, events: DataFrame, suffix: str) -> DataFrame:
    target, options = _unit(spark, suffix)
    columns = ["id", "amount", "status"]
    changes = derived.account_upserts(events)
    write_state(changes, ["id"], columns, "pos", F.col("op") == "d", "accounts", target, options).awaitTermination()
    return parse_flat(read_state(spark, target, "accounts"), derived.ACCOUNT_ROW).select("row.*")


@query("current_state_live", _STATE)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _state(spark, read_parquet_stream(spark, folder, "events"), "state")


@query("current_state_batches", _STATE)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The same state after many batches, read from its last version."""
    return _state(spark, _in_parts(spark, folder), "state-batches")


def _run(records: DataFrame, spark: SparkSession, suffix: str) -> DataFrame:
    target, options = _unit(spark, suffix)
    write_append(records, suffix, target, options).awaitTermination()
    return read_topic(spark, target, suffix)


_LIFECYCLE = """SELECT id, pos, prev_op, op FROM (
            SELECT user_id AS id, event_id AS pos, op, lag(op) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_op
            FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events) e
        ) x WHERE CASE WHEN prev_op IN ('c', 'u') THEN op = 'c' ELSE op <> 'c' END"""


@query("lifecycle_live", _LIFECYCLE)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = lifecycle_live(derived.claimed_ops(read_parquet_stream(spark, folder, "events", 1)), "id")
    texts = found.select(F.to_json(F.struct("id", "pos", "prev_op", "op")).alias("value"))
    return parse_flat(_run(texts, spark, "lifecycle"), "id BIGINT, pos BIGINT, prev_op STRING, op STRING").select("row.*")


def _late_parts(spark: SparkSession, rows: DataFrame, pos: str, ts: str, parts: int = 4) -> tuple[DataFrame, str]:
    """Rows as a stream of several batches in which every second stretch comes before the one it follows, and the delay that takes.

    The last file holds a heartbeat: a row of nulls but for a time so late that the watermark passes all rows.
    """
    path = work_dir(spark, "late")
    times = rows.agg(F.max(pos).alias("last"), F.min(ts).alias("low"), F.max(ts).alias("high")).first()
    low, high = times["low"] or datetime(2024, 1, 1), times["high"] or datetime(2024, 1, 1)
    width = (times["last"] or 0) // parts + 1
    for part in range(parts):
        at = part + 1 if part % 2 == 0 and part + 1 < parts else part - 1 if part % 2 else part
        append_part(rows.where(F.col(pos).between(at * width, at * width + width - 1)), pos, path)
    files = files_a_batch(spark, path, parts)
    delay = high - low + timedelta(minutes=1)
    beat = spark.range(1).select(*[F.lit(high + 3 * delay if f.name == ts else None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    beat.write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)
    return stream, f"{int(delay.total_seconds())} seconds"


@query("lifecycle_late", _LIFECYCLE)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Changes that arrive out of order by up to a stretch of the log, judged in order, to the last one."""
    events = derived.events(spark, folder)
    late, delay = _late_parts(spark, derived.claimed_ops(events).join(events.select(F.col("event_id").alias("pos"), "ts"), "pos"), "pos", "ts")
    found = lifecycle_ordered(late, "id", "ts", delay)
    texts = found.select(F.to_json(F.struct("id", "pos", "prev_op", "op")).alias("value"))
    return parse_flat(_run(texts, spark, "lifecycle-late"), "id BIGINT, pos BIGINT, prev_op STRING, op STRING").select("row.*")


@query(
    "silence_live",
    """SELECT job_name, minute + INTERVAL 1 MINUTE AS silent_from, following AS silent_until
        FROM (SELECT *, lead(minute) OVER (PARTITION BY job_name ORDER BY minute) AS following
            FROM (SELECT DISTINCT event_type AS job_name, time_bucket(INTERVAL 1 MINUTE, ts) AS minute FROM events) a) b
        WHERE following IS NULL OR following > minute + INTERVAL 1 MINUTE""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Silent spans, those that go on when the stream ends with a null end."""
    events = derived.events(spark, folder).select("event_type", "event_id", "ts")
    late, delay = _late_parts(spark, events, "event_id", "ts")
    found = silence_live(late, "event_type", "ts", delay)
    texts = found.select(F.to_json(F.struct("job_name", "silent_from", "silent_until")).alias("value"))
    rows = parse_flat(_run(texts, spark, "silence"), "job_name STRING, silent_from TIMESTAMP, silent_until TIMESTAMP")
    # A span that was reported while it lasted is reported again with its end; the heartbeat is no job.
    spans = rows.select("row.*").where(F.col("job_name").isNotNull()).groupBy("job_name", "silent_from")
    return spans.agg(F.max("silent_until").alias("silent_until")).select(
        "job_name", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("silent_from", "silent_until")]
    )


_GROWTH = """SELECT job_name, minute, CAST(sum(v - COALESCE(p, v)) AS BIGINT) AS growth FROM (
        SELECT event_type AS job_name, time_bucket(INTERVAL 1 MINUTE, ts) AS minute, 9007199254740993 + event_id AS v,
            lag(9007199254740993 + event_id) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM events) a
    GROUP BY 1, 2"""


@query("counter_growth_live", _GROWTH)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A counter that every job reports, beyond what a float holds, out of order and to the last minute."""
    counter = (F.lit(9007199254740993) + F.col("event_id")).alias("counter")
    samples = derived.events(spark, folder).select(F.col("event_type").alias("job_name"), "event_id", "ts", counter)
    late, delay = _late_parts(spark, samples, "event_id", "ts")
    found = counter_growth_live(late, "counter", delay=delay)
    texts = found.select(F.to_json(F.struct("job_name", "minute", "growth")).alias("value"))
    rows = parse_flat(_run(texts, spark, "growth"), "job_name STRING, minute TIMESTAMP, growth BIGINT")
    return rows.select("row.job_name", F.col("row.minute").cast("timestamp_ntz").alias("minute"), "row.growth")


# --- live alerts --------------------------------------------------------------------------------------------------


def _metric_parts(spark: SparkSession, folder: str, metric: str) -> tuple[DataFrame, str]:
    """Metric samples out of order in several batches, and the delay that takes."""
    path = work_dir(spark, "metrics")
    metrics = derived.job_metrics(derived.events(spark, folder)).select("job_name", "ts", metric)
    # Samples are five seconds apart over all jobs.
    metrics.withColumn("place", F.expr("unix_seconds(CAST(ts AS TIMESTAMP)) div 5")).write.parquet(path)
    written = spark.read.parquet(path)
    first = written.agg(F.min("place")).first()[0] or 0
    return _late_parts(spark, written.withColumn("place", F.col("place") - first), "place", "ts")


def _alert_states(spark: SparkSession, folder: str, rule: AlertRule) -> DataFrame:
    samples, delay = _metric_parts(spark, folder, rule.metric)
    found = alert_live(samples, rule, delay=delay, bin_seconds=60)
    texts = found.select(F.to_json(F.struct("job_name", "minute", "value", "state")).alias("value"))
    rows = parse_flat(_run(texts, spark, "alert"), "job_name STRING, minute TIMESTAMP, value BIGINT, state STRING")
    return rows.select("row.job_name", F.col("row.minute").cast("timestamp_ntz").alias("minute"), "row.value", "row.state")


@query("alert_live", alert_sql(RESTART_LOOP))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The rule on a counter, evaluated as its samples come in."""
    return _alert_states(spark, folder, RESTART_LOOP)


@query("alert_live_gauge", alert_sql(CHECKPOINT_DURATION))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _alert_states(spark, folder, CHECKPOINT_DURATION)


@query("parity_live", OUTBOX_PARITY)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Both outputs of a dual run as streams, out of order and with repeated records, compared to the last key."""
    (single, delay), (fanned, more) = (_late_parts(spark, side, "id", "created_at") for side in dual_outbox(spark, folder))
    found = parity_outbox_live(single, fanned, "created_at", max(delay, more, key=lambda d: int(d.split()[0])))
    texts = found.select(F.to_json(F.struct("id", "verdict", "differing")).alias("value"))
    return parse_flat(_run(texts, spark, "parity"), "id BIGINT, verdict STRING, differing STRING").select("row.*")


@query("delivery_state", _STATE)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The accounts out of records that were delivered out of order and some of them twice, told apart by their headers."""
    changes = derived.account_upserts(derived.events(spark, folder))
    changes = changes.withColumn("gone", F.col("op") == "d")
    records = to_upsert_record(changes, ["id"], ["id", "amount", "status"], F.col("gone")).withColumnRenamed("pos", "offset")
    twice = F.when(F.col("status") == "purchase", F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    sent = with_headers(records).select("key", "value", "headers", "offset", F.explode(twice).alias("copy"))
    path = work_dir(spark, "wire")
    # Dealt to files by hash: the parts of the log come in any order.
    for part in range(3):
        append_part(sent.where(F.pmod(F.xxhash64("offset", "copy"), F.lit(3)) == part), "offset", path, lambda rows: rows.select("key", "value", "headers"))
    schema = f"key STRING, value STRING, headers {HEADERS}"
    wire = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch(spark, path, 3)).parquet(path)
    target, options = _unit(spark, "delivery")
    newer = newer_only(from_headers(wire)).select(F.lit("accounts").alias("topic"), F.col("position").alias("offset"), "key", "value")
    write_keyed(newer, ["accounts"], target, options).awaitTermination()
    return parse_flat(read_upsert(spark, target, "accounts"), derived.ACCOUNT_ROW).select("row.*")
