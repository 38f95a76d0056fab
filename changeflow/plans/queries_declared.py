"""Queries that run each declared job on the change log of the database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.envelope import source_struct, to_envelope
from changeflow.plans.declared import patterns, plan_pipeline, run_pipeline, with_paths
from changeflow.plans.expected import with_inputs
from changeflow.plans.queries_changelog import written_log
from changeflow.plans.queries_format import DATABASE_ROWS
from changeflow.plans.registry import query
from changeflow.session import work_dir
from changeflow.sources import derived
from changeflow.sources.changelog import write_changelog
from changeflow.streaming.sinks import FileTarget, read_topic, read_upsert

JOBS = patterns(derived.DATABASE, "shop.stream", "shop.link")

_FIELDS = """id BIGINT, after STRUCT<id: BIGINT>, op STRING, variant STRING, job_variant STRING,
    _route_destination STRING"""


def _read(records: DataFrame) -> DataFrame:
    """Topic, row id, op and tag of the records of any job."""
    read = records.withColumn("e", F.from_json("value", _FIELDS))
    tag = F.coalesce("e.variant", "e.job_variant", "e._route_destination")
    return read.select("topic", F.coalesce("e.after.id", "e.id").alias("id"), "e.op", tag.alias("tag"))


_INPUTS = ("f_ord", "f_cust", "f_out")
_LOG = f"(SELECT * FROM ({DATABASE_ROWS}) r) a"


def _enriched(tail: str, tag: str, where: str = "TRUE") -> str:
    return f"SELECT 'shop.link.{tail}.' || table_name AS topic, id, op, '{tag}' AS tag FROM {_LOG} WHERE {where}"


def _upserted(tail: str, where: str) -> str:
    return f"""SELECT 'shop.stream.{tail}.' || table_name AS topic, id, CAST(NULL AS VARCHAR) AS op, '{tail}' AS tag
        FROM {_LOG} WHERE {where}"""


_SQL = {
    "stream-multi": f"SELECT 'shop.stream.datastream.orders' AS topic, id, op, 'datastream-cdc' AS tag FROM {_LOG}",
    "stream-table": _upserted("table-api", "table_name = 'orders'"),
    "stream-sql": _upserted("sql-api", "table_name <> 'outbox_events'"),
    "stream-outbox": f"""SELECT 'shop.stream.outbox.outbox-events' AS topic, id, op, CAST(NULL AS VARCHAR) AS tag
        FROM {_LOG} WHERE table_name = 'outbox_events'""",
    "stream-envelope": f"""SELECT 'shop.stream.yaml-pipeline.orders' AS topic, id, op, CAST(NULL AS VARCHAR) AS tag
        FROM {_LOG} WHERE table_name = 'orders'""",
    "link-multi": _enriched("datastream", "datastream-cdc"),
    "link-table": _enriched("table-api", "table-api-cdc"),
    "link-sql": _enriched("sql-api", "sql-api-cdc"),
    "link-outbox": "SELECT 'shop.link.outbox.' || destination AS topic, id, 'c' AS op, destination AS tag FROM f_out",
    "link-envelope": _enriched("yaml-pipeline", "yaml-pipeline-cdc", "table_name = 'orders'"),
}


def _register(job: str) -> None:
    @query(f"declared_{job.replace('-', '_')}", with_inputs(*_INPUTS, select=_SQL[job]))
    def _(spark: SparkSession, folder: str) -> DataFrame:
        spec = with_paths(JOBS[job], written_log(spark, folder), work_dir(spark, job), by_table=True)
        return _read(plan_pipeline(spark, spec))


for _job in JOBS:
    _register(_job)


@query("declared_envelope", with_inputs(*_INPUTS, select=_SQL["stream-envelope"]))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The declared envelope job as a stream, from its source files to its sink files."""
    root = work_dir(spark, "declared")
    spec = with_paths(JOBS["stream-envelope"], written_log(spark, folder), f"{root}/out", f"{root}/checkpoints", True, True)
    run_pipeline(spark, spec).awaitTermination()
    return _read(read_topic(spark, FileTarget(f"{root}/out")))


@query(
    "declared_evolving",
    """SELECT event_id AS id, event_type AS destination, ts >= TIMESTAMP '2024-01-16 00:00:00' AS has_new_field,
        CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN 'v2-' || event_type END AS new_field, 'table-api' AS job_variant
        FROM events WHERE event_type <> 'error'""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A declared keyed job over a table that gets a column: values have it from the position of the change on.

    Errors delete their event again, at a position of their own after all others.
    """
    events = derived.events(spark, folder)
    middle = F.lit(derived.SCHEMA_CHANGE).cast("timestamp_ntz")
    start = events.where(F.col("ts") >= middle).agg(F.min("event_id")).first()[0]
    last = events.agg(F.max("event_id")).first()[0] or 0
    new = F.when(F.col("ts") >= middle, F.concat(F.lit("v2-"), "event_type"))
    row = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("destination"), new.alias("new_field"))
    gone = F.col("event_type") == "error"

    def changes(rows: DataFrame, op: str, pos: Column) -> DataFrame:
        image = {"before": row if op == "d" else F.when(F.lit(False), row), "after": F.when(F.lit(False), row) if op == "d" else row}
        source = source_struct(derived.DATABASE, "outbox_events", F.lit(0).cast("bigint"), pos)
        columns = {**image, "op": F.lit(op), "source": source, "ts_ms": F.lit(0).cast("bigint")}
        return to_envelope(rows.select(*[c.alias(n) for n, c in columns.items()])).select("value")

    log = changes(events, "c", F.col("event_id")).unionAll(changes(events.where(gone), "d", F.col("event_id") + last + 1))
    root = work_dir(spark, "evolving")
    write_changelog(log, f"{root}/log")
    columns = "id BIGINT, destination STRING"
    schemas = [{"from": 0, "columns": columns}]
    if start is not None:
        schemas.append({"from": start, "columns": f"{columns}, new_field STRING"})
    spec = with_paths(JOBS["stream-table"], f"{root}/log", f"{root}/out", f"{root}/checkpoints", True, True)
    spec["source"] |= {"tables": [f"{derived.DATABASE}.outbox_events"], "schemas": {"outbox_events": schemas}}
    run_pipeline(spark, spec).awaitTermination()
    found = read_upsert(spark, FileTarget(f"{root}/out"), "shop.stream.table-api.outbox_events")
    kinds = "id BIGINT, destination STRING, new_field STRING, job_variant STRING"
    rows = found.withColumn("row", F.from_json("value", kinds))
    has = F.array_contains(F.json_object_keys("value"), "new_field").alias("has_new_field")
    return rows.select("row.id", "row.destination", has, "row.new_field", "row.job_variant")


__all__ = ["JOBS"]
