"""Jobs declared as data: source, transform, sink and settings, without code.

A spec is a dict. ``plan_pipeline`` gives the topic records of a job, from a batch or from a stream; ``run_pipeline``
writes them. Unknown keys are errors, so a misspelt setting cannot be ignored.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.enrich import enrich_json, tag_event
from changeflow.operators.envelope import WIRE, envelope_type
from changeflow.operators.history import SchemaHistory
from changeflow.operators.route import route_outbox, route_outbox_single
from changeflow.sources.changelog import OUTBOX_TABLE, read_changelog
from changeflow.sources.tables import CUSTOMERS, ORDERS, OUTBOX_EVENTS, TableSpec
from changeflow.streaming.sinks import FileTarget, KafkaTarget, StreamOptions, Target, write_keyed, write_routed

Spec = dict[str, Any]

TABLES = {spec.name: spec for spec in (ORDERS, CUSTOMERS, OUTBOX_EVENTS)}

_KEYS = {
    "source": {"type", "name", "path", "format", "layout", "tables", "streaming", "options", "schemas"},
    "transform": {"type", "prefix", "variant", "field", "tag"},
    "sink": {"type", "name", "path", "servers", "topic", "files-per-topic"},
    "pipeline": {"name", "parallelism", "schema.change.behavior", "checkpoint", "prefix", "interval"},
}
_REQUIRED = {"source": {"type", "path", "tables"}, "sink": {"type"}, "pipeline": {"name"}}
_TRANSFORMS = ("none", "tag", "enrich", "route", "route-text", "upsert")


def check_spec(spec: Spec) -> None:
    """Raise where a spec has an unknown part, an unknown key or lacks a required one."""
    _names("spec", spec, set(_KEYS), set(_REQUIRED))
    for part, keys in _KEYS.items():
        if part in spec:
            _names(part, spec[part], keys, _REQUIRED.get(part, set()))
    kind = spec.get("transform", {}).get("type", "none")
    if kind not in _TRANSFORMS:
        raise ValueError(f"transform type must be one of {_TRANSFORMS}, not {kind!r}")
    if spec["source"]["type"] != "changelog":
        raise ValueError("source type must be 'changelog'")
    if spec["source"].get("layout", "by-table") != "by-table":
        raise ValueError("source layout must be 'by-table' where it is given")
    if spec["sink"]["type"] not in ("files", "kafka"):
        raise ValueError("sink type must be 'files' or 'kafka'")
    if spec["pipeline"].get("schema.change.behavior", "evolve") != "evolve":
        raise ValueError("schema.change.behavior must be 'evolve'")


def _names(where: str, given: dict, known: set[str], required: set[str]) -> None:
    unknown, missing = set(given) - known, required - set(given)
    if unknown or missing:
        raise ValueError(f"{where}: unknown keys {sorted(unknown)}, missing keys {sorted(missing)}")


def plan_pipeline(spark: SparkSession, spec: Spec) -> DataFrame:
    """The topic records ``topic, key, value`` of a declared job, of upsert jobs with their ``offset``."""
    check_spec(spec)
    source = spec["source"]
    changes = read_changelog(
        spark,
        source["path"],
        source["tables"],
        source.get("streaming", False),
        source.get("format", "parquet"),
        options=source.get("options"),
        by_table=source.get("layout") == "by-table",
    )
    records = _transform(changes, spec)
    parallelism = spec["pipeline"].get("parallelism")
    # A limit on writers alone: reading and parsing keep the tasks of the source.
    return records.repartition(parallelism) if parallelism else records


def _transform(changes: DataFrame, spec: Spec) -> DataFrame:
    transform = spec.get("transform", {"type": "none"})
    kind, prefix, topic = transform["type"], transform.get("prefix"), spec["sink"].get("topic")
    for column in ("key", "topic"):
        if column not in changes.columns:
            changes = changes.withColumn(column, F.lit(None).cast("string"))
    if kind == "upsert":
        names = [name.rpartition(".")[2] for name in spec["source"]["tables"]]
        # Of a table whose schema has changed, what its columns were from which position on.
        histories = {
            name: SchemaHistory.of(*[(version["from"], version["columns"]) for version in versions])
            for name, versions in spec["source"].get("schemas", {}).items()
        }
        return upsert_records(changes, [TABLES[name] for name in names], transform["tag"], prefix, histories)
    if kind == "tag":
        records = tag_event(changes, prefix).withColumn("topic", F.lit(topic))
    elif kind == "enrich":
        records = enrich_json(changes, transform["variant"], prefix)
    elif kind == "route":
        options = {k: v for k, v in (("prefix", prefix), ("field", transform.get("field"))) if v is not None}
        records = route_outbox(changes, **options)
    elif kind == "route-text":
        records = route_outbox_single(changes, prefix)
    else:
        # The text goes on as it came, so a column added at the source is in it from then on.
        records = changes.withColumn("topic", F.lit(topic))
    return records.select("topic", "key", "value")


def upsert_records(
    changes: DataFrame, tables: list[TableSpec], tag: str, prefix: str, histories: dict[str, SchemaHistory] | None = None
) -> DataFrame:
    """Keyed records of several tables in one pass over the changes, a topic per table.

    A delete has a null value. ``offset`` is the position of the change, by which ``read_upsert`` folds a topic. A table with
    a history has the columns that held at the position of a change, so that an added column reaches its values.
    """
    table = F.col("table") if "table" in changes.columns else F.get_json_object("value", "$.source.table")
    named = changes.withColumn("_table", table)
    keys, values, topics, offsets = [], [], [], []
    for spec in tables:
        mine, history = F.col("_table") == spec.name, (histories or {}).get(spec.name)
        schema = history.widest if history else spec.schema
        envelope = F.from_json(F.when(mine, F.col("value")), envelope_type(schema), WIRE)
        named = named.withColumn(f"_{spec.name}", envelope)
        after, before = F.col(f"_{spec.name}")["after"], F.col(f"_{spec.name}")["before"]
        pos, job = F.col(f"_{spec.name}")["source"]["pos"], F.lit(tag)
        row = F.struct(*[after[c].alias(c) for c in schema.names], job.alias("job_variant"))
        value = history.text(after, pos, job_variant=job) if history else F.to_json(row, WIRE)
        key = F.struct(*[F.coalesce(after[c], before[c]).alias(c) for c in spec.key])
        keys.append(F.when(mine, F.to_json(key, WIRE)))
        offsets.append(F.when(mine, pos))
        values.append(F.when(mine & after.isNotNull(), value))
        topics.append(F.when(mine, F.lit(f"{prefix}.{spec.name}")))
    wanted = F.col("_table").isin(*[spec.name for spec in tables])
    return named.where(wanted).select(
        _first(topics).alias("topic"),
        _first(offsets).alias("offset"),
        _first(keys).alias("key"),
        _first(values).alias("value"),
    )


def _first(columns: list[Column]) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), columns)


def run_pipeline(spark: SparkSession, spec: Spec) -> StreamingQuery | None:
    """Run a declared job: a stream is started and returned, a batch is written and done."""
    records = plan_pipeline(spark, spec)
    sink, settings = spec["sink"], spec["pipeline"]
    target: Target = FileTarget(sink["path"]) if sink["type"] == "files" else KafkaTarget(sink["servers"])
    if records.isStreaming:
        options = StreamOptions(
            settings.get("prefix", "changeflow"), settings["name"], settings["checkpoint"], settings.get("interval")
        )
        if spec.get("transform", {}).get("type") == "upsert":
            prefix = spec["transform"]["prefix"]
            topics = [f"{prefix}.{name.rpartition('.')[2]}" for name in spec["source"]["tables"]]
            return write_keyed(records, topics, target, options)
        return write_routed(records, target, options, sink.get("files-per-topic"))
    if isinstance(target, KafkaTarget):
        records.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", target.servers).save()
    else:
        # A run replaces what the same job wrote before, and nothing of other jobs.
        options = StreamOptions(settings.get("prefix", "changeflow"), settings["name"], "unused")
        records.write.mode("overwrite").partitionBy("topic").parquet(target.enter(spark, options.query_name))
    return None


def patterns(database: str, stream: str, link: str) -> dict[str, Spec]:
    """The ten patterns as source tables, transform and topic; paths and settings are added by ``with_paths``.

    ``stream`` and ``link`` are the topic prefixes of the two families of jobs.
    """
    orders = [f"{database}.{ORDERS.name}"]
    two = [*orders, f"{database}.{CUSTOMERS.name}"]
    three = [*two, f"{database}.{OUTBOX_TABLE}"]
    outbox = [f"{database}.{OUTBOX_TABLE}"]

    def job(name: str, tables: list[str], transform: Spec, topic: str | None = None) -> Spec:
        sink = {"type": "files", **({"topic": topic} if topic else {})}
        return {
            "source": {"type": "changelog", "tables": tables},
            "transform": transform,
            "sink": sink,
            "pipeline": {"name": name, "schema.change.behavior": "evolve"},
        }

    def enriched(name: str, tables: list[str], variant: str, tail: str) -> Spec:
        return job(name, tables, {"type": "enrich", "variant": variant, "prefix": f"{link}.{tail}"})

    # Tags and topic tails of the jobs.
    jobs = [
        job("stream-multi", three, {"type": "tag", "prefix": stream}, f"{stream}.datastream.orders"),
        job("stream-table", orders, {"type": "upsert", "tag": "table-api", "prefix": f"{stream}.table-api"}),
        job("stream-sql", two, {"type": "upsert", "tag": "sql-api", "prefix": f"{stream}.sql-api"}),
        job("stream-outbox", outbox, {"type": "route-text", "prefix": stream}),
        job("stream-envelope", orders, {"type": "none"}, f"{stream}.yaml-pipeline.orders"),
        enriched("link-multi", three, "datastream-cdc", "datastream"),
        enriched("link-table", three, "table-api-cdc", "table-api"),
        enriched("link-sql", three, "sql-api-cdc", "sql-api"),
        job("link-outbox", outbox, {"type": "route", "prefix": f"{link}.outbox", "field": "destination"}),
        enriched("link-envelope", orders, "yaml-pipeline-cdc", "yaml-pipeline"),
    ]
    return {spec["pipeline"]["name"]: spec for spec in jobs}


def with_paths(
    spec: Spec, source: str, sink: str, checkpoint: str | None = None, streaming: bool = False, by_table: bool = False
) -> Spec:
    """A pattern with its places filled in; ``by_table`` where the source log is written by table."""
    settings = {**spec["pipeline"], **({"checkpoint": checkpoint} if checkpoint else {})}
    return {
        **spec,
        "source": {**spec["source"], "path": source, "streaming": streaming, **({"layout": "by-table"} if by_table else {})},
        "sink": {**spec["sink"], "path": sink},
        "pipeline": settings,
    }
