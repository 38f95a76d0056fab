"""Routing: the table or destination of a record, and the topic that follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.jsonvalue import (
    UNKNOWN,
    JsonObject,
    extract_text_field,
    json_object,
    map_text,
    nested_map,
    put_fields,
    put_text,
    row_object,
    with_object,
)
from changeflow.functions.topics import topic_for_table, topic_name

KINDS = ("json", "struct", "map")

# Defaults of the outbox router and the only topic of the single-topic outbox.
OUTBOX_PREFIX = "poc.kc.outbox"
OUTBOX_FIELD = "destination"
OUTBOX_TOPIC_TAIL = "outbox.outbox-events"


def now_millis(now: Column | int | None) -> Column:
    """``now`` as epoch milliseconds; without one, the time of the query or of the micro-batch."""
    if now is None:
        return F.unix_millis(F.current_timestamp())
    return (F.lit(now) if isinstance(now, int) else now).cast("bigint")


def with_fields(value: Column, new: dict[str, Column]) -> Column:
    """A struct with nullable fields added; a null struct stays null."""
    wider = value
    for name, column in new.items():
        wider = wider.withField(name, F.when(value.isNotNull(), column))
    return F.when(value.isNotNull(), wider)


def _map_inside(fields: Column, name: str) -> Column:
    return nested_map(F.try_element_at(fields, F.lit(name)))


def _struct_inside(struct: T.DataType | None, name: str) -> T.StructType | None:
    inside = struct[name].dataType if isinstance(struct, T.StructType) and name in struct.names else None
    return inside if isinstance(inside, T.StructType) else None


def json_table(record: JsonObject) -> Column:
    """The table a JSON object comes from: inside ``source`` if that is an object, else the top level."""
    # The second part is reached only by objects whose source names no table.
    return F.coalesce(
        record.text("source", "table", default=None),
        F.when(record.has_object("source"), F.lit(UNKNOWN)),
        record.text("table"),
    )


def map_table(fields: Column) -> Column:
    """The table a map comes from: inside ``source``, then the top level."""
    return F.coalesce(map_text(_map_inside(fields, "source"), "table", None), map_text(fields, "table"))


def struct_table(value: Column, struct: T.DataType) -> Column:
    """The table a struct comes from: inside ``source`` only."""
    source = _struct_inside(struct, "source")
    if source is None or "table" not in source.names:
        return F.lit(UNKNOWN)
    return F.coalesce(value["source"]["table"].cast("string"), F.lit(UNKNOWN))


def json_destination(record: JsonObject, field: str) -> Column:
    """The destination in a JSON object: inside ``after`` as soon as that field is there, whatever it holds, else at
    the top level."""
    return F.when(record.has("after"), record.text("after", field)).otherwise(record.text(field))


def map_destination(fields: Column, field: str) -> Column:
    """The destination in a map: inside ``after`` if that is a map, else at the top level."""
    after = _map_inside(fields, "after")
    return F.when(after.isNotNull(), map_text(after, field)).otherwise(map_text(fields, field))


def struct_destination(value: Column, struct: T.DataType, field: str) -> Column:
    """The destination in a struct: inside ``after``, and at the top level only where ``after`` is null."""
    after = _struct_inside(struct, "after")
    if after is None:
        return F.lit(UNKNOWN)
    nothing = F.lit(None).cast("string")
    inner = value["after"][field].cast("string") if field in after.names else nothing
    outer = value[field].cast("string") if field in struct.names else nothing
    return F.coalesce(F.when(value["after"].isNotNull(), inner).otherwise(outer), F.lit(UNKNOWN))


def _check_kind(kind: str) -> None:
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")


def table_of(df: DataFrame, kind: str = "json", into: str = "table") -> DataFrame:
    """Add the table name of each record, ``unknown`` where it does not say."""
    _check_kind(kind)
    value = F.col("value")
    if kind == "json":
        parsed = df.withColumn("_object", json_object(value).column)
        return parsed.withColumn(into, json_table(JsonObject(F.col("_object")))).drop("_object")
    return df.withColumn(into, map_table(value) if kind == "map" else struct_table(value, df.schema["value"].dataType))


def destination_of(df: DataFrame, field: str = OUTBOX_FIELD, kind: str = "json", into: str = "destination") -> DataFrame:
    """Add the outbox destination of each record, ``unknown`` where it does not say."""
    _check_kind(kind)
    value = F.col("value")
    if kind == "json":
        parsed = df.withColumn("_object", json_object(value).column)
        return parsed.withColumn(into, json_destination(JsonObject(F.col("_object")), field)).drop("_object")
    if kind == "map":
        return df.withColumn(into, map_destination(value, field))
    return df.withColumn(into, struct_destination(value, df.schema["value"].dataType, field))


def add_routing(
    df: DataFrame,
    prefix: str = OUTBOX_PREFIX,
    field: str = OUTBOX_FIELD,
    now: Column | int | None = None,
    kind: str = "json",
) -> DataFrame:
    """Set ``_route_destination``, ``_route_topic``, ``_routed_at`` in each record and add its ``topic``.

    A text that is no JSON object and a null value stay as they are and go to ``<prefix>.unknown``.
    """
    _check_kind(kind)
    value = F.col("value")
    if kind == "json":
        named = with_object(df).withColumn("_destination", json_destination(row_object(), field))
    else:
        named = destination_of(df, field, kind, "_destination")
    named = named.withColumn("topic", topic_name(prefix, F.col("_destination")))
    new = {"_route_destination": F.col("_destination"), "_route_topic": F.col("topic"), "_routed_at": now_millis(now)}
    put = {"json": put_text, "map": put_fields, "struct": with_fields}[kind]
    return named.withColumn("value", put(value, new)).drop("_object", "_whole", "_destination")


def route_outbox(
    df: DataFrame,
    prefix: str = OUTBOX_PREFIX,
    field: str = OUTBOX_FIELD,
    now: Column | int | None = None,
    kind: str = "json",
) -> DataFrame:
    """Give each outbox record the topic ``<prefix>.<destination>``; a partition it came with is dropped."""
    return add_routing(df, prefix, field, now, kind).drop("partition")


def route_outbox_single(df: DataFrame, prefix: str, value: str = "value") -> DataFrame:
    """Keep outbox events unchanged in one topic and add the topic each would go to.

    The destination is read as text: in an update it is the first one in the text, which may be that of ``before``.
    """
    return df.withColumns(
        {
            "topic": F.lit(f"{prefix}.{OUTBOX_TOPIC_TAIL}"),
            "intended_topic": topic_name(f"{prefix}.outbox", extract_text_field(F.col(value), OUTBOX_FIELD)),
        }
    )


def fan_out(
    df: DataFrame,
    event_id: Column,
    prefix: str = OUTBOX_PREFIX,
    field: str = OUTBOX_FIELD,
    now: Column | int | None = None,
) -> DataFrame:
    """Route outbox records and name each delivery, so that a topic can drop a repeated one on its own."""
    routed = route_outbox(df.withColumn("_event_id", event_id.cast("string")), prefix, field, now)
    return routed.withColumn("delivery_id", F.concat_ws("#", "topic", "_event_id")).drop("_event_id")


def route_by_table(df: DataFrame, prefix: str, kind: str = "json") -> DataFrame:
    """Give each record the topic of its table."""
    return table_of(df, kind, "_table").withColumn("topic", topic_for_table(prefix, F.col("_table"))).drop("_table")


def topic_catalog(df: DataFrame) -> DataFrame:
    """Messages and partitions per topic, counted per (topic, partition) first."""
    per_partition = df.groupBy("topic", "partition").agg(F.count("*").alias("n"))
    return per_partition.groupBy("topic").agg(
        F.sum("n").cast("bigint").alias("messages"), F.count("*").cast("bigint").alias("partitions")
    )
