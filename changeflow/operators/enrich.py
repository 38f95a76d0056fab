"""Tags and metadata on events: text, struct and map records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.jsonvalue import put_fields, put_text, row_object, with_object
from changeflow.functions.topics import topic_for_table
from changeflow.operators.route import json_table, map_table, now_millis, struct_table, with_fields

# The tag of the multi-table change stream and the tail of its only topic.
STREAM_TAG = "datastream-cdc"
STREAM_TOPIC_TAIL = "datastream.orders"


def project_tagged(df: DataFrame, cols: list[str], tag: str) -> DataFrame:
    """The given columns and the literal ``job_variant``."""
    return df.select(*cols, F.lit(tag).alias("job_variant"))


def tag_event(df: DataFrame, prefix: str, value: str = "value") -> DataFrame:
    """Set ``variant`` and ``topic`` in each JSON object; every other text stays byte for byte.

    Events of every table get the same topic.
    """
    tags = {"variant": F.lit(STREAM_TAG), "topic": F.lit(f"{prefix}.{STREAM_TOPIC_TAIL}")}
    tagged = put_text(F.col(value), tags)
    return with_object(df, value).withColumn(value, tagged).drop("_object", "_whole")


def _required(**settings: str) -> None:
    for name, setting in settings.items():
        if not setting or not setting.strip():
            raise ValueError(f"{name} must be set to a non-blank value")


def _metadata(variant: str, now: Column | int | None) -> dict[str, Column]:
    return {"variant": F.lit(variant), "topic": F.col("topic"), "transformed_at": now_millis(now)}


def _routed(df: DataFrame, prefix: str, table: Column) -> DataFrame:
    topic = F.when(F.col("value").isNull(), F.col("topic")).otherwise(topic_for_table(prefix, table))
    return df.withColumn("topic", topic)


def enrich_json(df: DataFrame, variant: str, prefix: str, now: Column | int | None = None) -> DataFrame:
    """Route text records to ``<prefix>.<table>`` and set ``variant``, ``topic``, ``transformed_at`` in them.

    A text that is no JSON object keeps its value and goes to ``<prefix>.unknown``; a null value keeps its topic too.
    """
    _required(variant=variant, prefix=prefix)
    routed = _routed(with_object(df), prefix, json_table(row_object()))
    enriched = put_text(F.col("value"), _metadata(variant, now))
    return routed.withColumn("value", enriched).drop("_object", "_whole")


def enrich_struct(df: DataFrame, variant: str, prefix: str, now: Column | int | None = None) -> DataFrame:
    """The same for struct records: three nullable fields join the value."""
    _required(variant=variant, prefix=prefix)
    routed = _routed(df, prefix, struct_table(F.col("value"), df.schema["value"].dataType))
    return routed.withColumn("value", with_fields(F.col("value"), _metadata(variant, now)))


def enrich_map(df: DataFrame, variant: str, prefix: str, now: Column | int | None = None) -> DataFrame:
    """The same for ``map<string,variant>`` records."""
    _required(variant=variant, prefix=prefix)
    routed = _routed(df, prefix, map_table(F.col("value")))
    return routed.withColumn("value", put_fields(F.col("value"), _metadata(variant, now)))
