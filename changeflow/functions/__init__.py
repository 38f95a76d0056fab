"""Column expressions: JSON values, decimals on the wire, topic names."""

from changeflow.functions.decimals import decode_decimal, encode_decimal
from changeflow.functions.jsonvalue import (
    JsonObject,
    canonical_json,
    extract_text_field,
    json_map,
    json_object,
    put_fields,
    put_text,
    row_object,
    with_object,
)
from changeflow.functions.topics import split_topic, topic_for_table, topic_name

__all__ = [
    "JsonObject",
    "canonical_json",
    "decode_decimal",
    "encode_decimal",
    "extract_text_field",
    "json_map",
    "json_object",
    "put_fields",
    "put_text",
    "row_object",
    "split_topic",
    "topic_for_table",
    "topic_name",
    "with_object",
]
