"""JSON objects held as text, as a variant or as ``map<string,variant>``.

Every function is a built-in expression. A text is parsed once; the fields it is asked for come out of the variant by
path, and new fields are joined to the text, so that nothing in it is written again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_MAP = T.MapType(T.StringType(), T.VariantType())

UNKNOWN = "unknown"

# --- objects in texts ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class JsonObject:
    """A JSON object inside a variant column, null where a text held none; ``root`` is the path to it."""

    column: Column
    root: str = "$"

    def _get(self, names: tuple[str, ...], kind: str) -> Column:
        return F.try_variant_get(self.column, self.root + _steps(names), kind)

    def exists(self) -> Column:
        return self.column.isNotNull()

    def has(self, *names: str) -> Column:
        """Whether the object has the field, a JSON null included; false where there is no object."""
        return self._get(names, "variant").isNotNull()

    def has_null(self, *names: str) -> Column:
        """Whether the object has the field with a JSON null."""
        return F.is_variant_null(self._get(names, "variant"))

    def has_object(self, *names: str) -> Column:
        """Whether the field is itself an object."""
        return nested_map(self._get(names, "variant")).isNotNull()

    def text(self, *names: str, default: str | None = UNKNOWN) -> Column:
        """A field as text; ``default`` where it is missing or JSON null."""
        text = self._get(names, "string")
        return text if default is None else F.coalesce(text, F.lit(default))

    def fields(self) -> Column:
        """The fields as ``map<string,variant>``."""
        return F.try_variant_get(self.column, self.root, JSON_MAP.simpleString())


def _steps(names: tuple[str, ...]) -> str:
    for name in names:
        if not name or set(name) & set("'\"?"):
            raise ValueError(f"field name {name!r} cannot be used in a path")
    return "".join(f"['{name}']" for name in names)


def _parsed(text: Column) -> Column:
    # The regular expression is there for speed only: plain text is turned away without a parser exception per row.
    return F.try_parse_json(F.when(text.rlike(r"^\s*\{"), text))


def json_object(text: Column) -> JsonObject:
    """The object a text holds.

    Malformed text, arrays, scalars and objects with a repeated key hold none.
    """
    return JsonObject(_parsed(text))


def with_object(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``_object``, read with ``row_object``, and ``_whole``: whether the text is that object and no more.

    The parser overlooks what follows a complete value. The text is therefore parsed as the first element of an array
    whose second is the hash of the text: only where that hash comes back did the object end where the text ends. The
    object stays inside the array, since taking a variant out of another one builds it anew.
    """
    text, mark = F.col(value), F.xxhash64(value)
    framed = F.try_parse_json(F.when(text.rlike(r"^\s*\{"), _frame(text, mark.cast("string"))))
    whole = F.coalesce(F.try_variant_get("_framed", "$[1]", "bigint") == mark, F.lit(False))
    # Rare: an object with other text after it.
    cut = F.try_parse_json(_frame(_parsed(text).cast("string"), F.lit("null")))
    marked = df.withColumn("_framed", framed).withColumn("_whole", whole)
    return marked.withColumn("_object", F.when(F.col("_whole"), F.col("_framed")).otherwise(cut)).drop("_framed")


def _frame(text: Column, second: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit(","), second, F.lit("]"))


def row_object() -> JsonObject:
    """The object that ``with_object`` added to a row."""
    return JsonObject(F.col("_object"), "$[0]")


def put_text(text: Column, new: dict[str, Column]) -> Column:
    """``text`` of a row from ``with_object`` with fields set; a text without an object stays byte for byte.

    Where none of the fields is there yet they are joined to the start of the text, which is not read or written again.
    Only an object that has one of them, or is followed by other text, is written anew.
    """
    found = row_object()
    # In a complete object nothing but spaces and one brace stands before the first name or the closing brace.
    rest = F.ltrim(text, F.lit(" \n\r\t{"))
    fields = F.to_json(F.struct(*[column.alias(name) for name, column in new.items()]), {"ignoreNullFields": "false"})
    opened = F.regexp_replace(fields, r"\}\z", "")
    joined = F.concat(opened, F.when(rest.startswith("}"), F.lit("")).otherwise(F.lit(",")), rest)
    clashes = reduce(Column.__or__, [_may_have(text, name) & found.has(name) for name in new])
    rewritten = F.to_json(put_fields(found.fields(), new))
    return F.when(F.col("_object").isNull(), text).when(F.col("_whole") & ~clashes, joined).otherwise(rewritten)


def _may_have(text: Column, name: str) -> Column:
    """False only where no field of the object in a text can have the name, told without the object.

    A name of letters, digits and underscores stands in the text as it is, unless a ``\\u`` escape hides it.
    """
    if not re.fullmatch(r"\w+", name, re.ASCII):
        return F.lit(True)
    return text.contains(name) | text.contains("\\u")


# --- objects as maps ----------------------------------------------------------------------------------------------


def json_map(text: Column) -> Column:
    """The fields of a JSON object as a map, or null for every other text."""
    return json_object(text).fields()


def nested_map(value: Column) -> Column:
    """The fields of a variant that is an object, or null."""
    return F.try_variant_get(value, "$", JSON_MAP.simpleString())


def map_text(fields: Column, name: str, default: str | None = UNKNOWN) -> Column:
    """Field ``name`` of a map as text; ``default`` where it is missing or JSON null."""
    text = F.try_variant_get(F.try_element_at(fields, F.lit(name)), "$", "string")
    return text if default is None else F.coalesce(text, F.lit(default))


def put_fields(fields: Column, new: dict[str, Column]) -> Column:
    """A map with fields set; a field that is already there is replaced."""
    kept = F.map_filter(fields, lambda name, _: ~name.isin(*new))
    added = F.create_map(*[part for name, value in new.items() for part in (F.lit(name), value.cast("variant"))])
    return F.map_concat(kept, added)


# --- texts --------------------------------------------------------------------------------------------------------


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys, normal numbers and no spaces; null where the text is not JSON."""
    return F.try_parse_json(text).cast("string")


def extract_text_field(text: Column, field: str) -> Column:
    """The raw value after the first ``"field":"`` in the text, read as text and not as JSON.

    The value ends at the first quote without a backslash before it; escapes stay as they are. A missing field, a
    missing end and a value that is not a string directly after the colon give ``unknown``. The possessive repeats make
    the match a loop, so that long texts cannot exhaust the stack.
    """
    pattern = rf'(?s)"\Q{field}\E":"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(F.lit(UNKNOWN))
