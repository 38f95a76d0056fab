"""Change envelopes ``{before, after, op, source, ts_ms}`` and flat upsert rows, as text and as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.decimals import decode_decimal

# Timestamps without a zone, to the millisecond; a null field is written as an explicit null.
WIRE = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSS", "ignoreNullFields": "false"}

SOURCE = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("pos", T.LongType()),
    ]
)

ENVELOPE_FIELDS = ("before", "after", "op", "source", "ts_ms")


def row_type(row: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(row) if isinstance(row, str) else row


def envelope_type(row: str | T.StructType) -> T.StructType:
    """The type of an envelope around rows of type ``row``."""
    image = row_type(row)
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
            T.StructField("source", SOURCE),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def source_struct(db: str, table: str, ts_ms: Column, pos: Column) -> Column:
    return F.struct(
        F.lit(db).alias("db"),
        F.lit(table).alias("table"),
        ts_ms.cast("bigint").alias("ts_ms"),
        pos.cast("bigint").alias("pos"),
    )


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp; the session time zone is UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def to_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``value``: the envelope text of the columns ``before, after, op, source, ts_ms``."""
    return df.withColumn(value, F.to_json(F.struct(*ENVELOPE_FIELDS), WIRE))


def parse_envelope(
    df: DataFrame,
    row: str | T.StructType,
    value: str = "value",
    decimals: dict[str, tuple[str, int, int]] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Add ``before, after, op, source, ts_ms`` read from the envelope text.

    ``decimals`` maps a row field to its wire form, ``(mode, precision, scale)``. A text that is no envelope gives null
    columns; ``malformed`` names a column that receives such a text whole. Only fields that are used later are parsed.
    """
    decimals = decimals or {}
    wire_row = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in decimals else f.dataType) for f in row_type(row).fields]
    )
    schema = envelope_type(wire_row)
    options = dict(WIRE)
    if malformed:
        schema = schema.add(malformed, T.StringType())
        options["columnNameOfCorruptRecord"] = malformed
    parsed = df.withColumn("_envelope", F.from_json(value, schema, options))
    images = {image: _decode(F.col("_envelope")[image], decimals) for image in ("before", "after")}
    plain = {name: F.col("_envelope")[name] for name in ("op", "source", "ts_ms")}
    extra = {malformed: F.col("_envelope")[malformed]} if malformed else {}
    return parsed.withColumns({**images, **plain, **extra}).drop("_envelope")


def _decode(image: Column, decimals: dict[str, tuple[str, int, int]]) -> Column:
    for name, (mode, precision, scale) in decimals.items():
        image = F.when(image.isNotNull(), image.withField(name, decode_decimal(image[name], mode, precision, scale)))
    return image


def op_image(df: DataFrame, key: str) -> DataFrame:
    """Add the key, the image an op leaves or removes, and whether the images fit the op.

    Creates and snapshot reads carry ``after`` only, updates both images, deletes ``before`` only.
    """
    has_before, has_after = F.col("before").isNotNull(), F.col("after").isNotNull()
    fits = (
        F.when(F.col("op").isin("c", "r"), ~has_before & has_after)
        .when(F.col("op") == "u", has_before & has_after)
        .when(F.col("op") == "d", has_before & ~has_after)
        .otherwise(F.lit(False))
    )
    return df.withColumns(
        {
            "key": F.coalesce(F.col("after")[key], F.col("before")[key]),
            "image": F.coalesce("after", "before"),
            "images_fit_op": fits,
        }
    )


def to_upsert_record(df: DataFrame, key_cols: list[str], value_cols: list[str], deleted: Column | None = None) -> DataFrame:
    """Add ``key`` and ``value`` texts of an upsert topic; a deleted row has a null value."""
    value = F.to_json(F.struct(*value_cols), WIRE)
    if deleted is not None:
        value = F.when(~deleted, value)
    return df.withColumns({"key": F.to_json(F.struct(*key_cols), WIRE), "value": value})


def parse_flat(df: DataFrame, row: str | T.StructType, value: str = "value", into: str = "row") -> DataFrame:
    """Add ``row``: the flat row text as a struct."""
    return df.withColumn(into, F.from_json(value, row_type(row), WIRE))


def extract_row(df: DataFrame, shape: Column | str, row: str | T.StructType, key: str = "id", value: str = "value") -> DataFrame:
    """Add ``row``: the row inside a text of either shape, or null; no text makes it fail.

    ``shape`` is ``envelope`` (the row is ``after``) or ``flat`` (the row is the text itself). A row without its key
    counts as no row.
    """
    shape = F.lit(shape) if shape in ("envelope", "flat") else F.col(shape) if isinstance(shape, str) else shape
    image = row_type(row)
    after = F.from_json(value, T.StructType([T.StructField("after", image)]), WIRE)["after"]
    flat = F.from_json(value, image, WIRE)
    found = F.when(shape == "envelope", after).when(shape == "flat", flat)
    return df.withColumn("row", found).withColumn("row", F.when(F.col("row")[key].isNotNull(), F.col("row")))
