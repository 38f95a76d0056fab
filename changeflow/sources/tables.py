"""Typed tables: parquet snapshots, and row images out of a change log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.envelope import parse_envelope, row_type


@dataclass(frozen=True)
class TableSpec:
    """Columns and key of a table; the key is declared, not checked."""

    name: str
    columns: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return row_type(self.columns)


# Columns and keys of the three captured tables.
ORDERS = TableSpec(
    "orders", "id BIGINT, customer_id BIGINT, amount DECIMAL(10,2), status STRING, created_at TIMESTAMP_NTZ", ("id",)
)
CUSTOMERS = TableSpec("customers", "id BIGINT, name STRING, email STRING", ("id",))
OUTBOX_EVENTS = TableSpec(
    "outbox_events", "id BIGINT, destination STRING, payload STRING, created_at TIMESTAMP_NTZ", ("id",)
)


def read_table(changes: DataFrame, spec: TableSpec, value: str = "value", db: str | None = None) -> DataFrame:
    """The changes of one table as typed rows: its columns, and ``op`` and ``pos``.

    Creates, reads and updates give the row after the change, deletes the row before it.
    """
    if {"db", "table"} <= set(changes.columns):
        # A log by table: its directories are the filter, and a text is parsed once.
        named, database = F.col("table"), F.col("db")
    else:
        # By path: on the parsed columns the filter would parse whole envelopes a second time.
        named, database = (F.get_json_object(value, f"$.source.{part}") for part in ("table", "db"))
    wanted = named == spec.name
    if db:
        wanted = wanted & (database == db)
    image = F.coalesce("after", "before")
    return parse_envelope(changes.where(wanted), spec.schema, value).select(
        *[image[name].alias(name) for name in spec.schema.names], "op", F.col("source")["pos"].alias("pos")
    )


def read_parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_parquet_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream ``<folder>/<name>.parquet``, a single file or a directory of part files."""
    path = f"{folder}/{name}.parquet"
    whole = spark.read.parquet(path)
    # A file that is read by its own path is the only one of its frame and has that name.
    is_file = [f.rpartition("/")[2] for f in whole.limit(1).inputFiles()] == [f"{name}.parquet"]
    reader = spark.readStream.schema(whole.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A file stream watches directories; a single file is picked out of its folder by name.
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder) if is_file else reader.parquet(path)
