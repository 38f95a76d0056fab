"""Sequenced delivery: records say where in the log they come from, and a consumer drops what is not newer.

A broker that delivers at least once repeats records, and a producer that starts again sends old ones after new ones. The position
travels in the headers of a record, so any consumer can tell, and a state of one position a key is enough to do so.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels to the executors whole, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POSITION, SOURCE_TABLE = "position", "table"
HEADERS = "array<struct<key: string, value: binary>>"


def with_headers(records: DataFrame, pos: str = "offset", table: Column | None = None) -> DataFrame:
    """Records with ``headers`` that hold their position as decimal text and, if given, the table they are of."""
    named = [(POSITION, F.col(pos).cast("string")), *([(SOURCE_TABLE, table.cast("string"))] if table is not None else [])]
    entries = [F.when(text.isNotNull(), F.struct(F.lit(name).alias("key"), text.cast("binary").alias("value"))) for name, text in named]
    return records.withColumn("headers", F.array_compact(F.array(*entries)).cast(HEADERS))


def header(name: str) -> Column:
    """The text of a record's last header of a name; null where it has none."""
    held = F.filter("headers", lambda h: h["key"] == name)
    return F.try_element_at(held, F.lit(-1))["value"].cast("string")


def from_headers(records: DataFrame, into: str = "position", table: str = "source_table") -> DataFrame:
    """Add the position and the table that the headers hold, null where they hold none."""
    return records.withColumns({into: header(POSITION).try_cast("bigint"), table: header(SOURCE_TABLE)})


#: Rows that a task takes in before it goes over them, besides those it holds.
HELD = 100_000


def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The newest row of each ``_key`` in the rows of a task, which holds little more than that."""
    held, new, rows, schema = None, [], 0, None
    for batch in batches:
        schema = batch.schema
        new.append(batch.to_pandas())
        rows += batch.num_rows
        if rows >= HELD + (0 if held is None else len(held)):
            held, new, rows = _last_of_each([held, *new]), [], 0
    if schema is not None:
        yield from pa.Table.from_pandas(_last_of_each([held, *new]), schema, preserve_index=False).to_batches(HELD)


def _last_of_each(parts: list[pd.DataFrame | None]) -> pd.DataFrame:
    rows = pd.concat([part for part in parts if part is not None], ignore_index=True)
    return rows.sort_values("_pos", kind="stable").drop_duplicates("_key", keep="last")


class _Newer(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "pos LONG")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        newest = None
        for row in rows:
            if row["_pos"] is not None and (newest is None or row["_pos"] > newest["_pos"]):
                newest = row
        if newest is not None and (last is None or newest["_pos"] > last):
            self.last.update((newest["_pos"],))
            yield Row(key=newest["key"], position=newest["_pos"], value=newest["value"])

    def close(self) -> None:
        pass


def newer_only(records: DataFrame, pos: str = "position") -> DataFrame:
    """Of a stream of ``key, value`` records and their positions, those newer than all before of their key: ``key, position, value``.

    In one batch the newest record of a key stands for the others, and is the only one that the state sees. What was delivered
    again, or late, is dropped; the state holds one position a key, for as long as there may be such a delivery.
    """
    if not records.isStreaming:
        raise ValueError("newer_only takes a stream; compact takes a batch")
    rows = records.select(F.col("key").alias("_key"), "key", "value", F.col(pos).cast("bigint").alias("_pos"))
    schema = rows.schema
    rows = rows.where(F.col("_pos").isNotNull()).repartition("_key").mapInArrow(newest, schema)
    return rows.groupBy("_key").transformWithState(
        statefulProcessor=_Newer(),
        outputStructType="key STRING, position BIGINT, value STRING",
        outputMode="Append",
        timeMode="None",
    )
