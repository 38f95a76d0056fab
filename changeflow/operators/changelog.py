"""Changelogs: folds to state, tombstones, order, evolution and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.jsonvalue import JsonObject, json_object
from changeflow.operators.keyed_order import CHUNK_WIDTH, number_in_key, position_chunk


def as_append(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """An append changelog: every change is a record of its own, so nothing is folded."""
    return df.select(*columns) if columns else df


def compact(df: DataFrame, key: list[str], offset: str) -> DataFrame:
    """The latest record of each key, tombstones included.

    ``offset`` is unique within a key. Each task reduces its input to one row per key before the shuffle, so a hot key
    sends one row per task.
    """
    rest = [name for name in df.columns if name not in key]
    latest = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(offset)).alias("_latest"))
    return latest.select(*key, *[F.col("_latest")[name].alias(name) for name in rest]).select(*df.columns)


def current_state(df: DataFrame, key: list[str], pos: str, op: str = "op") -> DataFrame:
    """The latest image of each key; a key whose last op is a delete is absent."""
    return compact(df, key, pos).where(F.col(op) != "d")


def state_as_of(
    df: DataFrame, key: list[str], pos: str, at: Column | int | str, op: str = "op", cut: str | None = None
) -> DataFrame:
    """The state after every change up to and including ``at``, a value on the axis of ``cut``, or of ``pos`` without it.

    Changes are folded by ``pos`` either way, so changes at the same time are told apart.
    """
    return current_state(df.where(F.col(cut or pos) <= at), key, pos, op)


def dedup_events(df: DataFrame, id_cols: list[str], ts: str | None = None, delay: str | None = None) -> DataFrame:
    """One record per event id.

    On a stream, ``ts`` and ``delay`` bound the ids that are remembered: copies that arrive within ``delay`` of event
    time are dropped.
    """
    if df.isStreaming:
        if not (ts and delay):
            raise ValueError("a stream needs ts and delay, or the remembered ids grow without end")
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(id_cols)
    return df.dropDuplicates(id_cols)


def ordered(df: DataFrame, key: list[str], pos: str, width: int = CHUNK_WIDTH, name: str = "seq") -> DataFrame:
    """Add ``seq``, the place of each change among the changes of its key."""
    return number_in_key(df, key, pos, position_chunk(pos, width), name)


def evolve(df: DataFrame, row: T.StructType | str, value: str = "value") -> DataFrame:
    """Rows of texts written under older and newer schemas, in one schema.

    ``row`` is the widest schema. A column that a text does not have is null, and ``has_<column>`` tells such a null
    from one that was written.
    """
    schema = T.StructType.fromDDL(row) if isinstance(row, str) else row
    parsed = df.withColumn("_object", json_object(F.col(value)).column)
    found = JsonObject(F.col("_object"))
    columns: dict[str, Column] = {}
    for field in schema.fields:
        text = found.text(field.name, default=None)
        columns[field.name] = text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)
        columns[f"has_{field.name}"] = found.has(field.name)
    return parsed.withColumns(columns).drop("_object")


def evolve_tables(versions: list[DataFrame]) -> DataFrame:
    """Union of typed tables of successive schemas; a column that a version lacks is null."""
    return reduce(lambda older, newer: older.unionByName(newer, allowMissingColumns=True), versions)


def diff_states(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The changes that turn one state into the other: ``key, op, before, after``.

    Keys are unique on both sides, so the join has no hot group.
    """
    fields = [name for name in new.columns if name not in key]
    before = old.select(*key, F.struct(*fields).alias("before"))
    after = new.select(*key, F.struct(*fields).alias("after"))
    both = before.join(after, key, "full_outer")
    op = (
        F.when(F.col("before").isNull(), F.lit("c"))
        .when(F.col("after").isNull(), F.lit("d"))
        .when(~F.col("before").eqNullSafe(F.col("after")), F.lit("u"))
    )
    return both.select(*key, op.alias("op"), "before", "after").where(F.col("op").isNotNull())


def update_delta(df: DataFrame, numbers: list[str], texts: list[str]) -> DataFrame:
    """For updates only: ``<number>_delta`` and ``<text>_changed`` between the images."""
    before, after = F.col("before"), F.col("after")
    columns = {f"{name}_delta": after[name] - before[name] for name in numbers}
    columns |= {f"{name}_changed": ~before[name].eqNullSafe(after[name]) for name in texts}
    return df.where(F.col("op") == "u").withColumns(columns)
