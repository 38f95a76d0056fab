"""Order-dependent columns per key that no hot key can slow down.

``lag`` over a window partitioned by key puts every row of a key into one task. Here the order axis is cut into chunks, rows
are shuffled once by (keys, chunk), and the last row of each key and chunk carries values on to the next chunk. A key that
holds a third of all rows is spread over as many tasks as it has chunks. The plan is the same for every size and does
not count anything first.

What is carried is taken from the rows as they were shuffled, so what is joined or united with them reads the same exchange.

Keys may be null; null is a key like any other. ``order`` is unique in each key and not null; ``chunk`` is a whole number
that does not fall as ``order`` rises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Log positions per chunk: as many rows of one key as one task sorts at most.
CHUNK_WIDTH = 4_000_000


def position_chunk(position: str, width: int = CHUNK_WIDTH) -> Column:
    """Chunk number of a numeric log position."""
    return F.expr(f"`{position}` div {int(width)}")


def _shuffled(df: DataFrame, keys: list[str], chunk: Column) -> tuple[DataFrame, list[str]]:
    """Rows dealt by key and chunk, and the names of those two columns.

    The key is one struct, since structs with nulls inside are equal where single nulls are not.
    """
    cut = df.withColumn("_chunk", chunk.cast("bigint"))
    by = ["_chunk"]
    if keys:
        cut = cut.withColumn("_key", F.struct(*keys))
        by = ["_key", "_chunk"]
    return cut.repartition(*by), by


def _in_chunk(by: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order)


def _over_chunks(by: list[str]) -> WindowSpec:
    return Window.partitionBy(*by[:-1]).orderBy("_chunk")


def _last_rows(near: DataFrame, by: list[str], order: str) -> DataFrame:
    """The last row of each key and chunk, in the column ``_last``."""
    return near.groupBy(*by).agg(F.max_by(F.struct(*[F.col(c) for c in near.columns]), order).alias("_last"))


def previous_in_key(
    df: DataFrame, keys: list[str], order: str, values: list[str], chunk: Column, prefix: str = "prev_"
) -> DataFrame:
    """Add ``<prefix><value>``: each value in the row before this one in its key, null in the first row."""
    rows, by = _shuffled(df, keys, chunk)
    given = F.struct(*[F.col(value).alias(value) for value in values])
    near = rows.withColumns(
        {"_near": F.lag(given).over(_in_chunk(by, order)), "_ends": F.lead(F.lit(True)).over(_in_chunk(by, order)).isNull()}
    )

    def out(frame: DataFrame, previous: str) -> DataFrame:
        return frame.select(*df.columns, *[F.col(previous)[value].alias(prefix + value) for value in values])

    # Rows with one before them in their chunk are done; first rows look for the last row of an earlier chunk of their key. Both read
    # one exchange, and only first and last rows are dealt again.
    edges = near.where(F.col("_near").isNull() | F.col("_ends"))
    over_key = Window.partitionBy(*by[:-1]).orderBy("_chunk", order)
    edges = edges.withColumn("_carried", F.lag(given).over(over_key))
    return out(near.where(F.col("_near").isNotNull()), "_near").unionAll(out(edges.where(F.col("_near").isNull()), "_carried"))


def number_in_key(df: DataFrame, keys: list[str], order: str, chunk: Column, name: str = "seq") -> DataFrame:
    """Add ``name``: 1 for the first row of each key in ``order``, and so on without gaps."""
    return running_sum_in_key(df, keys, order, {name: F.lit(1).cast("bigint")}, chunk)


def running_sum_in_key(
    df: DataFrame, keys: list[str], order: str, amounts: dict[str, Column], chunk: Column
) -> DataFrame:
    """Add the running sum of each amount per key, this row included; null where all amounts so far are null."""
    priced = df.withColumns({f"_amount_{name}": amount for name, amount in amounts.items()})
    rows, by = _shuffled(priced, keys, chunk)
    so_far = _in_chunk(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = rows.withColumns({f"_near_{name}": F.sum(f"_amount_{name}").over(so_far) for name in amounts})
    totals = [F.col("_last")[f"_near_{name}"].alias(f"_total_{name}") for name in amounts]
    before = _over_chunks(by).rowsBetween(Window.unboundedPreceding, -1)
    carry = _last_rows(near, by, order).select(*by, *totals).select(
        *by, *[F.sum(f"_total_{name}").over(before).alias(f"_carried_{name}") for name in amounts]
    )

    def total(name: str) -> Column:
        own, carried = F.col(f"_near_{name}"), F.col(f"_carried_{name}")
        return F.coalesce(own + carried, own, carried).alias(name)

    return near.join(carry, by, "left").select(*df.columns, *[total(name) for name in amounts])
