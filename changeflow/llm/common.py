"""What the operators of this package share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import work_dir

#: White space between words: space and the control characters from tab to carriage return.
BREAK = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """The rows of ``frame``, computed once and written to the shared folder, so a lost executor costs one task."""
    spark = frame.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or work_dir(spark, "cut"))
    return frame.checkpoint(eager=True)


def every_column(frame: DataFrame) -> list[Column]:
    """All columns by their quoted names; kept in a struct, they cannot clash with columns an operator adds."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in frame.columns]


def once(value: Column) -> Column:
    """``value`` computed once a row: a generator stops the optimizer from copying it into lambda bodies."""
    return F.explode(F.array(value))


def at_most(frame: DataFrame, rows: int) -> bool:
    """True if the frame holds no more than so many rows; reads no further than that."""
    return frame.limit(rows + 1).count() <= rows


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of so many rows for what runs inside, where rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
