"""Reading topic records ``topic, partition, offset, key, value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def poll(df: DataFrame, topic: str, n: int, offset: str = "offset") -> DataFrame:
    """The first ``n`` records of a topic; each task keeps ``n`` at most, so nothing is sorted as a whole."""
    return df.where(F.col("topic") == topic).orderBy(offset).limit(n)


def first_match(df: DataFrame, topic: str, predicate: Column, offset: str = "offset") -> DataFrame:
    """The first record of a topic that satisfies the predicate."""
    return df.where((F.col("topic") == topic) & predicate).orderBy(offset).limit(1)


def count_matching(df: DataFrame, topic: str, predicate: Column) -> DataFrame:
    """How many records of a topic satisfy the predicate."""
    return df.where((F.col("topic") == topic) & predicate).agg(F.count("*").cast("bigint").alias("n"))
