"""Snapshots of a keyed table in chunks, taken while the table changes, and reconciled with its log.

The table is cut into ranges of its key. A group of chunks is read between two positions of the log, a low one noted before and a
high one after; so what is read of a key is its state at some position between them. A key without a change between the two
stands as it was read. A key with one is left to the log, which holds what it became. From the low position of its chunk on,
the log says all that happens to a key, so the reads and these changes fold to the state of the table at every position
from the last high one on, and no lock is held and no change waits for the snapshot.

A chunk that has been read is written with its two positions and is not read again when a snapshot goes on after a failure. Changes
of chunks that are not read yet are left out; their reads will hold them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import batched

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.sources.changelog import range_number

#: Reads the rows of a table that satisfy a predicate on its key, as they are now.
ReadRows = Callable[[Column], DataFrame]
#: The position of the last change that the log holds now; -1 where it holds none.
Position = Callable[[], int]


@dataclass(frozen=True)
class ChunkedSnapshot:
    """A snapshot below ``path`` of a table with a whole-numbered key between ``lower`` and ``upper``, in ``parts`` ranges.

    Keys outside of the bounds, such as those of rows that are added later, belong to the outer ranges.
    """

    path: str
    key: str
    lower: int
    upper: int
    parts: int

    def chunk_of(self, key: Column) -> Column:
        inside = F.greatest(F.least(key, F.lit(self.upper)), F.lit(self.lower))
        return range_number(inside, self.lower, self.upper, self.parts).cast("int")

    def done(self, spark: SparkSession) -> DataFrame | None:
        """The finished chunks: ``chunk, low, high``; None before the first."""
        try:
            return spark.read.schema("chunk INT, low BIGINT, high BIGINT, first INT").parquet(f"{self.path}/done").drop("first")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def take(self, spark: SparkSession, read: ReadRows, position: Position, together: int = 1, limit: int | None = None) -> int:
        """Read the chunks that are not finished, ``together`` at a time and ``limit`` groups at most; how many chunks were read.

        Each group is one job. Its marker is written last and holds its positions, so a group that fails is read as a whole again,
        between positions of its own.
        """
        done = self.done(spark)
        # One short row a chunk.
        finished = {r["chunk"] for r in done.collect()} if done is not None else set()
        taken = 0
        for number, group in enumerate(batched([c for c in range(self.parts) if c not in finished], together)):
            if limit is not None and number >= limit:
                break
            chunk, low = self.chunk_of(F.col(self.key)), position()
            rows = read(chunk.isin(*group)).withColumn("chunk", chunk)
            rows.write.mode("overwrite").partitionBy("chunk").parquet(f"{self.path}/rows/first={group[0]}")
            # Changes that the read may have seen are at this position or before it.
            marker = spark.createDataFrame([(c, low, position()) for c in group], "chunk INT, low BIGINT, high BIGINT").coalesce(1)
            marker.write.mode("overwrite").parquet(f"{self.path}/done/first={group[0]}")
            taken += len(group)
        return taken

    def changes(self, spark: SparkSession, log: DataFrame, pos: str = "pos") -> DataFrame:
        """Reads (op ``r``) and the changes after them of all finished chunks, in the columns of ``log``.

        ``log`` holds the key, ``op``, the position and columns of the table. The finished chunks are few; joins with reads are by
        key, where a hot key meets one read.
        """
        done = self.done(spark)
        if done is None:
            return log.limit(0)
        done = F.broadcast(done)
        marked = log.withColumn("_chunk", self.chunk_of(F.col(self.key))).join(done.withColumnRenamed("chunk", "_chunk"), "_chunk")
        after = marked.where(F.col(pos) > F.col("low"))
        # Which keys changed while they were read: one row a key, however often.
        during = after.where(F.col(pos) <= F.col("high")).select(self.key).distinct()
        columns = [f for f in log.schema.fields if f.name not in ("op", pos)]
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        rows = spark.read.schema(f"{kinds}, first INT, chunk INT").parquet(f"{self.path}/rows")
        # A group that has no marker yet may have left rows; those of a marked one are whole.
        rows = rows.join(done, "chunk").join(during, self.key, "left_anti")
        reads = rows.select(*[F.col(f.name) for f in columns], F.lit("r").alias("op"), F.col("low").alias(pos))
        return reads.select(*log.columns).unionByName(after.select(*log.columns))
