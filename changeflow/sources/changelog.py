"""Change logs as DataFrames with a ``value`` column of envelope texts, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

TOPIC_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# The directories of a log that is written by table.
BY_TABLE = [T.StructField("db", T.StringType()), T.StructField("table", T.StringType())]

# Fixed value: the table of outbox events.
OUTBOX_TABLE = "outbox_events"


def read_changelog(
    spark: SparkSession,
    path_or_topic: str,
    tables: list[str] | None = None,
    streaming: bool = False,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
    by_table: bool = False,
) -> DataFrame:
    """The change log of several tables, ``db.table`` names in ``tables``.

    A log that ``write_changelog`` has written is read ``by_table``: only the directories of ``tables`` are read, nothing is parsed
    to find them, and ``db`` and ``table`` are columns. Otherwise every text is parsed to see what table it is of.
    ``fmt`` is ``parquet`` or ``json`` files of topic records, ``text`` files of one envelope per line, or ``kafka``,
    where ``path_or_topic`` is a comma-separated list of topics and the connector package is on the classpath.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**(options or {}))
    if fmt == "kafka":
        reader = reader.option("subscribe", path_or_topic).option("startingOffsets", "earliest")
        raw = reader.option("includeHeaders", "true").load()
        df = raw.select(
            "topic",
            "partition",
            "offset",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "timestamp",
            "headers",
        )
    elif fmt == "text":
        df = reader.load(path_or_topic).select("value")
    else:
        columns = (schema or TOPIC_RECORD).fields + (BY_TABLE if by_table else [])
        df = reader.schema(T.StructType(columns)).load(path_or_topic)
    if tables is None:
        return df
    return filter_tables(df, tables, db="db", table="table") if by_table else filter_tables(df, tables)


def _by_table(records: DataFrame, value: str) -> DataFrame:
    """Records with the database and the table of their texts, which are parsed once, here."""
    source = F.from_json(value, "source STRUCT<db: STRING, table: STRING>")["source"]
    # A generator keeps the parsed struct in one place; as an expression it would be copied to each use.
    parsed = records.select("*", F.explode(F.array(source)).alias("_source"))
    return parsed.select("*", F.col("_source")["db"].alias("db"), F.col("_source")["table"].alias("table")).drop("_source")


def write_changelog(records: DataFrame, path: str, value: str = "value") -> None:
    """Write topic records as a log by database and table, so that readers of one table read no others.

    Texts that name no table are kept apart and read only with all tables. A table with most of the changes is written by all
    tasks.
    """
    _by_table(records, value).write.mode("append").partitionBy("db", "table").parquet(path)


def stream_changelog(records: DataFrame, path: str, checkpoint: str, interval: str | None = None, value: str = "value") -> StreamingQuery:
    """``write_changelog`` for a stream; ``interval`` None works off what is there and ends."""
    writer = _by_table(records, value).writeStream.format("parquet").partitionBy("db", "table")
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start(path)


def filter_tables(
    df: DataFrame, include: list[str], value: str = "value", db: str | None = None, table: str | None = None
) -> DataFrame:
    """Keep changes of the listed ``db.table`` names.

    Where the database and the table are columns of their own, name them: the filter then reaches the file scan, and
    skips whole directories if the files are partitioned by them.
    """
    if db and table:
        # Equalities, not a joined string, so that they can be pushed down.
        wanted = F.lit(False)
        for name in include:
            database, _, plain = name.partition(".")
            wanted = wanted | ((F.col(db) == database) & (F.col(table) == plain))
        return df.where(wanted)
    # Database and table are compared as one struct: each use of a parsed text in a filter parses it again.
    source = F.from_json(value, "source STRUCT<db: STRING, table: STRING>")["source"]
    pairs = [name.partition(".") for name in include]
    return df.where(source.isin(*[F.struct(F.lit(d).alias("db"), F.lit(t).alias("table")) for d, _, t in pairs]))


def read_outbox(
    spark: SparkSession,
    path_or_topic: str,
    database: str,
    streaming: bool = False,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    by_table: bool = False,
) -> DataFrame:
    """The change log of the outbox table of ``database``, and of no other table."""
    tables = [f"{database}.{OUTBOX_TABLE}"]
    return read_changelog(spark, path_or_topic, tables, streaming, fmt, options=options, by_table=by_table)


def snapshot_then_log(snapshot: DataFrame, log: DataFrame, high_pos: Column | int, pos: str = "pos") -> DataFrame:
    """Snapshot rows as reads (op ``r``), then the changes after the position the snapshot was taken at.

    ``snapshot`` holds the columns of ``log`` but for ``op`` and the position.
    """
    high = F.lit(high_pos) if isinstance(high_pos, int) else high_pos
    reads = snapshot.withColumns({"op": F.lit("r"), pos: high.cast("bigint")})
    return reads.unionByName(log.where(F.col(pos) > high), allowMissingColumns=True)


def key_ranges(key: str, lower: int, upper: int, parts: int) -> list[str]:
    """Predicates that cut ``[lower, upper]`` into ``parts`` ranges; the outer ones are open, so no row is left out."""
    if parts <= 1 or upper <= lower:
        return ["1 = 1"]
    cuts = sorted({lower + (upper - lower + 1) * i // parts for i in range(1, parts)} - {lower})
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def snapshot_jdbc(
    spark: SparkSession, url: str, table: str, key: str, parts: int, properties: dict[str, str] | None = None
) -> DataFrame:
    """Snapshot of a keyed table over JDBC, read by ``parts`` tasks, each with a range of keys of its own."""
    settings = dict(properties or {})
    bounds = spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) bounds", properties=settings)
    lower, upper = bounds.first()
    if lower is None:
        return spark.read.jdbc(url, table, properties=settings)
    return spark.read.jdbc(url, table, predicates=key_ranges(key, int(lower), int(upper), parts), properties=settings)


def range_number(key: Column, lower: int, upper: int, parts: int) -> Column:
    """Which of ``parts`` equal ranges of ``[lower, upper]`` a key falls into, from 0."""
    return F.least(F.floor((key - lower) * F.lit(parts) / F.lit(upper - lower + 1)), F.lit(parts - 1)).cast("bigint")
