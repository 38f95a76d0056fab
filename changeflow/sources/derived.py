"""Change-event inputs derived from the analytic tables: rows, change logs, envelopes, faults and metrics.

The derivations read whole tables and stay distributed. Faults follow from what a row holds, so every engine finds the
same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.operators.envelope import epoch_millis, source_struct, to_envelope
from changeflow.operators.keyed_order import (
    CHUNK_WIDTH,
    position_chunk,
    previous_in_key,
    running_sum_in_key,
)
from changeflow.sources.tables import read_parquet_table

DATABASE = "shop"
ACCOUNT_ROW = "id BIGINT, amount DECIMAL(10,2), status STRING"
SCHEMA_CHANGE = "2024-01-16 00:00:00"


# --- row images ---------------------------------------------------------------------------------------------------


def order_rows(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def customer_rows(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_rows(read_parquet_table(spark, folder, "orders"))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return customer_rows(read_parquet_table(spark, folder, "customer"))


def outbox(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("destination"),
        F.col("props").alias("payload"),
        F.col("ts").alias("created_at"),
        *more,
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet_table(spark, folder, "events")


# --- change logs --------------------------------------------------------------------------------------------------


def account_changes(events: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """A legal change log of one account per user: ``before, after, op, source, ts_ms`` and ``pos, ts, id``.

    An error deletes the account, the first other event creates it and later ones update it; an error without an
    account changes nothing.
    """
    paired = previous_in_key(
        events.select("event_id", "ts", "user_id", "event_type", "value"),
        ["user_id"],
        "event_id",
        ["event_type", "value"],
        position_chunk("event_id", width),
    )
    deletes = F.col("event_type") == "error"
    absent = F.col("prev_event_type").isNull() | (F.col("prev_event_type") == "error")
    op = F.when(deletes, F.lit("d")).when(absent, F.lit("c")).otherwise(F.lit("u"))
    return _changes(
        paired.where(~(deletes & absent)),
        pos="event_id",
        ts="ts",
        table="accounts",
        op=op,
        before=F.when(~absent, _account("prev_value", "prev_event_type")),
        after=F.when(~deletes, _account("value", "event_type")),
        keep={"id": F.col("user_id")},
    )


def account_upserts(events: DataFrame) -> DataFrame:
    """The same accounts as an upsert log, told from each event alone, so that it works on a stream.

    A delete of an absent account is a tombstone nobody misses.
    """
    deletes = F.col("event_type") == "error"
    return events.select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("pos"),
        "ts",
        F.when(deletes, F.lit("d")).otherwise(F.lit("u")).alias("op"),
        F.when(~deletes, F.col("value").cast("decimal(10,2)")).alias("amount"),
        F.when(~deletes, F.col("event_type")).alias("status"),
    )


def claimed_ops(events: DataFrame) -> DataFrame:
    """Ops as a careless producer would claim them: signups create, errors delete, all else updates."""
    op = F.when(F.col("event_type") == "signup", F.lit("c")).when(F.col("event_type") == "error", F.lit("d"))
    return events.select(
        F.col("user_id").alias("id"), F.col("event_id").alias("pos"), op.otherwise(F.lit("u")).alias("op")
    )


def _account(value: str, status: str) -> Column:
    return F.struct(
        F.col("user_id").alias("id"),
        F.col(value).cast("decimal(10,2)").alias("amount"),
        F.col(status).alias("status"),
    )


def _changes(
    df: DataFrame,
    pos: str | None,
    ts: str | None,
    table: str,
    op: Column,
    before: Column | None,
    after: Column,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    millis = epoch_millis(F.col(ts)) if ts else F.lit(None).cast("bigint")
    position = F.col(pos) if pos else F.lit(None)
    columns = {
        "pos": position.cast("bigint"),
        "ts": F.col(ts) if ts else F.lit(None).cast("timestamp_ntz"),
        **(keep or {}),
        "before": before if before is not None else F.when(F.lit(False), after),
        "after": after,
        "op": op,
        "source": source_struct(DATABASE, table, millis, position),
        "ts_ms": millis,
    }
    return df.select(*[column.alias(name) for name, column in columns.items()])


def account_envelopes(events: DataFrame) -> DataFrame:
    return to_envelope(account_changes(events)).select("pos", "ts", "id", "value")


def outbox_changes(events: DataFrame) -> DataFrame:
    rows = outbox(events)
    return _changes(
        rows, "id", "created_at", "outbox_events", F.lit("c"), None, F.struct(*rows.columns), {"id": F.col("id")}
    )


def outbox_envelopes(events: DataFrame) -> DataFrame:
    return to_envelope(outbox_changes(events)).select("pos", "ts", "id", "value")


def order_changes(rows: DataFrame) -> DataFrame:
    return _changes(rows, None, "created_at", "orders", F.lit("r"), None, F.struct(*rows.columns), {"id": F.col("id")})


def customer_changes(rows: DataFrame) -> DataFrame:
    return _changes(rows, None, None, "customers", F.lit("r"), None, F.struct(*rows.columns), {"id": F.col("id")})


def database_envelopes(orders: DataFrame, customers: DataFrame, events: DataFrame) -> DataFrame:
    """The change log of all three tables, ``value`` only: snapshot reads of two, creates of the outbox."""
    parts = [order_changes(orders), customer_changes(customers), outbox_changes(events)]
    texts = [to_envelope(part).select("value") for part in parts]
    return texts[0].unionAll(texts[1]).unionAll(texts[2])


def database_log(spark: SparkSession, folder: str) -> DataFrame:
    return database_envelopes(orders(spark, folder), customers(spark, folder), events(spark, folder))


# --- texts with faults --------------------------------------------------------------------------------------------


def raw_texts(events: DataFrame) -> DataFrame:
    """Flat JSON texts of the events, as good as their producers.

    Clicks have a space after each colon, signups lack the closing brace, errors are a lone brace.
    """
    text = F.concat(
        F.lit('{"id":'),
        F.col("event_id").cast("string"),
        F.lit(',"destination":"'),
        F.col("event_type"),
        F.lit('","payload":'),
        F.col("props"),
        F.lit("}"),
    )
    spaced = F.concat(
        F.lit('{"id": '),
        F.col("event_id").cast("string"),
        F.lit(', "destination": "'),
        F.col("event_type"),
        F.lit('", "payload": '),
        F.col("props"),
        F.lit("}"),
    )
    value = (
        F.when(F.col("event_type") == "click", spaced)
        .when(F.col("event_type") == "signup", F.left(text, F.length(text) - 1))
        .when(F.col("event_type") == "error", F.lit("}"))
        .otherwise(text)
    )
    return events.select(F.col("event_id").alias("pos"), "ts", F.col("event_type").alias("destination"), value.alias("value"))


def evolving_texts(events: DataFrame) -> DataFrame:
    """Outbox rows as JSON texts; from the schema change on they carry ``new_field``, null for errors."""
    after = F.col("ts") >= F.lit(SCHEMA_CHANGE).cast("timestamp_ntz")
    old = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("destination")))
    new_field = F.when(F.col("event_type") != "error", F.concat(F.lit("v2-"), F.col("event_type")))
    new = F.to_json(
        F.struct(
            F.col("event_id").alias("id"), F.col("event_type").alias("destination"), new_field.alias("new_field")
        ),
        {"ignoreNullFields": "false"},
    )
    return events.select(
        F.col("event_id").alias("pos"), "ts", F.col("event_type").alias("topic"), F.when(after, new).otherwise(old).alias("value")
    )


def emitted_orders(orders: DataFrame) -> DataFrame:
    """Emitted orders with faults: the cheapest missing, the dearest twice, some in the middle with a changed status."""
    kept = orders.where(F.col("amount") >= 3000)
    changed = F.when(F.col("amount").between(250000, 252000), F.concat("status", F.lit("!"))).otherwise(F.col("status"))
    copies = F.when(F.col("amount") >= 495000, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return kept.select("id", "customer_id", "amount", changed.alias("status"), F.explode(copies).alias("copy")).select(
        "id", "customer_id", "amount", "status", (F.col("id") * 10 + F.col("copy")).alias("offset")
    )


def emitted_outbox(events: DataFrame) -> DataFrame:
    """Emitted outbox records with faults: small values missing, large ones twice, some much later than their turn."""
    value = F.col("value")
    late = F.when(value.between(100, 110), F.lit(35)).otherwise(F.lit(0))
    copies = F.when(value >= 200, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = events.where(value >= 0.5).withColumns({"late": late, "copies": copies})
    return outbox(kept, "late", "copies").select("*", F.explode("copies").alias("copy")).select(
        "id",
        "destination",
        "payload",
        "created_at",
        # A late record takes an offset between those of later ids; no two records share one.
        (F.col("id") * 10 + F.col("late") + F.col("copy")).alias("offset"),
    )


# --- job metrics --------------------------------------------------------------------------------------------------


def job_metrics(events: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """Samples of five jobs, one every five seconds over all of them.

    The restart counter starts anew every 400 events; slow checkpoints come in bursts of five minutes.
    """
    samples = events.select(
        F.col("event_id").alias("pos"),
        F.concat(F.lit("job_"), (F.col("user_id") % 5).cast("string")).alias("job_name"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id") * 5)).alias("ts"),
        "event_type",
        F.when(F.col("event_id") % 1000 < 60, F.lit(200000)).otherwise(F.round(F.col("value") * 100))
        .cast("bigint")
        .alias("last_checkpoint_duration"),
    )
    error, purchase = F.col("event_type") == "error", F.col("event_type") == "purchase"
    counted = running_sum_in_key(
        samples,
        ["job_name"],
        "pos",
        {
            "num_failed_checkpoints": F.when(purchase, F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
            "num_completed_checkpoints": F.when(~error, F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
        },
        position_chunk("pos", width),
    )
    lives = counted.withColumn("_life", F.floor(F.col("pos") / 400))
    # A life is 400 positions long, so this window is small whatever the table holds.
    in_life = Window.partitionBy("job_name", "_life").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    restarts = F.sum(F.when(error, F.lit(1)).otherwise(F.lit(0))).over(in_life).cast("bigint")
    return lives.withColumn("num_restarts", restarts).select(
        "job_name",
        "ts",
        "num_restarts",
        "num_failed_checkpoints",
        "num_completed_checkpoints",
        "last_checkpoint_duration",
    )
