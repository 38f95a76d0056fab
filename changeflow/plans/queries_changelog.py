"""Queries for sources and changelog semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.topics import topic_name
from changeflow.operators.changelog import (
    as_append,
    compact,
    current_state,
    dedup_events,
    diff_states,
    evolve,
    ordered,
    state_as_of,
    update_delta,
)
from changeflow.operators.envelope import parse_envelope
from changeflow.operators.history import observed_fields
from changeflow.plans.expected import with_inputs
from changeflow.plans.queries_format import DATABASE_ROWS
from changeflow.plans.registry import query
from changeflow.session import work_dir
from changeflow.sources import derived
from changeflow.sources.changelog import (
    TOPIC_RECORD,
    filter_tables,
    range_number,
    read_changelog,
    read_outbox,
    snapshot_then_log,
    write_changelog,
)
from changeflow.sources.snapshot import ChunkedSnapshot
from changeflow.sources.tables import CUSTOMERS, ORDERS, OUTBOX_EVENTS, read_table
from changeflow.sources.topics import count_matching, first_match, poll

MIDDLE = f"TIMESTAMP '{derived.SCHEMA_CHANGE}'"


# --- sources ------------------------------------------------------------------------------------------------------


def written_log(spark: SparkSession, folder: str) -> str:
    """The change log of the database as topic records by table, in the shared working folder."""
    path = work_dir(spark, "changelog")
    log = derived.database_log(spark, folder)
    records = log.select(
        *[
            (F.col("value") if f.name == "value" else F.lit("shop.log") if f.name == "topic" else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in TOPIC_RECORD.fields
        ]
    )
    write_changelog(records, path)
    return path


@query("src_changelog_multi", with_inputs("f_ord", "f_cust", "f_out", select=DATABASE_ROWS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    tables = ["shop.orders", "shop.customers", "shop.outbox_events"]
    log = read_changelog(spark, written_log(spark, folder), tables, by_table=True)
    return parse_envelope(log, "id BIGINT").select(
        F.col("source")["table"].alias("table_name"), "op", F.col("after")["id"].alias("id")
    )


@query(
    "src_outbox",
    with_inputs(
        "f_out",
        select="SELECT id, destination, payload, date_trunc('milliseconds', created_at) AS created_at FROM f_out",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    log = read_outbox(spark, written_log(spark, folder), "shop", by_table=True)
    return read_table(log, OUTBOX_EVENTS).drop("op", "pos")


@query("src_orders_typed", with_inputs("f_ord", select="SELECT *, 'r' AS op FROM f_ord"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(read_changelog(spark, written_log(spark, folder), by_table=True), ORDERS, db="shop").drop("pos")


@query("src_customers_typed", with_inputs("f_cust", select="SELECT *, 'r' AS op FROM f_cust"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(read_changelog(spark, written_log(spark, folder), by_table=True), CUSTOMERS, db="shop").drop("pos")


def _account_log(spark: SparkSession, folder: str) -> DataFrame:
    """The account changes, out of their envelopes, as ``id, pos, ts, op, amount, status``."""
    texts = derived.account_envelopes(derived.events(spark, folder))
    parsed = parse_envelope(texts.select("pos", "ts", "value"), derived.ACCOUNT_ROW)
    image = F.coalesce("after", "before")
    return parsed.select(
        image["id"].alias("id"),
        "pos",
        "ts",
        "op",
        F.col("after")["amount"].alias("amount"),
        F.col("after")["status"].alias("status"),
    )


FOLD = """SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS rn FROM f_log {where}) a
    WHERE rn = 1 {live}"""


def _middle_position(spark: SparkSession, folder: str) -> int:
    middle = F.lit(derived.SCHEMA_CHANGE).cast("timestamp_ntz")
    return derived.events(spark, folder).where(F.col("ts") < middle).agg(F.max("event_id")).first()[0]


@query(
    "snapshot_then_log",
    with_inputs(
        "f_log",
        select="""WITH high AS (SELECT max(event_id) AS pos FROM events WHERE ts < {m}),
            old AS ({fold})
            SELECT 'r' AS op, id, (SELECT pos FROM high) AS pos, after_amount AS amount, after_status AS status FROM old
            UNION ALL SELECT op, id, pos, after_amount, after_status FROM f_log WHERE pos > (SELECT pos FROM high)""".format(
            m=MIDDLE, fold=FOLD.format(cols="*", where="WHERE pos <= (SELECT pos FROM high)", live="AND op <> 'd'")
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    log = _account_log(spark, folder).drop("ts")
    high = _middle_position(spark, folder)
    snapshot = state_as_of(log, ["id"], "pos", high).drop("op", "pos")
    return snapshot_then_log(snapshot, log, high)


@query(
    "snapshot_chunks",
    with_inputs("f_log", select=FOLD.format(cols="id, after_amount AS amount, after_status AS status", where="", live="AND op <> 'd'")),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot of the accounts in chunks while they change, stopped after two of them and taken up again.

    The log is as far as the source has come. Each group of chunks is read in the middle of the changes between its positions.
    """
    path = work_dir(spark, "account-log")
    _account_log(spark, folder).drop("ts").write.parquet(path)
    log = spark.read.parquet(path)
    bounds = log.agg(F.min("id").alias("lower"), F.max("id").alias("upper"), F.max("pos").alias("last")).first()
    snapshot = ChunkedSnapshot(work_dir(spark, "snapshot"), "id", bounds["lower"] or 0, bounds["upper"] or 0, 4)
    step = (bounds["last"] or 0) // 9 + 1
    now = [0]

    def position() -> int:
        now[0] += step
        return now[0]

    def read(where: Column) -> DataFrame:
        return state_as_of(log, ["id"], "pos", now[0] + step // 2).where(where).drop("op", "pos")

    for limit in (2, None):
        snapshot.take(spark, read, position, limit=limit)
    return current_state(snapshot.changes(spark, log), ["id"], "pos").select("id", "amount", "status")


@query(
    "snapshot_parallel",
    with_inputs(
        "f_ord",
        select="""WITH b AS (SELECT min(id) AS lo, max(id) AS hi FROM f_ord)
            SELECT least((id - lo) * 16 // (hi - lo + 1), 15) AS range_no, CAST(count(*) AS BIGINT) AS n, min(id) AS first_id,
                max(id) AS last_id, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM f_ord, b GROUP BY 1""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived.orders(spark, folder)
    lower, upper = rows.agg(F.min("id"), F.max("id")).first()
    return rows.groupBy(range_number(F.col("id"), lower, upper, 16).alias("range_no")).agg(
        F.count("*").alias("n"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.sum("amount").cast("decimal(38,2)").alias("total"),
    )


@query(
    "filter_tables",
    with_inputs(
        "f_ord", "f_cust", "f_out", select=f"SELECT * FROM ({DATABASE_ROWS}) a WHERE table_name <> 'customers'"
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    log = read_changelog(spark, written_log(spark, folder))
    kept = filter_tables(log, ["shop.orders", "shop.outbox_events", "other.customers"])
    return parse_envelope(kept, "id BIGINT").select(
        F.col("source")["table"].alias("table_name"), "op", F.col("after")["id"].alias("id")
    )


def _outbox_topics(spark: SparkSession, folder: str) -> DataFrame:
    events = derived.events(spark, folder)
    return events.select(
        topic_name("shop.outbox", F.col("event_type")).alias("topic"),
        F.col("event_id").alias("offset"),
        "value",
        "props",
    )


@query(
    "poll_topic",
    """SELECT event_id AS "offset", props AS payload FROM events WHERE event_type = 'click'
        ORDER BY event_id LIMIT 50""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return poll(_outbox_topics(spark, folder), "shop.outbox.click", 50).select("offset", F.col("props").alias("payload"))


@query(
    "first_match",
    """SELECT event_id AS "offset", props AS payload FROM events WHERE event_type = 'view' AND value > 100
        ORDER BY event_id LIMIT 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = first_match(_outbox_topics(spark, folder), "shop.outbox.view", F.col("value") > 100)
    return found.select("offset", F.col("props").alias("payload"))


@query(
    "count_matching", "SELECT CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'purchase' AND value > 100"
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return count_matching(_outbox_topics(spark, folder), "shop.outbox.purchase", F.col("value") > 100)


# --- changelog semantics ------------------------------------------------------------------------------------------


@query("changelog_append", with_inputs("f_log", select="SELECT id, pos, op, after_amount AS amount, after_status AS status FROM f_log"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return as_append(_account_log(spark, folder), ["id", "pos", "op", "amount", "status"])


@query(
    "current_state",
    with_inputs(
        "f_log",
        select=FOLD.format(
            cols="id, pos, op, after_amount AS amount, after_status AS status", where="", live="AND op <> 'd'"
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return current_state(_account_log(spark, folder).drop("ts"), ["id"], "pos")


@query(
    "compact_topic",
    with_inputs("f_log", select=FOLD.format(cols="id, pos, op = 'd' AS tombstone, after_status AS status", where="", live="")),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    latest = compact(_account_log(spark, folder).select("id", "pos", "op", "status"), ["id"], "pos")
    return latest.select("id", "pos", (F.col("op") == "d").alias("tombstone"), "status")


@query(
    "state_as_of",
    with_inputs(
        "f_log",
        select=FOLD.format(
            cols="id, pos, ts, after_amount AS amount, after_status AS status", where=f"WHERE ts <= {MIDDLE}", live="AND op <> 'd'"
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    at = F.lit(derived.SCHEMA_CHANGE).cast("timestamp_ntz")
    return state_as_of(_account_log(spark, folder), ["id"], "pos", at, cut="ts").drop("op")


@query("dedup_events", "SELECT event_id AS id, event_type AS destination, props AS payload FROM events")
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Every purchase and every large value is delivered more than once.
    events = derived.events(spark, folder)
    copies = F.when(F.col("event_type") == "purchase", 2).otherwise(1) + F.when(F.col("value") > 100, 1).otherwise(0)
    delivered = events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("destination"),
        F.col("props").alias("payload"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    )
    return dedup_events(delivered.drop("copy"), ["id"])


@query(
    "changelog_ordered",
    with_inputs("f_log", select="SELECT id, pos, op, row_number() OVER (PARTITION BY id ORDER BY pos) AS seq FROM f_log"),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ordered(_account_log(spark, folder).select("id", "pos", "op"), ["id"], "pos")


@query(
    "schema_evolve",
    f"""SELECT event_id AS pos, event_id AS id, event_type AS destination,
        CASE WHEN ts >= {MIDDLE} AND event_type <> 'error' THEN 'v2-' || event_type END AS new_field,
        ts >= {MIDDLE} AS has_new_field FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = derived.evolving_texts(derived.events(spark, folder)).select("pos", "value")
    return evolve(texts, "id BIGINT, destination STRING, new_field STRING").select(
        "pos", "id", "destination", "new_field", "has_new_field"
    )


@query(
    "diff_states",
    with_inputs(
        "f_log",
        select="""WITH old AS ({old}), new AS ({new})
            SELECT COALESCE(o.id, n.id) AS id,
                CASE WHEN o.id IS NULL THEN 'c' WHEN n.id IS NULL THEN 'd' ELSE 'u' END AS op,
                o.after_amount AS before_amount, n.after_amount AS after_amount
            FROM old o FULL OUTER JOIN new n ON o.id = n.id
            WHERE o.id IS NULL OR n.id IS NULL OR o.after_amount IS DISTINCT FROM n.after_amount
                OR o.after_status IS DISTINCT FROM n.after_status""".format(
            old=FOLD.format(cols="*", where=f"WHERE ts <= {MIDDLE}", live="AND op <> 'd'"),
            new=FOLD.format(cols="*", where="", live="AND op <> 'd'"),
        ),
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    log = _account_log(spark, folder)
    at = F.lit(derived.SCHEMA_CHANGE).cast("timestamp_ntz")
    old = state_as_of(log, ["id"], "pos", at, cut="ts").select("id", "amount", "status")
    new = current_state(log, ["id"], "pos").select("id", "amount", "status")
    return diff_states(old, new, ["id"]).select(
        "id", "op", F.col("before")["amount"].alias("before_amount"), F.col("after")["amount"].alias("after_amount")
    )


@query(
    "update_delta",
    with_inputs(
        "f_log",
        select="""SELECT pos, id, CAST(after_amount - before_amount AS DECIMAL(11,2)) AS amount_delta,
            after_status <> before_status AS status_changed FROM f_log WHERE op = 'u'""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    changes = derived.account_changes(derived.events(spark, folder))
    return update_delta(changes, ["amount"], ["status"]).select("pos", "id", "amount_delta", "status_changed")


@query(
    "observed_fields",
    f"""SELECT event_type AS topic, f.field, f.kind, min(event_id) AS first_pos, max(event_id) AS last_pos, count(*) AS records
        FROM events, (SELECT unnest([
            {{'field': 'id', 'kind': 'BIGINT', 'late': FALSE}}, {{'field': 'destination', 'kind': 'STRING', 'late': FALSE}},
            {{'field': 'new_field', 'kind': 'STRING', 'late': TRUE}}, {{'field': 'new_field', 'kind': 'VOID', 'late': TRUE}}]) AS f) x
        WHERE NOT f.late OR (ts >= {MIDDLE} AND (event_type = 'error') = (f.kind = 'VOID')) GROUP BY ALL""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Which fields and kinds of values the texts of a topic hold, and from which position on."""
    return observed_fields(derived.evolving_texts(derived.events(spark, folder)), "topic", "pos")
