"""Queries for data-quality and parity audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.topics import topic_name
from changeflow.operators.audit import (
    PLAIN_CONTRACT,
    SQL_CONTRACT,
    STREAM_CONTRACT,
    TABLE_CONTRACT,
    connector_contract,
    continuity,
    contract_report,
    evolution_report,
    exactly_once,
    field_report,
    lifecycle_violations,
    malformed_report,
    null_report,
    order_violations,
    parity,
    parity_digest,
    parity_hash,
    parity_outbox,
    routing_report,
    sink_completeness,
)
from changeflow.operators.enrich import enrich_json, project_tagged, tag_event
from changeflow.operators.envelope import to_envelope, to_upsert_record
from changeflow.operators.route import route_outbox
from changeflow.plans.expected import with_inputs
from changeflow.plans.queries_format import LINK_PREFIX, NOW, STREAM_PREFIX
from changeflow.plans.registry import query
from changeflow.session import work_dir
from changeflow.sources import derived

LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY off DESC) AS rn FROM {src}) z WHERE rn = 1"
MIDDLE = f"TIMESTAMP '{derived.SCHEMA_CHANGE}'"


@query(
    "parity_orders",
    with_inputs(
        "f_emit",
        select=f"""WITH b AS ({LATEST.format(src='f_emit')})
            SELECT a.id, CASE WHEN b.id IS NULL THEN 'only_a' WHEN a.status <> b.status THEN 'changed' ELSE 'equal' END
                AS verdict, CASE WHEN b.id IS NULL THEN NULL WHEN a.status <> b.status THEN 'status' ELSE '' END AS differing
            FROM f_ord a LEFT JOIN b ON a.id = b.id""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = derived.orders(spark, folder)
    a = orders.withColumn("offset", F.col("id"))
    return parity(a, derived.emitted_orders(orders), "id", ["customer_id", "status"], "offset")


OUTBOX_PARITY = with_inputs(
    "f_emit_out",
    select=f"""WITH b AS ({LATEST.format(src='f_emit_out')})
            SELECT a.id, CASE WHEN b.id IS NULL THEN 'only_a' ELSE 'equal' END AS verdict,
                CASE WHEN b.id IS NULL THEN NULL ELSE '' END AS differing
            FROM f_out a LEFT JOIN b ON a.id = b.id""",
)


@query("parity_outbox", OUTBOX_PARITY)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return parity_outbox(*dual_outbox(spark, folder), "offset")


def dual_outbox(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The outbox as one topic holds it and as it was fanned out; the other side writes the same payloads with other spacing."""
    events = derived.events(spark, folder)
    spaced = derived.emitted_outbox(events).withColumn("payload", F.replace("payload", F.lit(":"), F.lit(" :  ")))
    return derived.outbox(events).withColumn("offset", F.col("id")), spaced


_PARITY = """SELECT a.id, CAST(1 AS BIGINT) AS n_a, CAST(count(b.id) AS BIGINT) AS n_b,
            CASE WHEN count(b.id) = 0 THEN 'only_a' WHEN count(b.id) > 1 OR max(b.status) <> max(a.status) THEN 'changed'
                ELSE 'equal' END AS verdict FROM f_ord a LEFT JOIN f_emit b ON a.id = b.id GROUP BY a.id"""


@query("parity_hash", with_inputs("f_emit", select=_PARITY))
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = derived.orders(spark, folder)
    return parity_hash(orders, derived.emitted_orders(orders), "id", ["id", "customer_id", "amount", "status"])


@query("parity_digest", with_inputs("f_emit", select=f"SELECT * FROM ({_PARITY}) v WHERE verdict <> 'equal'"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The keys that differ, by digests of buckets."""
    orders = derived.orders(spark, folder)
    return parity_digest(orders, derived.emitted_orders(orders), "id", ["customer_id", "amount", "status"], buckets=256)


@query(
    "exactly_once",
    with_inputs(
        "f_emit",
        select="""SELECT a.id, CAST(count(b.id) AS BIGINT) AS emissions,
            CASE count(b.id) WHEN 0 THEN 'missing' WHEN 1 THEN 'once' ELSE 'duplicate' END AS verdict
            FROM f_ord a LEFT JOIN f_emit b ON a.id = b.id GROUP BY a.id""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = derived.orders(spark, folder)
    return exactly_once(orders, derived.emitted_orders(orders), "id")


@query(
    "order_violations",
    with_inputs(
        "f_emit_out",
        select="""SELECT destination, prev_off, off AS "offset", prev_id, id FROM (
                SELECT destination, off, id, lag(off) OVER w AS prev_off, lag(id) OVER w AS prev_id FROM f_emit_out
                WINDOW w AS (PARTITION BY destination ORDER BY off)) x WHERE id <= prev_id""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    emitted = derived.emitted_outbox(derived.events(spark, folder))
    found = order_violations(emitted, ["destination"], "offset", "id")
    return found.select("destination", F.col("prev_offset").alias("prev_off"), "offset", "prev_id", "id")


@query(
    "field_report",
    with_inputs(
        "f_raw",
        select="""SELECT destination AS topic, f.field, CAST(count(*) AS BIGINT) AS records,
            CAST(count(*) FILTER (destination NOT IN ('signup', 'error')) AS BIGINT) AS objects,
            CAST(count(*) FILTER (destination NOT IN ('signup', 'error') AND f.field <> 'created_at') AS BIGINT) AS present,
            CAST(count(*) FILTER (destination IN ('signup', 'error') OR f.field = 'created_at') AS BIGINT) AS absent
            FROM f_raw, (SELECT unnest(['id', 'destination', 'payload', 'created_at']) AS field) f GROUP BY 1, 2""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = derived.raw_texts(derived.events(spark, folder)).withColumnRenamed("destination", "topic")
    return field_report(raw, ["id", "destination", "payload", "created_at"])


@query(
    "null_report",
    f"""SELECT event_type AS topic, CAST(count(*) FILTER (ts < {MIDDLE}) AS BIGINT) AS absent,
        CAST(count(*) FILTER (ts >= {MIDDLE} AND event_type = 'error') AS BIGINT) AS explicit_null,
        CAST(count(*) FILTER (ts >= {MIDDLE} AND event_type <> 'error') AS BIGINT) AS with_value
        FROM events GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return null_report(derived.evolving_texts(derived.events(spark, folder)), "new_field")


def tagged_topics(spark: SparkSession, folder: str) -> DataFrame:
    """One topic per kind of job, all fed from the same tables: ``topic, value``."""
    orders = derived.orders(spark, folder)
    log = to_envelope(derived.order_changes(orders)).select("value")
    stream = tag_event(log, STREAM_PREFIX).select(F.lit(f"{STREAM_PREFIX}.datastream.orders").alias("topic"), "value")
    plain = log.select(F.lit(f"{STREAM_PREFIX}.declared.orders").alias("topic"), "value")
    link = enrich_json(log.withColumn("topic", F.lit("in")), "datastream-cdc", LINK_PREFIX, NOW).select("topic", "value")

    def flat(tag: str, topic: str, tail: DataFrame) -> DataFrame:
        rows = project_tagged(tail, orders.columns, tag)
        return to_upsert_record(rows, ["id"], rows.columns).select(F.lit(topic).alias("topic"), "value")

    table = flat("table-api", f"{STREAM_PREFIX}.table-api.orders", orders)
    # One part of the orders is written with the tag of the wrong job.
    wrong = F.col("status") == "P"
    sql = flat("sql-api", f"{STREAM_PREFIX}.sql-api.orders", orders.where(~wrong)).unionAll(
        flat("table-api", f"{STREAM_PREFIX}.sql-api.orders", orders.where(wrong))
    )
    return stream.unionAll(plain).unionAll(link).unionAll(table).unionAll(sql)


@query(
    "contract_report",
    with_inputs(
        "f_ord",
        select="""SELECT t.topic, CAST(count(*) AS BIGINT) AS records,
            CAST(count(*) FILTER (t.topic = 'shop.stream.sql-api.orders' AND status = 'P') AS BIGINT) AS violations
            FROM f_ord, (SELECT unnest(['shop.stream.datastream.orders', 'shop.stream.declared.orders',
                'shop.link.datastream.orders', 'shop.stream.table-api.orders', 'shop.stream.sql-api.orders']) AS topic) t
            GROUP BY 1""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    contracts = {
        f"{STREAM_PREFIX}.datastream.orders": STREAM_CONTRACT,
        f"{STREAM_PREFIX}.table-api.orders": TABLE_CONTRACT,
        f"{STREAM_PREFIX}.sql-api.orders": SQL_CONTRACT,
        f"{STREAM_PREFIX}.declared.orders": PLAIN_CONTRACT,
        f"{LINK_PREFIX}.orders": connector_contract("datastream-cdc"),
    }
    return contract_report(tagged_topics(spark, folder), contracts)


@query(
    "op_lifecycle",
    """SELECT id, pos, prev_op, op FROM (
            SELECT user_id AS id, event_id AS pos, op, lag(op) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_op
            FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op FROM events) e
        ) x WHERE CASE WHEN prev_op IN ('c', 'u') THEN op = 'c' ELSE op <> 'c' END""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle_violations(derived.claimed_ops(derived.events(spark, folder)), ["id"], "pos")


@query(
    "continuity",
    with_inputs(
        "f_emit_out",
        select="""WITH per_id AS (SELECT a.destination, time_bucket(INTERVAL 1 HOUR, a.created_at) AS bucket, a.id,
                count(b.id) AS n FROM f_out a LEFT JOIN f_emit_out b ON a.id = b.id GROUP BY ALL),
            buckets AS (SELECT destination, bucket, count(*) AS expected, count(*) FILTER (n = 0) AS missing,
                count(*) FILTER (n > 1) AS duplicate FROM per_id GROUP BY 1, 2),
            phased AS (SELECT *, lag(bucket) OVER (PARTITION BY destination ORDER BY bucket) AS before FROM buckets)
            SELECT destination, CASE WHEN expected >= 6 THEN 'burst'
                    WHEN before IS NOT NULL AND bucket > before + INTERVAL 1 HOUR THEN 'after_quiet' ELSE 'steady' END AS phase,
                CAST(sum(expected) AS BIGINT) AS expected, CAST(sum(missing) AS BIGINT) AS missing,
                CAST(sum(duplicate) AS BIGINT) AS duplicate FROM phased GROUP BY 1, 2""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    events = derived.events(spark, folder)
    return continuity(
        derived.outbox(events), derived.emitted_outbox(events), "id", "created_at", "destination", "1 hour", 6
    )


@query(
    "evolution_report",
    f"""SELECT CASE WHEN ts >= {MIDDLE} THEN 'after' ELSE 'before' END AS phase, CAST(count(*) AS BIGINT) AS records,
        CAST(count(*) FILTER (ts >= {MIDDLE}) AS BIGINT) AS with_field, CAST(0 AS BIGINT) AS violations
        FROM events GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = derived.evolving_texts(derived.events(spark, folder))
    return evolution_report(texts, "new_field", F.col("ts") >= F.lit(derived.SCHEMA_CHANGE).cast("timestamp_ntz"))


@query(
    "sink_completeness",
    with_inputs(
        "f_emit", "f_cust",
        select="""SELECT 'orders' AS sink, CAST(count(*) AS BIGINT) AS expected,
                CAST(count(*) FILTER (amount >= 3000) AS BIGINT) AS arrived,
                CAST(count(*) FILTER (amount < 3000) AS BIGINT) AS missing FROM f_ord
            UNION ALL SELECT 'customers', count(*), count(*), 0 FROM f_cust""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = derived.orders(spark, folder), derived.customers(spark, folder)
    return sink_completeness(
        {"orders": (orders, derived.emitted_orders(orders)), "customers": (customers, customers)}, "id"
    )


@query(
    "routing_report",
    with_inputs(
        "f_log",
        select="""SELECT 'poc.kc.outbox.' || COALESCE(after_status, 'unknown') AS topic, CAST(count(*) AS BIGINT) AS records,
            CAST(count(*) FILTER (after_status IS DISTINCT FROM COALESCE(before_status, after_status)) AS BIGINT) AS misrouted
            FROM f_log GROUP BY 1""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Measured against the state before each change: an update that moved a row counts as misrouted.
    changes = derived.account_changes(derived.events(spark, folder))
    routed = route_outbox(to_envelope(changes), field="status", now=NOW)
    before = routed.withColumn("destination", F.coalesce("before.status", "after.status"))
    return routing_report(before.select("topic", "destination"), "poc.kc.outbox")


@query(
    "malformed_report",
    with_inputs(
        "f_raw",
        select="""SELECT 'shop.raw.' || destination AS topic, time_bucket(INTERVAL 1 DAY, ts) AS bucket_start,
            CAST(count(*) AS BIGINT) AS malformed, min(pos) AS first_offset, max(pos) AS last_offset
            FROM f_raw WHERE destination IN ('signup', 'error') GROUP BY 1, 2""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = derived.raw_texts(derived.events(spark, folder))
    records = raw.select(topic_name("shop.raw", F.col("destination")).alias("topic"), "ts", F.col("pos").alias("offset"), "value")
    return malformed_report(records, "ts", "1 day")
