"""Queries for envelopes, wire formats, projections and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.decimals import decode_decimal, encode_decimal
from changeflow.functions.jsonvalue import canonical_json, json_map, json_object
from changeflow.operators.enrich import enrich_json, enrich_map, enrich_struct, project_tagged, tag_event
from changeflow.operators.envelope import (
    extract_row,
    op_image,
    parse_envelope,
    parse_flat,
    to_envelope,
    to_upsert_record,
)
from changeflow.plans.expected import with_inputs
from changeflow.plans.registry import query
from changeflow.sources import derived
from changeflow.sources.tables import ORDERS, read_parquet_table

STREAM_PREFIX = "shop.stream"
LINK_PREFIX = "shop.link.datastream"
NOW = 1_717_200_000_000


@query(
    "parse_envelope",
    with_inputs(
        "f_log",
        select="""SELECT pos, op, 'shop' AS db, 'accounts' AS table_name, ts_ms,
            CASE WHEN before_status IS NOT NULL THEN id END AS before_id, before_amount, before_status,
            CASE WHEN after_status IS NOT NULL THEN id END AS after_id, after_amount, after_status FROM f_log""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = derived.account_envelopes(derived.events(spark, folder)).select("value")
    return parse_envelope(texts, derived.ACCOUNT_ROW).select(
        F.col("source")["pos"].alias("pos"),
        "op",
        F.col("source")["db"].alias("db"),
        F.col("source")["table"].alias("table_name"),
        "ts_ms",
        *[F.col(i)[f].alias(f"{i}_{f}") for i in ("before", "after") for f in ("id", "amount", "status")],
    )


@query(
    "to_envelope",
    with_inputs(
        "f_log",
        select="""SELECT pos, op, TRUE AS has_before, before_status IS NULL AS before_is_null,
            TRUE AS has_after, after_status IS NULL AS after_is_null, after_status FROM f_log""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    texts = to_envelope(derived.account_changes(derived.events(spark, folder))).select("pos", "value")
    fields = texts.withColumn("_f", json_map(F.col("value")))
    columns = [F.get_json_object("value", "$.op").alias("op")]
    for image in ("before", "after"):
        columns.append(F.map_contains_key("_f", image).alias(f"has_{image}"))
        columns.append(F.is_variant_null(F.try_element_at("_f", F.lit(image))).alias(f"{image}_is_null"))
    return fields.select("pos", *columns, F.get_json_object("value", "$.after.status").alias("after_status"))


@query(
    "op_image",
    with_inputs(
        "f_log",
        select="""SELECT pos, id, op, COALESCE(after_amount, before_amount) AS amount,
            COALESCE(after_status, before_status) AS status, TRUE AS images_fit_op FROM f_log""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    changes = derived.account_changes(derived.events(spark, folder)).drop("id")
    return op_image(changes, "id").select(
        "pos",
        F.col("key").alias("id"),
        "op",
        F.col("image")["amount"].alias("amount"),
        F.col("image")["status"].alias("status"),
        "images_fit_op",
    )


@query(
    "to_upsert_record",
    """SELECT event_id AS pos, user_id AS key_id, event_type = 'error' AS tombstone,
        CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(10,2)) END AS amount,
        CASE WHEN event_type <> 'error' THEN event_type END AS status FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    changes = derived.account_upserts(derived.events(spark, folder))
    records = to_upsert_record(changes, ["id"], ["id", "amount", "status"], F.col("op") == "d").select("pos", "key", "value")
    rows = parse_flat(parse_flat(records, "id BIGINT", "key", "k"), derived.ACCOUNT_ROW)
    return rows.select(
        "pos",
        F.col("k")["id"].alias("key_id"),
        F.col("value").isNull().alias("tombstone"),
        F.col("row")["amount"].alias("amount"),
        F.col("row")["status"].alias("status"),
    )


@query(
    "decode_decimal",
    """SELECT src, id, amount AS from_base64, amount AS from_string, amount AS from_number FROM (
        SELECT 'orders' AS src, o_orderkey AS id, CAST(o_totalprice AS DECIMAL(10,2)) AS amount FROM orders
        UNION ALL SELECT 'customers', c_custkey, CAST(c_acctbal AS DECIMAL(10,2)) FROM customer) a""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    amounts = derived.orders(spark, folder).select(F.lit("orders").alias("src"), "id", "amount")
    balances = read_parquet_table(spark, folder, "customer").select(
        F.lit("customers").alias("src"), F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("decimal(10,2)").alias("amount")
    )
    modes = ("base64", "string", "number")
    wired = amounts.unionAll(balances).select("src", "id", *[encode_decimal(F.col("amount"), m, 2).alias(m) for m in modes])
    return wired.select("src", "id", *[decode_decimal(F.col(m), m, 10, 2).alias(f"from_{m}") for m in modes])


@query(
    "extract_row",
    with_inputs(
        "f_ord",
        select="""SELECT 'envelope' AS shape, id AS ref, id, customer_id, status FROM f_ord
            UNION ALL SELECT 'flat', id, id, customer_id, status FROM f_ord
            UNION ALL SELECT 'flat', doc_id, NULL, NULL, NULL FROM documents
            UNION ALL SELECT 'envelope', doc_id, NULL, NULL, NULL FROM documents""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived.orders(spark, folder)
    enveloped = to_envelope(derived.order_changes(rows)).select(F.lit("envelope").alias("shape"), F.col("id").alias("ref"), "value")
    flat = to_upsert_record(rows, ["id"], rows.columns).select(F.lit("flat").alias("shape"), F.col("id").alias("ref"), "value")
    prose = read_parquet_table(spark, folder, "documents").select(
        F.explode(F.array(F.lit("flat"), F.lit("envelope"))).alias("shape"), F.col("doc_id").alias("ref"), F.col("text").alias("value")
    )
    found = extract_row(enveloped.unionAll(flat).unionAll(prose), "shape", "id BIGINT, customer_id BIGINT, status STRING")
    return found.select("shape", "ref", *[F.col("row")[f].alias(f) for f in ("id", "customer_id", "status")])


@query(
    "canonical_json",
    """SELECT event_id AS id, '{"event":' || replace(props, ' ', '') || ',"user":' || user_id || '}' AS canonical,
        TRUE AS equal_in_any_order FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    texts = derived.events(spark, folder).select(
        F.col("event_id").alias("id"),
        F.concat(F.lit('{"user": '), user, F.lit(', "event": '), "props", F.lit("}")).alias("a"),
        F.concat(F.lit('{"event":'), "props", F.lit(',"user":'), user, F.lit("}")).alias("b"),
    )
    return texts.withColumns({"a": canonical_json(F.col("a")), "b": canonical_json(F.col("b"))}).select(
        "id", F.col("a").alias("canonical"), (F.col("a") == F.col("b")).alias("equal_in_any_order")
    )


@query("roundtrip_strings", "SELECT doc_id AS id, md5(text) AS digest, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents")
def _(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_parquet_table(spark, folder, "documents")
    row = F.struct(F.col("doc_id").alias("id"), F.col("text").alias("status"))
    changes = documents.select(
        F.when(F.lit(False), row).alias("before"),
        row.alias("after"),
        F.lit("c").alias("op"),
        derived.source_struct(derived.DATABASE, "notes", F.lit(None), F.col("doc_id")).alias("source"),
        F.lit(None).cast("bigint").alias("ts_ms"),
    )
    back = parse_envelope(to_envelope(changes).select("value"), "id BIGINT, status STRING")
    text = F.col("after")["status"]
    return back.select(
        F.col("after")["id"].alias("id"), F.md5(text).alias("digest"), F.octet_length(text).cast("bigint").alias("n_bytes")
    )


@query("project_orders_table_api", with_inputs("f_ord", select="SELECT *, 'table-api' AS job_variant FROM f_ord"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return project_tagged(derived.orders(spark, folder), ORDERS.schema.names, "table-api")


@query("project_orders_sql_api", with_inputs("f_ord", select="SELECT *, 'sql-api' AS job_variant FROM f_ord"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        "SELECT id, customer_id, amount, status, created_at, 'sql-api' AS job_variant FROM {src}",
        src=derived.orders(spark, folder),
    )


@query("project_customers_sql_api", with_inputs("f_cust", select="SELECT *, 'sql-api' AS job_variant FROM f_cust"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        "SELECT id, name, email, 'sql-api' AS job_variant FROM {src}", src=derived.customers(spark, folder)
    )


DATABASE_ROWS = """SELECT 'orders' AS table_name, 'r' AS op, id FROM f_ord
    UNION ALL SELECT 'customers', 'r', id FROM f_cust UNION ALL SELECT 'outbox_events', 'c', id FROM f_out"""


@query(
    "tag_event",
    with_inputs(
        "f_ord", "f_cust", "f_out",
        select=f"""SELECT *, 'datastream-cdc' AS variant, 'shop.stream.datastream.orders' AS topic
            FROM ({DATABASE_ROWS}) a""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    tagged = tag_event(derived.database_log(spark, folder), STREAM_PREFIX)
    return tagged.select(
        F.from_json("value", "source STRUCT<table: STRING>, op STRING, after STRUCT<id: BIGINT>, variant STRING, topic STRING").alias("e")
    ).select(
        F.col("e.source.table").alias("table_name"), "e.op", F.col("e.after.id").alias("id"), "e.variant", "e.topic"
    )


@query(
    "tag_event_malformed",
    with_inputs(
        "f_raw",
        select="""SELECT 'event' AS src, pos AS ref, destination NOT IN ('signup', 'error') AS tagged,
                CASE WHEN destination IN ('signup', 'error') THEN md5(value) END AS kept FROM f_raw
            UNION ALL SELECT 'document', doc_id, FALSE, md5(text) FROM documents
            UNION ALL SELECT 'page', page_id, FALSE, md5(html) FROM pages""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    raw = derived.raw_texts(derived.events(spark, folder)).select(F.lit("event").alias("src"), F.col("pos").alias("ref"), "value")
    prose = read_parquet_table(spark, folder, "documents").select(F.lit("document"), "doc_id", "text")
    pages = read_parquet_table(spark, folder, "pages").select(F.lit("page"), "page_id", "html")
    tagged = tag_event(raw.unionAll(prose).unionAll(pages), STREAM_PREFIX)
    variant = F.col("value").isNotNull() & F.try_variant_get(F.try_parse_json("value"), "$.variant", "string").isNotNull()
    return tagged.withColumn("tagged", variant).select(
        "src", "ref", "tagged", F.when(~F.col("tagged"), F.md5("value")).alias("kept")
    )


def _raw_topic_records(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes of three tables, flat and broken texts, and tombstones, as topic records."""
    log = derived.database_log(spark, folder).select(F.lit("log").alias("src"), F.lit(None).cast("bigint").alias("ref"), "value")
    raw = derived.raw_texts(derived.events(spark, folder)).select(F.lit("raw").alias("src"), F.col("pos").alias("ref"), "value")
    return log.unionAll(raw).withColumn("topic", F.lit("shop.link.in"))


@query(
    "enrich_json",
    with_inputs(
        "f_ord", "f_cust", "f_out", "f_raw",
        select=f"""SELECT 'log' AS src, id, 'shop.link.datastream.' || table_name AS topic, 'datastream-cdc' AS variant,
                'shop.link.datastream.' || table_name AS topic_field, CAST({NOW} AS BIGINT) AS transformed_at
            FROM ({DATABASE_ROWS}) a
            UNION ALL SELECT 'raw', CASE WHEN destination IN ('signup', 'error') THEN NULL ELSE pos END,
                'shop.link.datastream.unknown',
                CASE WHEN destination NOT IN ('signup', 'error') THEN 'datastream-cdc' END,
                CASE WHEN destination NOT IN ('signup', 'error') THEN 'shop.link.datastream.unknown' END,
                CASE WHEN destination NOT IN ('signup', 'error') THEN CAST({NOW} AS BIGINT) END FROM f_raw""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    enriched = enrich_json(_raw_topic_records(spark, folder), "datastream-cdc", LINK_PREFIX, NOW)
    fields = "id BIGINT, after STRUCT<id: BIGINT>, variant STRING, topic STRING, transformed_at BIGINT"
    complete = F.when(json_object(F.col("value")).exists(), F.from_json("value", fields))
    return enriched.withColumn("e", complete).select(
        "src",
        F.coalesce("e.after.id", "e.id").alias("id"),
        "topic",
        "e.variant",
        F.col("e.topic").alias("topic_field"),
        "e.transformed_at",
    )


@query(
    "enrich_struct",
    with_inputs(
        "f_out",
        select=f"""SELECT id, destination, 'shop.link.datastream.outbox_events' AS topic, 'datastream-cdc' AS variant,
            'shop.link.datastream.outbox_events' AS topic_field, CAST({NOW} AS BIGINT) AS transformed_at FROM f_out""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    changes = derived.outbox_changes(derived.events(spark, folder))
    records = changes.select(
        F.lit("shop.link.in").alias("topic"), F.struct("before", "after", "op", "source", "ts_ms").alias("value")
    )
    enriched = enrich_struct(records, "datastream-cdc", LINK_PREFIX, NOW)
    return enriched.select(
        "value.after.id",
        "value.after.destination",
        "topic",
        "value.variant",
        F.col("value.topic").alias("topic_field"),
        "value.transformed_at",
    )


@query(
    "enrich_map",
    f"""SELECT event_id AS id, event_type AS table_name,
        CASE event_type WHEN 'view' THEN 'shop.link.datastream.view' WHEN 'click' THEN 'shop.link.datastream.clicks'
            ELSE 'shop.link.datastream.unknown' END AS topic,
        'datastream-cdc' AS variant, CAST({NOW} AS BIGINT) AS transformed_at FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Views name their table inside source, clicks at the top level next to an empty source, the others nowhere.
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(kind.alias("table")).alias("source"))))
        .when(
            kind == "click",
            F.to_json(
                F.struct(F.col("event_id").alias("id"), F.struct(F.lit("x").alias("db")).alias("source"), F.lit("clicks").alias("table"))
            ),
        )
        .otherwise(F.to_json(F.struct(F.col("event_id").alias("id"), F.lit("old").alias("variant"))))
    )
    records = derived.events(spark, folder).select(
        kind.alias("table_name"), F.lit("shop.link.in").alias("topic"), json_map(text).alias("value")
    )
    enriched = enrich_map(records, "datastream-cdc", LINK_PREFIX, NOW)
    value = {n: F.try_variant_get(F.col("value")[n], "$", t).alias(n) for n, t in
             {"id": "bigint", "variant": "string", "transformed_at": "bigint"}.items()}
    return enriched.select("table_name", "topic", *value.values())


@query(
    "enrich_tombstone",
    """SELECT event_id AS pos, event_type = 'error' AS tombstone,
        CASE WHEN event_type = 'error' THEN 'shop.link.in' ELSE 'shop.link.datastream.unknown' END AS topic
        FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    changes = derived.account_upserts(derived.events(spark, folder))
    records = to_upsert_record(changes, ["id"], ["id", "amount", "status"], F.col("op") == "d")
    enriched = enrich_json(records.withColumn("topic", F.lit("shop.link.in")), "datastream-cdc", LINK_PREFIX, NOW)
    return enriched.select("pos", F.col("value").isNull().alias("tombstone"), "topic")
