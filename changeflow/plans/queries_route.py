"""Queries for field extraction, routing and topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.jsonvalue import JSON_MAP, extract_text_field, json_map
from changeflow.functions.topics import split_topic, topic_for_table, topic_name
from changeflow.operators.envelope import to_envelope
from changeflow.operators.route import (
    OUTBOX_PREFIX,
    add_routing,
    destination_of,
    fan_out,
    route_by_table,
    route_outbox,
    route_outbox_single,
    table_of,
    topic_catalog,
)
from changeflow.plans.expected import with_inputs
from changeflow.plans.queries_format import DATABASE_ROWS, LINK_PREFIX, NOW, STREAM_PREFIX
from changeflow.plans.registry import query
from changeflow.sources import derived


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return derived.raw_texts(derived.events(spark, folder))


def _outbox(spark: SparkSession, folder: str) -> DataFrame:
    return derived.outbox_envelopes(derived.events(spark, folder))


@query(
    "extract_text_field",
    with_inputs(
        "f_raw",
        select="""SELECT pos, CASE WHEN destination IN ('click', 'error') THEN 'unknown' ELSE destination END
                AS destination, 'unknown' AS missing FROM f_raw""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, folder).select(
        "pos",
        extract_text_field(F.col("value"), "destination").alias("destination"),
        extract_text_field(F.col("value"), "absent").alias("missing"),
    )


def _kinds(text: Column) -> dict[str, Column]:
    return {"json": text, "map": F.from_json(text, JSON_MAP.simpleString())}


@query(
    "table_of",
    with_inputs(
        "f_out",
        select="""SELECT id, CASE destination WHEN 'view' THEN 'view' WHEN 'purchase' THEN 'purchase_top' ELSE 'unknown' END
                AS from_json,
            CASE destination WHEN 'view' THEN 'view' WHEN 'purchase' THEN 'purchase_top' WHEN 'click' THEN 'click_top'
                ELSE 'unknown' END AS from_map,
            CASE WHEN destination = 'view' THEN 'view' ELSE 'unknown' END AS from_struct FROM f_out""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Views: table in source and at the top. Clicks: source without a table. Purchases: no source. Others: neither.
    kind = F.col("event_type")
    top = F.concat(kind, F.lit("_top"))
    text = (
        F.when(kind == "view", F.to_json(F.struct(F.struct(kind.alias("table")).alias("source"), top.alias("table"))))
        .when(kind == "click", F.to_json(F.struct(F.struct(F.lit("x").alias("db")).alias("source"), top.alias("table"))))
        .when(kind == "purchase", F.to_json(F.struct(top.alias("table"))))
        .otherwise(F.lit('{"source":null}'))
    )
    events = derived.events(spark, folder).select(F.col("event_id").alias("id"), text.alias("text"))
    struct = F.from_json("text", "source STRUCT<db: STRING, table: STRING>, table STRING")
    out = table_of(events.withColumn("value", F.col("text")), "json", "from_json")
    out = table_of(out.withColumn("value", json_map(F.col("text"))), "map", "from_map")
    out = table_of(out.withColumn("value", struct), "struct", "from_struct")
    return out.select("id", "from_json", "from_map", "from_struct")


@query(
    "topic_rename",
    with_inputs(
        "f_ord", "f_cust", "f_out",
        select=f"SELECT table_name, id, 'shop.link.datastream.' || table_name AS topic FROM ({DATABASE_ROWS}) a",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    log = table_of(derived.database_log(spark, folder), "json", "table_name")
    return log.select(
        "table_name",
        F.get_json_object("value", "$.after.id").cast("bigint").alias("id"),
        topic_for_table(LINK_PREFIX, F.col("table_name")).alias("topic"),
    )


@query(
    "destination_of",
    with_inputs(
        "f_out",
        select="""SELECT id, CASE WHEN destination IN ('view', 'purchase') THEN destination ELSE 'unknown' END AS from_json,
            CASE WHEN destination IN ('view', 'purchase', 'click') THEN destination ELSE 'unknown' END AS from_map,
            CASE WHEN destination IN ('view', 'purchase', 'click') THEN destination ELSE 'unknown' END AS from_struct
            FROM f_out""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Views: inside after. Purchases: at the top, no after. Clicks: at the top beside a null after. Others: null.
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.to_json(F.struct(F.struct(kind.alias("destination")).alias("after"))))
        .when(kind == "purchase", F.to_json(F.struct(kind.alias("destination"))))
        .when(kind == "click", F.concat(F.lit('{"after":null,"destination":"'), kind, F.lit('"}')))
        .otherwise(F.lit('{"after":{"destination":null}}'))
    )
    events = derived.events(spark, folder).select(F.col("event_id").alias("id"), text.alias("text"))
    struct = F.from_json("text", "after STRUCT<destination: STRING>, destination STRING")
    out = destination_of(events.withColumn("value", F.col("text")), into="from_json")
    out = destination_of(out.withColumn("value", json_map(F.col("text"))), kind="map", into="from_map")
    out = destination_of(out.withColumn("value", struct), kind="struct", into="from_struct")
    return out.select("id", "from_json", "from_map", "from_struct")


@query(
    "add_routing",
    with_inputs(
        "f_out", "f_raw",
        select=f"""SELECT 'envelope' AS src, id, 'poc.kc.outbox.' || destination AS topic,
                destination AS route_destination, 'poc.kc.outbox.' || destination AS route_topic,
                CAST({NOW} AS BIGINT) AS routed_at FROM f_out
            UNION ALL SELECT 'flat', CASE WHEN destination NOT IN ('signup', 'error') THEN pos END,
                'poc.kc.outbox.' || CASE WHEN destination IN ('signup', 'error') THEN 'unknown' ELSE destination END,
                CASE WHEN destination NOT IN ('signup', 'error') THEN destination END,
                CASE WHEN destination NOT IN ('signup', 'error') THEN 'poc.kc.outbox.' || destination END,
                CASE WHEN destination NOT IN ('signup', 'error') THEN CAST({NOW} AS BIGINT) END FROM f_raw""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    both = _outbox(spark, folder).select(F.lit("envelope").alias("src"), "value").unionAll(
        _raw(spark, folder).select(F.lit("flat").alias("src"), "value")
    )
    routed = add_routing(both, now=NOW)
    fields = (
        "id BIGINT, after STRUCT<id: BIGINT>, _route_destination STRING, _route_topic STRING, _routed_at BIGINT"
    )
    read = routed.withColumn("e", F.when(json_map(F.col("value")).isNotNull(), F.from_json("value", fields)))
    return read.select(
        "src",
        F.coalesce("e.after.id", "e.id").alias("id"),
        "topic",
        F.col("e._route_destination").alias("route_destination"),
        F.col("e._route_topic").alias("route_topic"),
        F.col("e._routed_at").alias("routed_at"),
    )


@query(
    "route_outbox",
    with_inputs(
        "f_log",
        select="""SELECT pos, id, op, 'poc.kc.outbox.' || COALESCE(after_status, 'unknown') AS topic FROM f_log""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Every op of a change log: deletes have a null after and go to the unknown destination.
    log = derived.account_envelopes(derived.events(spark, folder)).withColumn("partition", F.lit(3))
    routed = route_outbox(log, field="status", now=NOW)
    assert "partition" not in routed.columns
    return routed.select("pos", "id", F.get_json_object("value", "$.op").alias("op"), "topic")


@query(
    "route_outbox_single",
    with_inputs(
        "f_log",
        select="""SELECT pos, 'shop.stream.outbox.outbox-events' AS topic,
            'shop.stream.outbox.' || COALESCE(before_status, after_status) AS intended_topic, TRUE AS unchanged
            FROM f_log""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    changes = derived.account_changes(derived.events(spark, folder))

    def as_outbox(image: str) -> Column:
        renamed = F.struct(F.col(image)["id"].alias("id"), F.col(image)["status"].alias("destination"))
        return F.when(F.col(image).isNotNull(), renamed)

    texts = to_envelope(changes.withColumns({"before": as_outbox("before"), "after": as_outbox("after")}))
    routed = route_outbox_single(texts.withColumn("as_sent", F.col("value")), STREAM_PREFIX)
    return routed.select("pos", "topic", "intended_topic", (F.col("value") == F.col("as_sent")).alias("unchanged"))


@query(
    "fan_out",
    with_inputs(
        "f_out",
        select="""SELECT id, 'poc.kc.outbox.' || destination AS topic,
            'poc.kc.outbox.' || destination || '#' || id AS delivery_id FROM f_out""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fan_out(_outbox(spark, folder), F.col("id"), now=NOW).select("id", "topic", "delivery_id")


@query(
    "route_by_table",
    with_inputs(
        "f_ord", "f_cust", "f_out",
        select=f"SELECT 'shop.stream.datastream.' || table_name AS topic, id, op FROM ({DATABASE_ROWS}) a",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    routed = route_by_table(derived.database_log(spark, folder), f"{STREAM_PREFIX}.datastream")
    return routed.select(
        "topic",
        F.get_json_object("value", "$.after.id").cast("bigint").alias("id"),
        F.get_json_object("value", "$.op").alias("op"),
    )


@query(
    "split_topic",
    with_inputs(
        "f_out",
        select="""SELECT id, 'shop.kc.outbox.' || destination AS topic, 'shop' AS root, 'kc' AS engine,
            'outbox' AS variant, destination AS tail FROM f_out
            UNION ALL SELECT id, 'shop.link.' || destination, 'shop', 'link', destination, NULL FROM f_out""",
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived.outbox(derived.events(spark, folder))
    topics = F.array(topic_name("shop", "kc", "outbox", F.col("destination")), topic_name("shop", "link", F.col("destination")))
    named = rows.select("id", F.explode(topics).alias("topic"))
    return named.withColumn("t", split_topic(F.col("topic"))).select("id", "topic", "t.root", "t.engine", "t.variant", "t.tail")


@query(
    "topic_catalog",
    """SELECT 'poc.kc.outbox.' || event_type AS topic, CAST(count(*) AS BIGINT) AS messages,
        CAST(count(DISTINCT user_id) AS BIGINT) AS partitions FROM events GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    # Keyed topics as wide as they get: a partition per user.
    records = derived.events(spark, folder).select(
        topic_name(OUTBOX_PREFIX, F.col("event_type")).alias("topic"), F.col("user_id").alias("partition")
    )
    return topic_catalog(records)
