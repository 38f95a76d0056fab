from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changeflow.functions.jsonvalue import json_map
from changeflow.operators.enrich import enrich_json, enrich_map, enrich_struct, project_tagged, tag_event
from changeflow.operators.route import (
    add_routing,
    destination_of,
    fan_out,
    route_by_table,
    route_outbox,
    route_outbox_single,
    table_of,
    topic_catalog,
)

NOW = 1_700_000_000_000


def texts(spark, rows):
    return spark.createDataFrame([(i, r, "in") for i, r in enumerate(rows)], "i INT, value STRING, topic STRING")


def rows(df):
    return df.orderBy("i").collect()


def test_tag_event_adds_two_fields(spark):
    sent = {"id": 1, "customer_id": 100, "amount": 50.00}
    (row,) = rows(tag_event(texts(spark, [json.dumps(sent)]), "p"))
    assert json.loads(row.value) == {**sent, "variant": "datastream-cdc", "topic": "p.datastream.orders"}


@pytest.mark.parametrize("text", ["{}", "{ }", " {\n} ", "{\t\r\n}"])
def test_tag_event_of_an_empty_object(spark, text):
    (row,) = rows(tag_event(texts(spark, [text]), "p"))
    assert json.loads(row.value) == {"variant": "datastream-cdc", "topic": "p.datastream.orders"}


@pytest.mark.parametrize(
    "text",
    ['{"id":1,"status":"incomplete"', "}", "", "plain", "[1,2]", "7", '"x"', "null", '{"a":1,"a":2}', '{"a":{"b":1,"b":2}}'],
)
def test_tag_event_leaves_other_text_alone(spark, text):
    (row,) = rows(tag_event(texts(spark, [text]), "p"))
    assert row.value == text


def test_tag_event_replaces_fields_of_that_name(spark):
    text = '{"topic":"old","variant":null,"x":{"topic":"inner"}}'
    (row,) = rows(tag_event(texts(spark, [text]), "p"))
    assert json.loads(row.value) == {
        "topic": "p.datastream.orders",
        "variant": "datastream-cdc",
        "x": {"topic": "inner"},
    }


@pytest.mark.parametrize("tail", [" trailing", " }", "}", ',{"b":2}', '],[{"b":2}', '] ,0', "//c"])
def test_tag_event_drops_what_follows_an_object(spark, tail):
    (row,) = rows(tag_event(texts(spark, ['{"a":1}' + tail]), "p"))
    assert json.loads(row.value) == {"a": 1, "variant": "datastream-cdc", "topic": "p.datastream.orders"}


def test_tag_event_keeps_the_text_of_values(spark):
    inside = '"amount":50.00,"note":"a \\"quote\\", \\u00e9 and }{","deep":{"b":[1,{"c":null}]},"big":' + "9" * 40
    (row,) = rows(tag_event(texts(spark, ["{" + inside + "}"]), "p"))
    assert inside in row.value
    assert json.loads(row.value)["note"] == 'a "quote", é and }{'


def test_tag_event_of_null(spark):
    (row,) = rows(tag_event(texts(spark, [None]), "p"))
    assert row.value is None


def test_project_tagged(spark):
    row = project_tagged(texts(spark, ["x"]), ["i"], "sql-api").first()
    assert row.asDict() == {"i": 0, "job_variant": "sql-api"}


@pytest.mark.parametrize("setting", [{"variant": " "}, {"prefix": ""}])
@pytest.mark.parametrize("enrich", [enrich_json, enrich_struct, enrich_map])
def test_blank_settings_are_rejected(spark, enrich, setting):
    with pytest.raises(ValueError, match="non-blank"):
        enrich(texts(spark, ["{}"]), **{"variant": "v", "prefix": "p", **setting})


def test_enrich_json(spark):
    cases = [
        ('{"before":null,"after":{"id":1,"name":"test"},"table":"orders"}', "p.orders"),
        ('{"source":{"table":"customers"},"table":"orders"}', "p.customers"),
        ('{"source":{"db":"x"},"table":"orders"}', "p.unknown"),
        ('{"source":{"table":null},"table":"orders"}', "p.unknown"),
        ('{"source":null,"table":"orders"}', "p.orders"),
        ('{"source":"text","table":"orders"}', "p.orders"),
        ('{"source":{"table":5}}', "p.5"),
        ("{}", "p.unknown"),
    ]
    for (text, topic), row in zip(cases, rows(enrich_json(texts(spark, [c[0] for c in cases]), "v", "p", NOW)), strict=True):
        assert row.topic == topic
        added = {"variant": "v", "topic": topic, "transformed_at": NOW}
        assert json.loads(row.value) == {**json.loads(text), **added}


def test_enrich_json_of_bad_text_and_tombstone(spark):
    bad, tombstone = rows(enrich_json(texts(spark, ['{"a":', None]), "v", "p", NOW))
    assert (bad.value, bad.topic) == ('{"a":', "p.unknown")
    assert (tombstone.value, tombstone.topic) == (None, "in")


def test_enrich_json_takes_the_time(spark):
    (row,) = rows(enrich_json(texts(spark, ["{}"]), "v", "p"))
    assert json.loads(row.value)["transformed_at"] > NOW


def as_map(spark, objects):
    return texts(spark, objects).withColumn("value", json_map(F.col("value")))


def test_enrich_map(spark):
    objects = ['{"id":1,"name":"test"}', '{"source":{"db":"x"},"table":"t"}', '{"source":{"table":"s"},"variant":"old"}', None]
    found = rows(enrich_map(as_map(spark, objects), "v", "p", NOW).withColumn("value", F.to_json("value")))
    assert [r.topic for r in found] == ["p.unknown", "p.t", "p.s", "in"]
    for text, row in zip(objects[:3], found, strict=False):
        assert json.loads(row.value) == {**json.loads(text), "variant": "v", "topic": row.topic, "transformed_at": NOW}
    assert found[3].value is None


def as_struct(spark, objects, schema):
    return texts(spark, objects).withColumn("value", F.from_json("value", schema))


def test_enrich_struct(spark):
    objects = ['{"id":1,"source":{"table":"orders"}}', '{"id":2,"source":{"table":null}}', '{"id":3}', None]
    found = rows(enrich_struct(as_struct(spark, objects, "id INT, source STRUCT<table: STRING>"), "v", "p", NOW))
    assert [r.topic for r in found] == ["p.orders", "p.unknown", "p.unknown", "in"]
    assert found[0].value.asDict() == {
        "id": 1, "source": found[0].value.source, "variant": "v", "topic": "p.orders", "transformed_at": NOW,
    }
    assert found[3].value is None


def test_enrich_struct_without_source(spark):
    enriched = enrich_struct(as_struct(spark, ['{"id":1}'], "id INT"), "v", "p", NOW)
    assert enriched.first().topic == "p.unknown"
    added = [f for f in enriched.schema["value"].dataType.fields if f.name in ("variant", "topic", "transformed_at")]
    assert len(added) == 3 and all(f.nullable for f in added)


def test_table_of_differs_by_kind(spark):
    text = '{"source":{"db":"x"},"table":"t"}'
    assert table_of(texts(spark, [text])).first().table == "unknown"
    assert table_of(as_map(spark, [text]), "map").first().table == "t"
    with pytest.raises(ValueError, match="kind"):
        table_of(texts(spark, [text]), "xml")


@pytest.mark.parametrize(
    ("text", "destination"),
    [
        ('{"after":{"id":1,"destination":"orders-svc","payload":"test"}}', "orders-svc"),
        ('{"after":{"id":1,"payload":"test"}}', "unknown"),
        ('{"after":null,"destination":"top"}', "unknown"),
        ('{"after":"text","destination":"top"}', "unknown"),
        ('{"after":{"destination":null}}', "unknown"),
        ('{"destination":"top"}', "top"),
        ('{"destination":{"a":1}}', '{"a":1}'),
        ("broken", "unknown"),
        (None, "unknown"),
    ],
)
def test_route_outbox_text(spark, text, destination):
    frame = texts(spark, [text]).withColumn("partition", F.lit(4))
    row = route_outbox(frame, now=NOW).first()
    topic = f"poc.kc.outbox.{destination}"
    assert row.topic == topic and "partition" not in row.asDict()
    if text is None or text == "broken":
        assert row.value == text
    else:
        added = {"_route_destination": destination, "_route_topic": topic, "_routed_at": NOW}
        assert json.loads(row.value) == {**json.loads(text), **added}


def test_destination_in_maps(spark):
    objects = ['{"after":null,"destination":"top"}', '{"after":{"destination":"in"}}', '{"after":{"x":1},"destination":"top"}', None]
    found = [r.destination for r in rows(destination_of(as_map(spark, objects), kind="map"))]
    assert found == ["top", "in", "unknown", "unknown"]


def test_destination_in_structs(spark):
    objects = ['{"after":{"destination":"in"},"destination":"top"}', '{"destination":"top"}', '{"after":{}}', None]
    wide = as_struct(spark, objects, "after STRUCT<destination: STRING>, destination STRING")
    assert [r.destination for r in rows(destination_of(wide, kind="struct"))] == ["in", "top", "unknown", "unknown"]
    narrow = as_struct(spark, objects, "after STRUCT<destination: STRING>")
    assert [r.destination for r in rows(destination_of(narrow, kind="struct"))] == ["in", "unknown", "unknown", "unknown"]
    flat = as_struct(spark, objects, "destination STRING")
    assert [r.destination for r in rows(destination_of(flat, kind="struct"))] == ["unknown"] * 4


def test_add_routing_to_maps_and_structs(spark):
    mapped = add_routing(as_map(spark, ['{"after":{"destination":"d"}}', None]), "p", now=NOW, kind="map")
    first, null = rows(mapped.withColumn("value", F.to_json("value")))
    assert json.loads(first.value)["_route_topic"] == "p.d" and (null.value, null.topic) == (None, "p.unknown")
    frame = as_struct(spark, ['{"after":{"destination":"d"}}', None], "after STRUCT<destination: STRING>")
    first, null = rows(add_routing(frame, "p", now=NOW, kind="struct"))
    assert first.value._routed_at == NOW and (null.value, null.topic) == (None, "p.unknown")


def test_another_destination_field(spark):
    assert route_outbox(texts(spark, ['{"after":{"to":"x"}}']), "p", "to", NOW).first().topic == "p.x"


def test_route_outbox_single(spark):
    text = '{"before":{"destination":"b"},"after":{"destination":"a"}}'
    row = route_outbox_single(texts(spark, [text]), "p").first()
    assert (row.topic, row.intended_topic, row.value) == ("p.outbox.outbox-events", "p.outbox.b", text)


def test_fan_out_names_deliveries(spark):
    frame = texts(spark, ['{"after":{"destination":"a"}}'] * 2)
    assert [r.delivery_id for r in rows(fan_out(frame, F.col("i"), "p", now=NOW))] == ["p.a#0", "p.a#1"]


def test_route_by_table(spark):
    frame = texts(spark, ['{"source":{"table":"a"}}', '{"table":"b"}', "?"])
    assert [r.topic for r in rows(route_by_table(frame, "p"))] == ["p.a", "p.b", "p.unknown"]


def test_topic_catalog(spark):
    frame = spark.createDataFrame([("a", 0), ("a", 0), ("a", 1), ("b", 5)], "topic STRING, partition INT")
    assert sorted(tuple(r) for r in topic_catalog(frame).collect()) == [("a", 3, 2), ("b", 1, 1)]


def test_fields_are_looked_up_only_in_texts_that_may_have_them(spark, capsys):
    sent = ['{"id":1}', '{"\\u0074opic":"old"}', r'{"a":"\\u"}', '{"a":"topic"}', r'{"a":"{\"k\": 1}"}', '{"topic":"old"}']
    tagged = tag_event(texts(spark, sent), "p")
    added = {"variant": "datastream-cdc", "topic": "p.datastream.orders"}
    assert [json.loads(r.value) for r in rows(tagged)] == [{**json.loads(t), **added} for t in sent]
    tagged.explain(True)
    assert "Contains(value" in capsys.readouterr().out
