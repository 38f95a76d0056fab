"""Schema histories: versions by position, values with the columns of their time, and what does not fit."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changeflow.operators.history import SchemaHistory, observed_fields

@pytest.fixture
def history(spark):
    return SchemaHistory.of(
        (0, "id BIGINT, amount INT, note STRING"),
        (10, "id BIGINT, amount BIGINT, note STRING, added STRING"),
        (20, "id BIGINT, amount BIGINT, added STRING, price DECIMAL(10,2)"),
    )


def test_widest_and_versions(spark, history):
    assert history.widest.simpleString() == "struct<id:bigint,amount:bigint,note:string,added:string,price:decimal(10,2)>"
    got = spark.createDataFrame([(0,), (9,), (10,), (19,), (20,), (99,)], "pos BIGINT").select(history.number(F.col("pos"))).collect()
    assert [r[0] for r in got] == [0, 0, 1, 1, 2, 2]
    assert history.incompatible(spark).count() == 0


def test_a_value_has_the_columns_of_its_position(spark, history):
    texts = [(5, '{"id":1,"amount":2,"note":"n"}'), (15, '{"id":1,"amount":5000000000,"note":null,"added":"x"}'), (25, '{"id":1,"amount":3,"added":null,"price":1.50}')]
    frame = spark.createDataFrame(texts, "pos BIGINT, value STRING").withColumn("row", F.from_json("value", history.widest))
    got = [json.loads(r[0]) for r in frame.orderBy("pos").select(history.text(F.col("row"), F.col("pos"), tag=F.lit("t"))).collect()]
    assert got == [
        {"id": 1, "amount": 2, "note": "n", "tag": "t"},
        {"id": 1, "amount": 5000000000, "note": None, "added": "x", "tag": "t"},
        {"id": 1, "amount": 3, "added": None, "price": 1.5, "tag": "t"},
    ]


def test_changes_that_lose_values_are_reported(spark):
    history = SchemaHistory.of((0, "id BIGINT, a STRING, b DECIMAL(38,0), c DATE"), (7, "id INT, a INT, b DECIMAL(38,10), c TIMESTAMP_NTZ"), (9, "id BIGINT, a INT"))
    got = sorted(tuple(r) for r in history.incompatible(spark).collect())
    assert got == [(7, "a", "string", "int"), (7, "b", "decimal(38,0)", "decimal(38,10)"), (9, "a", "string", "int")]
    assert history.widest.simpleString() == "struct<id:bigint,a:string,b:decimal(38,0),c:timestamp_ntz>"
    with pytest.raises(ValueError, match="one for each position"):
        SchemaHistory.of((1, "id BIGINT"), (1, "id INT"))


def test_observed_fields(spark):
    texts = [
        (1, "t", '{"id":1,"a":"x","o":{"p":1}}'),
        (2, "t", '{"id":2,"a":null,"o":{"q":[1]}}'),
        (3, "t", '{"id":"3","new":true}'),
        (4, "u", "[1,2]"),
        (5, "u", "}"),
        (6, "u", None),
        (7, None, '{"id":5000000000}'),
    ]
    got = observed_fields(spark.createDataFrame(texts, "pos BIGINT, topic STRING, value STRING"), "topic", "pos").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [
            ("t", "id", "BIGINT", 1, 2, 2),
            ("t", "id", "STRING", 3, 3, 1),
            ("t", "a", "STRING", 1, 1, 1),
            ("t", "a", "VOID", 2, 2, 1),
            ("t", "o", "OBJECT", 1, 2, 2),
            ("t", "new", "BOOLEAN", 3, 3, 1),
            (None, "id", "BIGINT", 7, 7, 1),
        ],
        key=str,
    )
