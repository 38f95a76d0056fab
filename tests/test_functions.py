from __future__ import annotations

import json
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from changeflow.functions import (
    canonical_json,
    decode_decimal,
    encode_decimal,
    extract_text_field,
    split_topic,
    topic_for_table,
    topic_name,
)
from changeflow.functions.jsonvalue import json_object


def values(spark, rows, column):
    frame = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "i INT, v STRING")
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_extract_text_field_cases(spark):
    cases = {
        '{"destination":"payments"}': "payments",
        '{"other":"val"}': "unknown",
        '{"destination":"payments': "unknown",
        '{"destination":""}': "",
        r'{"destination":"pay\"ments"}': r"pay\"ments",
        '{"destination": "spaced"}': "unknown",
        '{"destination":7}': "unknown",
        '{"before":{"destination":"b"},"after":{"destination":"a"}}': "b",
        'text "destination":"loose" more': "loose",
        '{"destination":"two\nlines"}': "two\nlines",
        r'{"destination":"ends with backslash\\"}': r"ends with backslash\\",
        "": "unknown",
    }
    assert values(spark, cases, extract_text_field(F.col("v"), "destination")) == list(cases.values())
    assert values(spark, ['"f":"v"}'], extract_text_field(F.col("v"), "f")) == ["v"]
    # A name with a meaning in patterns is plain text.
    assert values(spark, ['{"a.b":"x","a+b":"y"}'], extract_text_field(F.col("v"), "a+b")) == ["y"]


def test_extract_text_field_of_long_text(spark):
    long = r"\"word " * 200_000
    found = values(spark, [f'{{"destination":"{long}"}}'], extract_text_field(F.col("v"), "destination"))
    assert found == [long]


@pytest.mark.parametrize(
    ("text", "precision", "scale", "expected"),
    [
        ("J2w=", 10, 2, "100.92"),
        ("/w==", 10, 2, "-0.01"),
        ("AP8=", 10, 2, "2.55"),
        ("AA==", 10, 2, "0.00"),
        ("AA==", 10, 0, "0"),
        ("!!", 10, 2, None),
        (None, 10, 2, None),
    ],
)
def test_decode_decimal_vectors(spark, text, precision, scale, expected):
    got = values(spark, [text], decode_decimal(F.col("v"), "base64", precision, scale))[0]
    assert got == (None if expected is None else Decimal(expected))


def test_decode_decimal_of_any_width(spark):
    import base64

    numbers = [0, 1, -1, 127, 128, -128, -129, 10**18, -(10**18), 10**37 + 7, -(10**37) - 7, 10**38 - 1, 1 - 10**38]
    texts = []
    for number in numbers:
        size = max(1, (number if number >= 0 else ~number).bit_length() // 8 + 1)
        texts.append(base64.b64encode(number.to_bytes(size, "big", signed=True)).decode())
    got = values(spark, texts, decode_decimal(F.col("v"), "base64", 38, 3))
    with localcontext() as exact:
        exact.prec = 50
        assert [int(g.scaleb(3)) for g in got] == numbers
    too_large = [base64.b64encode(b"\x7f" + b"\xff" * size).decode() for size in (15, 16)]
    assert values(spark, too_large, decode_decimal(F.col("v"), "base64", 38, 0)) == [None, None]


@pytest.mark.parametrize("mode", ["base64", "string", "number"])
def test_decimal_round_trip(spark, mode):
    amounts = [Decimal(n) for n in ("0.00", "0.01", "-0.01", "1.27", "1.28", "-1.28", "-1.29", "99999999.99", "-99999999.99")]
    frame = spark.createDataFrame([(a,) for a in amounts], "a DECIMAL(10,2)")
    wired = frame.select("a", encode_decimal(F.col("a"), mode, 2).alias("w"))
    for row in wired.select("a", decode_decimal(F.col("w"), mode, 10, 2).alias("b")).collect():
        assert row["a"] == row["b"]


def test_decimal_encoding_is_minimal(spark):
    frame = spark.createDataFrame([(Decimal("100.92"),), (Decimal("-0.01"),), (Decimal("2.55"),)], "a DECIMAL(10,2)")
    texts = [r[0] for r in frame.select(encode_decimal(F.col("a"), "base64", 2)).collect()]
    assert texts == ["J2w=", "/w==", "AP8="]


def test_unknown_decimal_mode():
    with pytest.raises(ValueError, match="decimal mode"):
        decode_decimal(F.lit("1"), "hex", 10, 2)


def test_canonical_json(spark):
    texts = ['{"b":1,"a":[1.50, {"d":null,"c":"x"}]}', '{ "a" : [1.5,{"c":"x","d":null}], "b":1.0 }', "nope"]
    first, second, broken = values(spark, texts, canonical_json(F.col("v")))
    assert first == second
    assert json.loads(first) == {"a": [1.5, {"c": "x", "d": None}], "b": 1}
    assert broken is None


def test_only_whole_objects_are_objects(spark):
    texts = ["{}", " \n{}", "[1]", "1", '"x"', "}", "{", '{"a":1,"a":2}', '{"a":{"b":1,"b":2}}', None, "prose"]
    found = values(spark, texts, json_object(F.col("v")).exists())
    assert found == [True, True] + [False] * 9


def test_field_names_that_break_a_path():
    with pytest.raises(ValueError, match="field name"):
        json_object(F.lit("{}")).text("it's")


def test_topics(spark):
    frame = spark.createDataFrame([("orders", None)], "t STRING, n STRING")
    row = frame.select(
        topic_for_table("p.q", F.col("t")).alias("a"), topic_name("p", F.col("n"), F.col("t")).alias("b")
    ).first()
    assert (row.a, row.b) == ("p.q.orders", "p.orders")
    parts = values(spark, ["a.b.c.d.e", "a.b.c", "a"], split_topic(F.col("v")))
    assert [tuple(p) for p in parts] == [("a", "b", "c", "d.e"), ("a", "b", "c", None), ("a", None, None, None)]
