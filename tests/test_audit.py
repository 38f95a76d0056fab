from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators.audit import (
    PLAIN_CONTRACT,
    STREAM_CONTRACT,
    connector_contract,
    continuity,
    contract_report,
    evolution_report,
    exactly_once,
    field_report,
    lifecycle_violations,
    malformed,
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
from changeflow.sources import derived


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_exactly_once_finds_each_fault(spark):
    expected = table(spark, [(i,) for i in range(6)], "id BIGINT")
    emitted = table(spark, [(i,) for i in (0, 1, 1, 1, 3, 4, 5, 99)], "id BIGINT")
    got = {r.id: (r.emissions, r.verdict) for r in exactly_once(expected, emitted, "id").collect()}
    assert got == {0: (1, "once"), 1: (3, "duplicate"), 2: (0, "missing"), 3: (1, "once"), 4: (1, "once"),
                   5: (1, "once"), 99: (1, "unexpected")}


def test_exactly_once_counts_a_hot_id_before_the_shuffle(spark):
    expected = table(spark, [(i,) for i in range(100)], "id BIGINT")
    emitted = spark.range(30_000).select(F.when(F.col("id") < 10_000, 7).otherwise(F.col("id") - 10_000).alias("id"))
    report = exactly_once(expected, emitted, "id")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "HashAggregate" in plan and "SortAggregate" not in plan
    assert report.where("id = 7").first().emissions == 10_001


def test_parity_by_key(spark):
    schema = "id BIGINT, c INT, s STRING, off INT"
    a = table(spark, [(1, 1, "x", 0), (2, 2, None, 0), (3, 3, "y", 0), (4, 4, "z", 0), (4, 4, "old", -1)], schema)
    b = table(spark, [(1, 1, "x", 9), (2, 2, None, 9), (3, 7, "n", 9), (5, 5, "v", 9), (4, 4, "z", 9)], schema)
    got = {r.id: (r.verdict, r.differing) for r in parity(a, b, "id", ["c", "s"], "off").collect()}
    assert got == {1: ("equal", ""), 2: ("equal", ""), 3: ("changed", "c,s"), 4: ("equal", ""),
                   5: ("only_b", None)}


def test_parity_ignores_fields_left_out(spark):
    a = table(spark, [(1, "a", "12.34")], "id INT, s STRING, amount STRING")
    b = table(spark, [(1, "a", "BNI=")], "id INT, s STRING, amount STRING")
    assert parity(a, b, "id", ["s"]).first().verdict == "equal"
    assert parity(a, b, "id", ["s", "amount"]).first().differing == "amount"


def test_parity_outbox_compares_json_by_content(spark):
    schema = "id INT, destination STRING, payload STRING"
    a = table(spark, [(1, "x", '{"a":1,"b":2}'), (2, "x", '{"a":1}')], schema)
    b = table(spark, [(1, "x", '{ "b": 2, "a": 1 }'), (2, "x", '{"a":2}')], schema)
    assert {r.id: r.verdict for r in parity_outbox(a, b).collect()} == {1: "equal", 2: "changed"}


def test_parity_hash(spark):
    schema = "id INT, s STRING, t STRING"
    a = table(spark, [(1, "x", None), (2, None, "x"), (3, "x", "y"), (4, "x", "y"), (4, "x", "y"), (6, "p", "q"), (6, "r", "s")], schema)
    b = table(spark, [(1, "x", None), (2, "x", None), (4, "x", "y"), (5, "x", "y"), (6, "r", "s"), (6, "p", "q")], schema)
    got = {r.id: r.verdict for r in parity_hash(a, b, "id", ["s", "t"]).collect()}
    assert got == {1: "equal", 2: "changed", 3: "only_a", 4: "changed", 5: "only_b", 6: "equal"}


def test_order_violations(spark):
    rows = [("a", 1, 10), ("a", 2, 11), ("a", 3, 11), ("a", 5, 9), ("b", 1, 1), ("b", 9, 2)]
    for width in (1, 2, 100):
        found = order_violations(table(spark, rows, "p STRING, off INT, m INT"), ["p"], "off", "m", width).collect()
        assert sorted((r.p, r.off, r.prev_m, r.m) for r in found) == [("a", 3, 11, 11), ("a", 5, 11, 9)]


def test_lifecycle_violations(spark, small):
    legal = derived.account_changes(derived.events(spark, small)).select("id", "pos", "op")
    assert lifecycle_violations(legal, ["id"], "pos").count() == 0
    rows = [(1, 1, "u"), (1, 2, "c"), (2, 1, "r"), (2, 2, "c"), (2, 3, "d"), (2, 4, "d"), (3, 1, "c"), (3, 2, "d"), (3, 3, "c")]
    for width in (1, 100):
        found = lifecycle_violations(table(spark, rows, "id INT, pos INT, op STRING"), ["id"], "pos", width=width)
        assert sorted(tuple(r) for r in found.select("id", "pos").collect()) == [(1, 1), (1, 2), (2, 2), (2, 4)]


def test_field_and_null_reports(spark):
    texts = ['{"id":1,"s":null}', '{"id":2}', '{"id":3,"s":"x"}', '{"id":', "[1]"]
    frame = table(spark, [("t", t) for t in texts], "topic STRING, value STRING")
    got = {r.field: (r.records, r.objects, r.present, r.absent) for r in field_report(frame, ["id", "s"]).collect()}
    assert got == {"id": (5, 3, 3, 2), "s": (5, 3, 2, 3)}
    row = null_report(frame, "s").first()
    assert (row.absent, row.explicit_null, row.with_value) == (1, 1, 1)


def test_contract_report(spark):
    rows = [
        ("stream", {"variant": "datastream-cdc", "topic": "x"}),
        ("stream", {"variant": "other", "topic": "x"}),
        ("stream", {"variant": "datastream-cdc", "topic": "x", "job_variant": "y"}),
        ("plain", {"id": 1}),
        ("plain", {"variant": "v"}),
        ("link", {"variant": "l", "topic": "t", "transformed_at": 1}),
        ("link", {"variant": "l", "topic": "t"}),
        ("unlisted", {"id": 1}),
    ]
    frame = table(spark, [(t, json.dumps(v)) for t, v in rows] + [("plain", "broken"), ("plain", None)], "topic STRING, value STRING")
    contracts = {"stream": STREAM_CONTRACT, "plain": PLAIN_CONTRACT, "link": connector_contract("l")}
    got = {r.topic: (r.records, r.violations) for r in contract_report(frame, contracts).collect()}
    assert got == {"stream": (3, 2), "plain": (3, 2), "link": (2, 1)}


def test_evolution_report(spark):
    frame = table(spark, [(1, "{}"), (2, '{"f":null}'), (3, "{}"), (4, '{"f":1}')], "pos INT, value STRING")
    got = {r.phase: (r.records, r.with_field, r.violations) for r in evolution_report(frame, "f", F.col("pos") > 2).collect()}
    assert got == {"before": (2, 1, 1), "after": (2, 1, 1)}


def test_sink_completeness(spark):
    rows = table(spark, [(i,) for i in range(5)], "id INT")
    got = {r.sink: (r.expected, r.arrived, r.missing) for r in sink_completeness(
        {"a": (rows, rows.unionAll(rows)), "b": (rows, rows.where("id > 1"))}, "id").collect()}
    assert got == {"a": (5, 5, 0), "b": (5, 3, 2)}


def test_routing_report(spark):
    frame = table(spark, [("p.x", "x"), ("p.x", "y"), ("p.y", "y"), ("p.z", None)], "topic STRING, destination STRING")
    got = {r.topic: (r.records, r.misrouted) for r in routing_report(frame, "p").collect()}
    assert got == {"p.x": (2, 1), "p.y": (1, 0), "p.z": (1, 1)}


def test_malformed(spark):
    rows = [("t", "2024-01-01 00:10:00", 1, "{}"), ("t", "2024-01-01 00:20:00", 2, "}"), ("t", "2024-01-01 01:00:00", 3, "x"),
            ("t", "2024-01-01 00:30:00", 4, "[]"), ("t", "2024-01-01 00:30:00", 5, None)]
    frame = table(spark, rows, "topic STRING, ts STRING, offset INT, value STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert sorted(r.offset for r in malformed(frame).collect()) == [2, 3, 4]
    got = sorted((r.bucket_start.hour, r.malformed, r.first_offset, r.last_offset) for r in malformed_report(frame, "ts", "1 hour").collect())
    assert got == [(0, 2, 2, 4), (1, 1, 3, 3)]


@pytest.mark.parametrize("burst", [3, 100])
def test_continuity(spark, burst):
    times = ["00:00", "00:10", "00:20", "01:10", "03:00", "03:30"]
    rows = [(i, "s", f"2024-01-01 {t}:00") for i, t in enumerate(times)]
    expected = table(spark, rows, "id INT, s STRING, ts STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    emitted = table(spark, [(0,), (0,), (1,), (2,), (4,), (77,)], "id INT")
    got = {r.phase: (r.expected, r.missing, r.duplicate) for r in continuity(expected, emitted, "id", "ts", "s", "1 hour", burst).collect()}
    if burst == 3:
        assert got == {"burst": (3, 0, 1), "steady": (1, 1, 0), "after_quiet": (2, 1, 0)}
    else:
        assert got == {"steady": (4, 1, 1), "after_quiet": (2, 1, 0)}


@pytest.mark.parametrize("buckets, levels", [(1, 1), (4, 2), (64, 1), (16, 3)])
def test_digests_find_what_the_whole_comparison_finds(spark, buckets, levels):
    draw = random.Random(buckets)
    a = [(draw.randrange(300), draw.choice("xyz"), draw.choice([None, 1, 2])) for _ in range(400)]
    b = [r if draw.random() < 0.97 else (r[0], r[1], 9) for r in a if draw.random() < 0.98] + [(900, "x", 1), (None, "x", 1), a[0]]
    # A record under another key: digests without keys could not tell.
    b += [(5000, "same", 1)]
    a += [(6000, "same", 1), (None, "x", 1)]
    left, right = (spark.createDataFrame(rows, "id BIGINT, s STRING, n INT") for rows in (a, b))

    def found(frame):
        return sorted((tuple(r) for r in frame.collect()), key=str)

    whole = parity_hash(left, right, "id", ["s", "n"]).where("verdict <> 'equal'")
    assert found(parity_digest(left, right, "id", ["s", "n"], buckets, levels)) == found(whole)
    assert found(parity_digest(left, left, "id", ["s", "n"], buckets, levels)) == []
    assert found(parity_digest(left, left.limit(0), "id", ["s"], buckets, levels)) == found(parity_hash(left, left.limit(0), "id", ["s"]))


def test_equal_sides_move_no_rows(spark):
    rows = spark.range(20_000).selectExpr("id", "id % 7 AS n")
    frame = parity_digest(rows, rows.repartition(3), "id", ["n"], buckets=8)
    assert frame.collect() == []
    shuffled = [line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("_bucket_0" in line or "id" in line for line in shuffled)
