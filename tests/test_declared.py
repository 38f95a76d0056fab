from __future__ import annotations

import copy
import json

import pytest
from pyspark.sql import functions as F

from changeflow.plans.declared import check_spec, patterns, plan_pipeline, run_pipeline, with_paths
from changeflow.session import work_dir
from changeflow.streaming.sinks import FileTarget, read_topic, read_upsert

JOBS = patterns("shop", "s", "l")


def envelope(table, op, before, after):
    return json.dumps({"before": before, "after": after, "op": op, "source": {"db": "shop", "table": table}})


LOG = [
    envelope("orders", "c", None, {"id": 1, "customer_id": 7, "amount": 5.25, "status": "NEW"}),
    envelope("orders", "u", {"id": 1, "status": "NEW"}, {"id": 1, "customer_id": 7, "amount": 5.25, "status": "PAID", "new_field": "x"}),
    envelope("orders", "d", {"id": 1, "status": "PAID"}, None),
    envelope("customers", "c", None, {"id": 3, "name": "A", "email": "a@example.com"}),
    envelope("outbox_events", "c", None, {"id": 9, "destination": "pay", "payload": "{}"}),
]


@pytest.fixture(scope="module")
def log(spark):
    path = work_dir(spark, "declared-log")
    spark.createDataFrame([(t,) for t in LOG], "value STRING").write.parquet(path)
    return path


def planned(spark, log, name):
    return plan_pipeline(spark, with_paths(JOBS[name], log, "unused")).collect()


def test_there_are_ten_jobs():
    assert len(JOBS) == 10


@pytest.mark.parametrize("name", list(JOBS))
def test_each_job_plans(spark, log, name):
    assert planned(spark, log, name)


def test_table_job_keeps_keys_and_tombstones(spark, log):
    got = [(json.loads(r.key), json.loads(r.value) if r.value else None, r.topic) for r in planned(spark, log, "stream-table")]
    assert [k for k, _, _ in got] == [{"id": 1}] * 3 and {t for *_, t in got} == {"s.table-api.orders"}
    values = [v for _, v, _ in got]
    assert sorted(v["status"] for v in values if v) == ["NEW", "PAID"] and values.count(None) == 1
    assert all(v["job_variant"] == "table-api" for v in values if v)


def test_two_tables_go_to_two_topics(spark, log):
    assert sorted({r.topic for r in planned(spark, log, "stream-sql")}) == ["s.sql-api.customers", "s.sql-api.orders"]


def test_envelope_job_keeps_texts_and_new_columns(spark, log):
    values = [r.value for r in planned(spark, log, "stream-envelope")]
    assert sorted(values) == sorted(LOG[:3]) and any("new_field" in v for v in values)


def test_outbox_jobs(spark, log):
    (single,) = planned(spark, log, "stream-outbox")
    assert (single.topic, single.value) == ("s.outbox.outbox-events", LOG[4])
    (routed,) = planned(spark, log, "link-outbox")
    assert routed.topic == "l.outbox.pay" and json.loads(routed.value)["_route_destination"] == "pay"


def test_stream_writes_what_the_plan_says(spark, log):
    root = work_dir(spark, "declared-run")
    spec = with_paths(JOBS["link-multi"], log, f"{root}/out", f"{root}/cp", streaming=True)
    run_pipeline(spark, spec).awaitTermination()
    got = {r.topic: r["count"] for r in read_topic(spark, FileTarget(f"{root}/out")).groupBy("topic").count().collect()}
    assert got == {"l.datastream.orders": 3, "l.datastream.customers": 1, "l.datastream.outbox_events": 1}


def test_batch_run_writes_once(spark, log):
    root = work_dir(spark, "declared-batch")
    for _ in range(2):
        assert run_pipeline(spark, with_paths(JOBS["stream-multi"], log, f"{root}/out")) is None
    assert read_topic(spark, FileTarget(f"{root}/out")).count() == 5


@pytest.mark.parametrize("streaming", [False, True])
def test_upsert_topics_fold_to_the_live_rows(spark, streaming):
    def change(pos, table, op, before, after):
        source = {"db": "shop", "table": table, "pos": pos}
        return json.dumps({"before": before, "after": after, "op": op, "source": source})

    texts = [
        change(5, "orders", "d", {"id": 2}, None),
        change(4, "orders", "u", {"id": 1, "status": "NEW"}, {"id": 1, "status": "PAID"}),
        change(1, "orders", "c", None, {"id": 1, "status": "NEW"}),
        change(2, "orders", "c", None, {"id": 2, "status": "NEW"}),
        change(3, "customers", "c", None, {"id": 3, "email": "a@example.com"}),
        change(6, "customers", "u", {"id": 3}, {"id": 3, "email": "b@example.com"}),
    ]
    path, root = work_dir(spark, "upsert-log"), work_dir(spark, "upsert-fold")
    spark.createDataFrame([(t,) for t in texts], "value STRING").write.parquet(path)
    query = run_pipeline(spark, with_paths(JOBS["stream-sql"], path, f"{root}/out", f"{root}/cp", streaming))
    if streaming:
        query.processAllAvailable()
        query.stop()

    def live(table):
        return [json.loads(r.value) for r in read_upsert(spark, FileTarget(f"{root}/out"), f"s.sql-api.{table}").collect()]

    assert [(r["id"], r["status"]) for r in live("orders")] == [(1, "PAID")]
    assert [(r["id"], r["email"]) for r in live("customers")] == [(3, "b@example.com")]


def test_batch_jobs_share_a_target(spark, log):
    root = work_dir(spark, "declared-shared")
    for name in ("stream-multi", "stream-envelope", "stream-multi"):
        run_pipeline(spark, with_paths(JOBS[name], log, f"{root}/out"))
    records = read_topic(spark, FileTarget(f"{root}/out"))
    got = {r.topic: r["count"] for r in records.groupBy("topic").count().collect()}
    assert got == {"s.datastream.orders": 5, "s.yaml-pipeline.orders": 3}


def test_parallelism_limits_the_writers(spark, log):
    spec = with_paths(JOBS["stream-multi"], log, "unused")
    spec["pipeline"] = {**spec["pipeline"], "parallelism": 1}
    plan = plan_pipeline(spark, spec)
    assert plan.select(F.spark_partition_id()).distinct().count() == 1


@pytest.mark.parametrize(
    ("part", "key", "value"),
    [
        ("pipeline", "execution.checkpointing.interval", "30s"),
        ("pipeline", "schema.change.behavior", "ignore"),
        ("source", "type", "mysql"),
        ("source", "hostname", "h"),
        ("sink", "type", "files2"),
        ("transform", "type", "join"),
    ],
)
def test_bad_specs_are_rejected(part, key, value):
    spec = copy.deepcopy(with_paths(JOBS["stream-multi"], "x", "y"))
    check_spec(spec)
    spec[part][key] = value
    with pytest.raises(ValueError, match=".+"):
        check_spec(spec)


def test_missing_parts_are_rejected():
    with pytest.raises(ValueError, match="missing keys"):
        check_spec({"source": {"type": "changelog"}})
