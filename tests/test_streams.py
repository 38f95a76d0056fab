from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeflow.operators.audit import exactly_once, lifecycle_violations, parity
from changeflow.operators.changelog import compact, current_state, dedup_events
from changeflow.operators.monitor import (
    AlertRule,
    alert,
    alert_transitions,
    counter_growth,
    job_health,
    silence,
)
from changeflow.operators.route import route_outbox
from changeflow.plans import queries_stream
from changeflow.session import work_dir
from changeflow.sources import derived
from changeflow.streaming import delivery
from changeflow.streaming.alerts import alert_live, alert_transitions_live
from changeflow.streaming.delivery import from_headers, newer_only, with_headers
from changeflow.streaming.live import (
    counter_growth_live,
    lifecycle_live,
    lifecycle_ordered,
    read_state,
    silence_live,
    write_state,
)
from changeflow.streaming.parity import parity_live
from changeflow.streaming.progress import ProgressMetrics
from changeflow.streaming.sinks import (
    FileTarget,
    Statement,
    StreamOptions,
    read_committed,
    read_topic,
    read_upsert,
    resume,
    run_statement_set,
    write_append,
    write_routed,
    write_upsert,
)

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def chunks(spark, small):
    """The events in five files, in the order of the log."""
    path = work_dir(spark, "chunks")
    events = derived.events(spark, small)
    # One write after the other: a stream takes files in the order of their age.
    for part in range(5):
        events.where(F.col("event_id").between(part * 200, part * 200 + 199)).coalesce(1).write.mode("append").parquet(path)
    assert len(spark.read.parquet(path).inputFiles()) == 5
    return path


def stream(spark, path, per_batch=1):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def unit(spark, name):
    root = work_dir(spark, name)
    return FileTarget(f"{root}/out"), StreamOptions("t", name, f"{root}/cp", interval=None)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_options_name_the_unit():
    options = StreamOptions("a", "b", "/x/")
    assert (options.query_name, options.checkpoint, options.interval) == ("a-b", "/x/a-b", "30 seconds")
    assert StreamOptions("a", "c", "/x").checkpoint != options.checkpoint
    with pytest.raises(ValueError, match="suffix"):
        StreamOptions("a", " ", "/x")


def test_append_in_many_batches_equals_the_batch(spark, small, chunks):
    target, options = unit(spark, "append")
    query = write_append(derived.outbox_envelopes(stream(spark, chunks)), "topic.a", target, options)
    query.awaitTermination()
    assert len(query.recentProgress) >= 5
    want = derived.outbox_envelopes(derived.events(spark, small))
    assert rows(read_topic(spark, target, "topic.a"), "value") == rows(want, "value")
    assert read_topic(spark, target, "topic.b").count() == 0


def test_jobs_share_a_target(spark, small, chunks):
    target, options = unit(spark, "shared")
    for name in ("one", "two"):
        own = StreamOptions("t", name, options.checkpoint_root, interval=None)
        write_append(derived.outbox_envelopes(stream(spark, chunks)), name, target, own).awaitTermination()
    want = derived.outbox_envelopes(derived.events(spark, small))
    for name in ("one", "two"):
        assert rows(read_topic(spark, target, name), "value") == rows(want, "value")


def test_a_job_without_commits_hides_no_other(spark, chunks):
    target, options = unit(spark, "entered")
    target.enter(spark, "t-later")
    with pytest.raises(ValueError, match="no job"):
        read_topic(spark, target)
    write_append(derived.outbox_envelopes(stream(spark, chunks, 5)), "one", target, options).awaitTermination()
    assert read_topic(spark, target).count() == 1000


def test_statement_sets_share_a_target(spark, chunks):
    target, options = unit(spark, "shared-sets")
    ids = Statement("a", lambda batch: batch.select(F.to_json(F.struct("event_id")).alias("value")))

    def breaks(batch):
        raise RuntimeError("sink is down")

    whole = StreamOptions("t", "whole", options.checkpoint_root, interval=None)
    run_statement_set(stream(spark, chunks), [ids], target, whole).awaitTermination()
    # Its first batch reaches one sink of two: the other job's commit of a batch of that number does not show it.
    half = StreamOptions("t", "half", options.checkpoint_root, interval=None)
    with pytest.raises(Exception, match="sink is down"):
        run_statement_set(stream(spark, chunks), [ids, Statement("b", breaks)], target, half).awaitTermination()
    assert read_committed(spark, target, "a").count() == 1000


def test_restart_emits_each_record_once(spark, small, chunks):
    target, options = unit(spark, "restart")
    log = derived.outbox_envelopes(stream(spark, chunks))
    first = write_append(log, "t", target, StreamOptions("t", "restart", options.checkpoint_root, "1 second"))
    while not first.recentProgress:
        first.awaitTermination(1)
    first.stop()
    partial = read_topic(spark, target, "t").count()
    assert 0 < partial <= 1000
    resume(lambda o: write_append(log, "t", target, o), options).awaitTermination()
    emitted = read_topic(spark, target, "t").select(F.get_json_object("value", "$.after.id").cast("bigint").alias("id"))
    expected = derived.outbox(derived.events(spark, small))
    assert {r.verdict for r in exactly_once(expected, emitted, "id").select("verdict").distinct().collect()} == {"once"}


def test_routed_topics(spark, small, chunks):
    target, options = unit(spark, "routed")
    write_routed(route_outbox(derived.outbox_envelopes(stream(spark, chunks)), now=1), target, options).awaitTermination()
    got = {r.topic: r["count"] for r in read_topic(spark, target).groupBy("topic").count().collect()}
    want = derived.events(spark, small).groupBy("event_type").count().collect()
    assert got == {f"poc.kc.outbox.{r.event_type}": r["count"] for r in want}


def test_hot_topic_is_written_by_several_tasks(spark, chunks):
    target, options = unit(spark, "salted")
    records = stream(spark, chunks, 5).select(F.lit("one").alias("topic"), F.to_json(F.struct("event_id")).alias("value"))
    # Partitions this small would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_routed(records, target, options, files_per_topic=4).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    written = read_topic(spark, target)
    assert written.count() == 1000 and len(written.inputFiles()) > 1


def test_upsert_and_live_state_equal_the_batch_fold(spark, small, chunks):
    changes = derived.account_upserts(stream(spark, chunks))
    columns, gone = ["id", "amount", "status"], F.col("op") == "d"
    target, options = unit(spark, "upsert")
    write_upsert(changes, ["id"], columns, "pos", gone, "u", target, options).awaitTermination()
    state, state_options = unit(spark, "state")
    write_state(changes, ["id"], columns, "pos", gone, "s", state, state_options).awaitTermination()
    log = derived.account_upserts(derived.events(spark, small))
    want = {r.id: str(r.amount) for r in current_state(log, ["id"], "pos").collect()}

    def read(df):
        return {json.loads(r.value)["id"]: f"{json.loads(r.value)['amount']:.2f}" for r in df.collect()}

    assert read(read_upsert(spark, target, "u")) == want
    assert read(read_state(spark, state, "s")) == want
    # Each key is held once, deleted ones as tombstones, whatever the number of changes.
    held = state.state_of(state_options.query_name, "s").records(spark)
    assert held.count() == log.select("id").distinct().count() < log.count()


def test_late_update_does_not_bring_a_row_back(spark):
    log = work_dir(spark, "late")
    target, options = unit(spark, "late-state")
    schema = "id BIGINT, pos BIGINT, op STRING, amount INT"
    for batch in ([(1, 1, "c", 5), (1, 3, "d", None)], [(1, 2, "u", 9), (2, 4, "c", 1)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(log)
        changes = spark.readStream.schema(schema).parquet(log)
        write_state(changes, ["id"], ["id", "amount"], "pos", F.col("op") == "d", "s", target, options).awaitTermination()
    assert [json.loads(r.value) for r in read_state(spark, target, "s").collect()] == [{"id": 2, "amount": 1}]


def test_statement_set_shows_a_batch_in_all_sinks_or_none(spark, chunks):
    target, options = unit(spark, "set")
    fail = {"on": True}

    def all_ids(batch):
        return batch.select(F.to_json(F.struct("event_id")).alias("value"))

    def breaks_once(batch):
        if fail["on"]:
            raise RuntimeError("sink is down")
        return all_ids(batch)

    statements = [Statement("a", all_ids), Statement("b", breaks_once)]
    query = run_statement_set(stream(spark, chunks), statements, target, options)
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination()
    assert spark.read.parquet(f"{target.path}/topics/topic=a").count() > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_committed(spark, target, "a").count()
    fail["on"] = False
    run_statement_set(stream(spark, chunks), statements, target, options).awaitTermination()
    for topic in ("a", "b"):
        records = read_committed(spark, target, topic)
        assert records.count() == 1000 and records.distinct().count() == 1000


def test_statement_set_over_a_fold(spark, chunks):
    target, options = unit(spark, "set-fold")
    latest = compact(derived.account_upserts(stream(spark, chunks)).select("id", "pos", "op"), ["id"], "pos")
    whole = Statement("all", lambda batch: batch.select(F.to_json(F.struct("id", "pos")).alias("value")))
    gone = Statement("gone", lambda batch: batch.where("op = 'd'").select(F.to_json(F.struct("id")).alias("value")))
    run_statement_set(latest, [whole, gone], target, options, output_mode="update").awaitTermination()
    assert read_committed(spark, target, "all").count() > read_committed(spark, target, "gone").count() > 0


def test_dedup_on_a_stream(spark, chunks):
    with pytest.raises(ValueError, match="delay"):
        dedup_events(stream(spark, chunks), ["event_id"])
    target, options = unit(spark, "dedup")
    twice = stream(spark, chunks).select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.explode(F.array(F.lit(1), F.lit(2))))
    records = dedup_events(twice, ["event_id"], "ts", "1 hour").select(F.lit("d").alias("topic"), F.to_json(F.struct("event_id")).alias("value"))
    write_routed(records, target, options).awaitTermination()
    assert read_topic(spark, target).count() == 1000


def live(spark, df, name):
    target, options = unit(spark, name)
    write_append(df.select(F.to_json(F.struct("*")).alias("value")), name, target, options).awaitTermination()
    return [json.loads(r.value) for r in read_topic(spark, target, name).collect()]


def test_lifecycle_over_batches(spark, small, chunks):
    got = live(spark, lifecycle_live(derived.claimed_ops(stream(spark, chunks)), "id"), "lifecycle")
    want = lifecycle_violations(derived.claimed_ops(derived.events(spark, small)), ["id"], "pos").collect()
    assert sorted((g["id"], g["pos"], g.get("prev_op"), g["op"]) for g in got) == sorted(
        ((r.id, r.pos, r.prev_op, r.op) for r in want)
    )
    assert not any(g["late"] for g in got)
    with pytest.raises(ValueError, match="takes a stream"):
        lifecycle_live(derived.claimed_ops(derived.events(spark, small)), "id")


def ops_stream(spark, name, batches):
    """Files of (id, pos, op) at a second each position, read one file per batch in the order they were written."""
    path, schema = work_dir(spark, name), "id BIGINT, pos BIGINT, op STRING, ts TIMESTAMP"
    for batch in batches:
        data = [(i, p, op, START + timedelta(seconds=p)) for i, p, op in batch]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


BEAT = (None, 1_000_000, None)


def found(rows):
    return sorted((g["id"], g["pos"], g.get("prev_op"), g["op"], g["late"]) for g in rows)


def test_a_late_change_does_not_shift_the_order(spark):
    # The delete at 2 comes after the update at 3: what follows 3 is judged by 3.
    flow = ops_stream(spark, "late-ops", [[(1, 1, "c"), (1, 3, "u")], [(1, 2, "d"), (1, 4, "u")], [(1, 5, "c")]])
    assert found(live(spark, lifecycle_live(flow, "id"), "late-ops")) == [(1, 2, "u", "d", True), (1, 5, "u", "c", False)]


def test_lifecycle_in_order_whatever_the_batches(spark):
    batches = [
        [(1, 4, "d"), (2, 2, "u"), (1, 1, "c")],
        [(1, 3, "c"), (1, 2, "u"), (2, 1, "c")],
        [(1, 9, "u"), (2, 8, "c"), (3, 7, "u")],
        [(1, 6, "c"), (2, 5, "d")],
        [BEAT],
    ]
    got = found(live(spark, lifecycle_ordered(ops_stream(spark, "ordered", batches), "id", "ts", "1 minute"), "ordered"))
    assert got == [(1, 3, "u", "c", False), (3, 7, None, "u", False)]
    with pytest.raises(ValueError, match="takes a stream"):
        lifecycle_ordered(spark.range(1).selectExpr("id", "1 AS pos", "'c' AS op", "now() AS ts"), "id", "ts", "1 minute")


def test_lifecycle_drops_what_comes_after_the_watermark(spark):
    # The first two batches move the watermark past position 1, so its delete is gone and the update at 300 fits.
    batches = [[(1, 0, "c"), (1, 200, "u")], [(2, 400, "c")], [(1, 1, "d"), (1, 300, "u"), (3, 500, "d")], [BEAT]]
    got = found(live(spark, lifecycle_ordered(ops_stream(spark, "dropped", batches), "id", "ts", "10 seconds"), "dropped"))
    assert got == [(3, 500, None, "d", False)]


def python_state(spark, df, name):
    """Run a stream to its end; what its states in Python report after each batch."""
    target, options = unit(spark, name)
    query = write_append(df.select(F.to_json(F.struct("*")).alias("value")), name, target, options)
    query.awaitTermination()
    states = [s for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"].startswith("transformWithState")]
    assert states
    return states


def test_changes_that_wait_are_no_state_of_their_key(spark):
    changes = [(k % 2, k, "u") for k in range(0, 60)]
    flow = ops_stream(spark, "waiting-ops", [changes[40:], changes[:40], [BEAT]])
    states = python_state(spark, lifecycle_ordered(flow, "id", "ts", "1 minute"), "waiting-ops")
    assert max(s["numRowsTotal"] for s in states) == 2


def test_a_topic_without_records(spark):
    flow = ops_stream(spark, "legal", [[(1, 1, "c"), (1, 2, "u")], [BEAT]])
    with pytest.raises(ValueError, match="no job has committed"):
        live(spark, lifecycle_ordered(flow, "id", "ts", "1 minute"), "legal")


def test_counter_segments_join_across_bins_and_batches(spark):
    big = 2**53
    batches = [
        [("a", 0.5, big + 3), ("a", 0.1, big + 1), ("b", 0.2, 5)],
        [("a", 2.2, 4), ("a", 0.3, big + 2), ("a", 1.9, 1)],
        [("a", 2.1, 9), ("b", 2.5, 5), ("a", 2.3, 4)],
        [(None, 500, None)],
    ]
    flow, whole = minute_stream(spark, "segments", batches)
    got = live(spark, counter_growth_live(flow.withColumnRenamed("job", "job_name"), "v", delay="5 minutes"), "segments")
    want = counter_growth(whole.where("v IS NOT NULL").withColumnRenamed("job", "job_name"), "v").collect()
    assert sorted((g["job_name"], g["minute"][11:16], g["growth"]) for g in got) == sorted(
        (r.job_name, f"{r.minute:%H:%M}", r.growth) for r in want
    )
    assert ("a", "00:00", 2) in {(g["job_name"], g["minute"][11:16], g["growth"]) for g in got}


def test_minutes_of_a_job_share_a_timer(spark):
    batches = [[("a", m, m * m) for m in range(60)], [(None, 500, None)]]
    flow, _ = minute_stream(spark, "timers", batches)
    states = python_state(spark, counter_growth_live(flow.withColumnRenamed("job", "job_name"), "v"), "timers")
    assert sum(s["customMetrics"]["numRegisteredTimers"] for s in states) <= len(batches)


def minute_stream(spark, name, batches):
    """Files of (job, minute, value), read one file per batch in the order they were written."""
    path = work_dir(spark, name)
    schema = "job STRING, ts TIMESTAMP, v BIGINT"
    for i, batch in enumerate(batches):
        data = [(j, START + timedelta(minutes=m), v) for j, m, v in batch]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{path}/part={i}")
    reader = spark.readStream.schema(schema + ", part INT").option("maxFilesPerTrigger", 1)
    return reader.parquet(path), spark.read.parquet(path)


def test_silence_over_batches(spark):
    # Job b stops after the second minute; a goes on, so time does.
    batches = [[("a", 0, 0), ("b", 0, 0), ("b", 1, 0)], [("a", 3, 0)], [("a", 4, 0)], [("a", 9, 0)], [("a", 20, 0), ("b", 20, 0)], [("a", 40, 0)]]
    flow, whole = minute_stream(spark, "silence", batches)
    got = live(spark, silence_live(flow, "job", "ts"), "silence")
    ended = sorted((g["job_name"], g["silent_from"][11:16], g["silent_until"][11:16]) for g in got if "silent_until" in g)
    want = sorted((r.job_name, f"{r.silent_from:%H:%M}", f"{r.silent_until:%H:%M}") for r in silence(whole, "job").collect())
    # The last minute is still open: no watermark has passed it.
    assert ended == [w for w in want if w[2] != "00:40"]
    assert {(g["job_name"], g["silent_from"][11:16]) for g in got if "silent_until" not in g} >= {("b", "00:02")}


def test_counter_growth_over_batches(spark):
    batches = [[("a", 0.1, 5), ("a", 0.6, 7)], [("a", 1.0, 7), ("a", 1.5, 2), ("a", 1.6, 3)], [("a", 4.0, 1)], [("a", 4.5, 6), ("a", 9, 6)], [("a", 30, 6)]]
    flow, whole = minute_stream(spark, "growth", batches)
    got = live(spark, counter_growth_live(flow.withColumnRenamed("job", "job_name"), "v"), "growth")
    want = counter_growth(whole.withColumnRenamed("job", "job_name"), "v").collect()
    assert sorted((g["minute"][11:16], g["growth"]) for g in got) == sorted(
        (f"{r.minute:%H:%M}", r.growth) for r in want if r.minute < START + timedelta(minutes=29)
    )


GAUGE = AlertRule("gauge", "v", None, 10, 2, "warning")
COUNTER = AlertRule("counter", "v", "5 minutes", 3, 1, "critical")


def alert_batches(seed):
    """Minutes of two jobs with gaps and breaches, out of order over batches, and a heartbeat."""
    draw, rows, count = random.Random(seed), [], {"a": 0, "b": 0}
    for minute in range(60):
        for job in count:
            if draw.random() < (0.85 if minute % 20 < 15 else 0.1):
                for part in (0.2, 0.7):
                    count[job] = 0 if draw.random() < 0.03 else count[job] + draw.choice([0, 0, 0, 1, 4])
                    rows.append((job, minute + part, count[job] if draw.random() < 0.7 else count[job] + 1))
    stretches = [rows[k : k + 25] for k in range(0, len(rows), 25)]
    for k in range(0, len(stretches) - 1, 2):
        stretches[k], stretches[k + 1] = stretches[k + 1], stretches[k]
    return [*stretches, [(None, 500, None)]]


@pytest.mark.parametrize("rule", [GAUGE, COUNTER], ids=["gauge", "counter"])
def test_alerts_over_batches(spark, rule):
    flow, whole = minute_stream(spark, f"alerts-{rule.name}", alert_batches(8))
    flow, whole = flow.withColumnRenamed("job", "job_name"), whole.where("job IS NOT NULL").withColumnRenamed("job", "job_name")
    states = alert(whole, rule)

    def cells(rows):
        return sorted((str(r[0]), str(r[1])[:16].replace("T", " "), r[2], r[3]) for r in rows)

    got = live(spark, alert_live(flow, rule, delay="60 minutes"), f"alerts-{rule.name}")
    assert cells((g["job_name"], g["minute"], g.get("value"), g["state"]) for g in got) == cells(states.collect())
    assert {g["state"] for g in got} == {"ok", "pending", "firing"}
    got = live(spark, alert_transitions_live(flow, rule, delay="60 minutes"), f"changes-{rule.name}")
    want = cells(alert_transitions(states).collect())
    found = cells((g["job_name"], g["minute"], g["from_state"], g["to_state"]) for g in got)
    # The batch form does not know that time went on after the last minute; the stream does.
    assert set(want) <= set(found) and all(to == "ok" for *_, to in set(found) - set(want)) and len(found) - len(want) <= 2


def test_alerts_of_a_job_share_a_timer(spark):
    batches = [[("a", m, m % 7) for m in range(60)], [(None, 500, None)]]
    flow, _ = minute_stream(spark, "alert-timers", batches)
    states = python_state(spark, alert_live(flow.withColumnsRenamed({"job": "job_name", "v": GAUGE.metric}), GAUGE), "alert-timers")
    assert sum(s["customMetrics"]["numRegisteredTimers"] for s in states) <= 2 * len(batches)


def test_alerts_take_streams(spark):
    with pytest.raises(ValueError, match="take a stream"):
        alert_live(spark.range(1), GAUGE)


def test_parity_of_two_streams(spark):
    schema, sides = "id BIGINT, v STRING, ts TIMESTAMP", []

    def side(name, batches):
        path = work_dir(spark, name)
        for batch in batches:
            rows = [(i, v, START + timedelta(seconds=s)) for i, v, s in batch]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        sides.append(spark.read.parquet(path).where("id IS NOT NULL"))
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    beat = [(None, None, 100_000)]
    a = side("side-a", [[(2, "x", 20), (3, "y", 30)], [(1, "w", 10), (4, None, 40)], [(6, "u", 60)], beat])
    b = side("side-b", [[(1, "w", 11), (1, "w", 11)], [(3, "other", 31), (4, None, 41)], [(5, "z", 50)], beat])
    got = live(spark, parity_live(a, b, "id", ["v"], "ts", "10 minutes"), "parity")
    want = parity(sides[0], sides[1].dropDuplicates(["id"]), "id", ["v"]).collect()
    assert sorted((g["id"], g["verdict"], g.get("differing")) for g in got) == sorted((r.id, r.verdict, r.differing) for r in want)
    assert {r.verdict for r in want} == {"equal", "changed", "only_a", "only_b"}
    with pytest.raises(ValueError, match="takes streams"):
        parity_live(*sides, "id", ["v"], "ts", "1 minute")


def test_shuffled_and_repeated_delivery_folds_to_the_state(spark):
    draw = random.Random(6)
    log = [(f"k{draw.randrange(8)}", p, None if draw.random() < 0.2 else f"v{p}") for p in range(60)]
    sent = with_headers(spark.createDataFrame(log, "key STRING, offset BIGINT, value STRING"), table=F.lit("shop.t"))
    wire = [tuple(r) for r in sent.select("key", "value", "headers").collect()]
    delivered = wire + draw.sample(wire, 30)
    draw.shuffle(delivered)
    path, schema = work_dir(spark, "wire"), "key STRING, value STRING, headers array<struct<key: string, value: binary>>"
    for k in range(0, 90, 18):
        spark.createDataFrame(delivered[k : k + 18], schema).coalesce(1).write.mode("append").parquet(path)
    read = from_headers(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))
    assert {r[0] for r in from_headers(spark.read.parquet(path)).select("source_table").collect()} == {"shop.t"}
    got = live(spark, newer_only(read), "newer")
    # What a consumer applies one after the other: positions of a key rise, and the last one is the state.
    applied = {}
    for g in got:
        applied.setdefault(g["key"], []).append((g["position"], g.get("value")))
    want = {key: (pos, value) for key, pos, value in log}
    assert {key: max(rows) for key, rows in applied.items()} == want
    assert all(len({p for p, _ in rows}) == len(rows) for rows in applied.values()) and len(got) < 60
    bare = spark.createDataFrame([("k", "v", None), ("k", "v", []), ("k", "v", [("position", b"x")])], schema)
    assert [r.position for r in from_headers(bare).collect()] == [None, None, None]
    with pytest.raises(ValueError, match="takes a stream"):
        newer_only(from_headers(bare))


def test_a_query_that_fails_for_good_leaves_a_sample(spark, chunks):
    metrics = ProgressMetrics()
    spark.streams.addListener(metrics)
    try:
        target, options = unit(spark, "broken")
        broken = stream(spark, chunks).select(F.expr("CAST(raise_error('lost') AS STRING)").alias("value"))
        with pytest.raises(Exception, match="lost"):
            write_append(broken, "t", target, options).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(metrics)
    rows = metrics.drain(spark).where("job_name = 't-broken'").collect()
    assert [(r.num_failed_checkpoints, r.num_completed_checkpoints) for r in rows] == [(1, 0)]


def test_progress_becomes_samples(spark, chunks):
    metrics = ProgressMetrics()
    spark.streams.addListener(metrics)
    try:
        target, options = unit(spark, "progress")
        write_append(derived.outbox_envelopes(stream(spark, chunks)), "t", target, options).awaitTermination()
        write_append(derived.outbox_envelopes(stream(spark, chunks)), "t", target, options).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(metrics)
    samples = metrics.drain(spark).where("job_name = 't-progress'")
    row = job_health(samples).first()
    assert row.completed >= 5 and samples.agg(F.max("last_checkpoint_duration")).first()[0] > 0
    assert metrics.drain(spark).count() == 0


def test_batches_do_not_grow_with_the_files_of_a_log(spark, small):
    # Every batch goes over the state that waits for the watermark.
    def batches(log):
        seen = []
        log.writeStream.trigger(availableNow=True).option("checkpointLocation", work_dir(spark, "count")).foreachBatch(
            lambda rows, at: seen.append(rows.count())
        ).start().awaitTermination()
        return [n for n in seen if n]

    rows = spark.range(400).selectExpr("id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts").repartition(9)
    late, _ = queries_stream._late_parts(spark, rows, "id", "ts")
    found = batches(late)
    assert sum(found) == 401 and 4 <= len(found) <= 5
    path, files = queries_stream.changing_orders(spark, small)
    found = batches(spark.readStream.schema("value STRING").option("maxFilesPerTrigger", files).parquet(path))
    tables = [spark.read.parquet(f"{small}/{name}.parquet").count() for name in ("orders", "customer", "events")]
    assert sum(found) == sum(tables) and 2 < len(found) <= 9


def test_a_task_sends_one_record_of_a_key_to_the_state(monkeypatch):
    draw, names = random.Random(3), ["_key", "key", "value", "_pos"]
    log = [(f"k{draw.randrange(5)}" if p % 7 else None, f"v{p}", 2**60 + p) for p in range(200)]
    sent = [*log, *draw.sample(log, 50)]
    draw.shuffle(sent)
    parts = [pa.RecordBatch.from_pylist([dict(zip(names, (k, k, v, p), strict=True)) for k, v, p in sent[at : at + 25]]) for at in range(0, 250, 25)]
    want = {key: (value, pos) for key, value, pos in log}
    for held in (40, 100_000):
        monkeypatch.setattr(delivery, "HELD", held)
        got = [row for batch in delivery.newest(iter(parts)) for row in batch.to_pylist()]
        assert len(got) == len(want) and {g["_key"]: (g["value"], g["_pos"]) for g in got} == want
    assert list(delivery.newest(iter([]))) == []
