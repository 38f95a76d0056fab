from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators.changelog import (
    as_append,
    compact,
    current_state,
    dedup_events,
    diff_states,
    evolve,
    evolve_tables,
    ordered,
    state_as_of,
    update_delta,
)
from changeflow.operators.envelope import extract_row, op_image, parse_envelope, to_envelope, to_upsert_record
from changeflow.sources import derived
from changeflow.session import work_dir
from changeflow.sources.changelog import (
    filter_tables,
    key_ranges,
    read_changelog,
    read_outbox,
    snapshot_then_log,
    stream_changelog,
    write_changelog,
)
from changeflow.sources.tables import OUTBOX_EVENTS, ORDERS, read_table
from changeflow.sources.tables import ORDERS, read_table


@pytest.fixture(scope="module")
def log(spark):
    """A random legal log, its rows in random order: (pos, id, op, v)."""
    chance = random.Random(3)
    live: dict[int, int] = {}
    rows = []
    for pos in range(500):
        key = 0 if chance.random() < 0.4 else chance.randrange(1, 30)
        if key in live and chance.random() < 0.25:
            rows.append((pos, key, "d", None))
            del live[key]
        else:
            value = chance.randrange(100)
            rows.append((pos, key, "u" if key in live else "c", value))
            live[key] = value
    chance.shuffle(rows)
    return spark.createDataFrame(rows, "pos BIGINT, id INT, op STRING, v INT").cache()


def fold(rows):
    state = {}
    for row in sorted(rows, key=lambda r: r.pos):
        if row.op == "d":
            state.pop(row.id, None)
        else:
            state[row.id] = row.v
    return state


def test_current_state_is_the_replayed_log(log):
    assert {r.id: r.v for r in current_state(log, ["id"], "pos").collect()} == fold(log.collect())


@pytest.mark.parametrize("at", [-1, 0, 100, 499])
def test_state_as_of(log, at):
    want = fold([r for r in log.collect() if r.pos <= at])
    assert {r.id: r.v for r in state_as_of(log, ["id"], "pos", at).collect()} == want


def test_compact_keeps_tombstones(log):
    kept = compact(log, ["id"], "pos")
    assert kept.columns == log.columns
    assert kept.count() == log.select("id").distinct().count()
    assert kept.where("op = 'd'").count() > 0


def test_fold_reduces_before_the_shuffle(log):
    plan = compact(log, ["id"], "pos")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


def test_as_append_keeps_every_change(log):
    assert as_append(log).count() == 500
    assert as_append(log, ["pos"]).columns == ["pos"]


def test_snapshot_then_log_has_no_gap_and_no_copy(log):
    high = 250
    snapshot = state_as_of(log, ["id"], "pos", high).drop("op", "pos")
    whole = snapshot_then_log(snapshot, log, high)
    assert whole.where("op = 'r'").count() == snapshot.count()
    assert whole.where("op <> 'r'").count() == log.where(F.col("pos") > high).count()
    folded = compact(whole.withColumn("order", F.col("pos")), ["id"], "order").where("op <> 'd'")
    assert {r.id: r.v for r in folded.collect()} == fold(log.collect())


def test_ordered(log):
    seen = {}
    for row in sorted(ordered(log, ["id"], "pos", 50).collect(), key=lambda r: r.pos):
        seen[row.id] = seen.get(row.id, 0) + 1
        assert row.seq == seen[row.id]


def test_dedup_batch(log):
    assert dedup_events(log.unionAll(log).unionAll(log.where("id = 0")), ["pos"]).count() == 500


def test_diff_of_two_states_leads_from_one_to_the_other(log):
    old = state_as_of(log, ["id"], "pos", 200).select("id", "v")
    new = current_state(log, ["id"], "pos").select("id", "v")
    state = {r.id: r.v for r in old.collect()}
    for change in diff_states(old, new, ["id"]).collect():
        assert (change.op == "c") == (change.before is None) and (change.op == "d") == (change.after is None)
        if change.op == "d":
            del state[change.id]
        else:
            assert state.get(change.id) != change.after.v
            state[change.id] = change.after.v
    assert state == {r.id: r.v for r in new.collect()}


def test_diff_treats_nulls_as_values(spark):
    old = spark.createDataFrame([(1, None), (2, None), (3, 5)], "id INT, v INT")
    new = spark.createDataFrame([(1, None), (2, 7), (3, None)], "id INT, v INT")
    assert sorted((r.id, r.op) for r in diff_states(old, new, ["id"]).collect()) == [(2, "u"), (3, "u")]


def test_evolve_tells_absent_from_null(spark):
    texts = ['{"id":1}', '{"id":2,"new_field":null}', '{"id":3,"new_field":"x","more":1}', "broken"]
    frame = evolve(spark.createDataFrame([(t,) for t in texts], "value STRING"), "id BIGINT, new_field STRING")
    got = [(r.id, r.new_field, r.has_new_field) for r in frame.collect()]
    assert got == [(1, None, False), (2, None, True), (3, "x", True), (None, None, False)]


def test_evolve_tables(spark):
    old = spark.createDataFrame([(1,)], "id INT")
    new = spark.createDataFrame([(2, "x")], "id INT, new_field STRING")
    assert sorted(tuple(r) for r in evolve_tables([old, new]).collect()) == [(1, None), (2, "x")]


def envelopes(spark, objects):
    return spark.createDataFrame([(o if isinstance(o, str) or o is None else json.dumps(o),) for o in objects], "value STRING")


def test_envelope_round_trip_keeps_hard_strings(spark, small):
    hard = ["TEST-WITH-\"QUOTES-1\"-AND-'APOSTROPHES'", "X" * 500, "back\\slash", "line\nbreak\t", "é漢🙂", ""]
    frame = spark.createDataFrame(list(enumerate(hard)), "id BIGINT, status STRING")
    changes = frame.select(
        F.lit(None).cast("struct<id: bigint, status: string>").alias("before"),
        F.struct("id", "status").alias("after"),
        F.lit("c").alias("op"),
        derived.source_struct("d", "t", F.lit(1), F.col("id")).alias("source"),
        F.lit(1).cast("bigint").alias("ts_ms"),
    )
    back = parse_envelope(to_envelope(changes).select("value"), "id BIGINT, status STRING")
    assert {r.after.id: r.after.status for r in back.collect()} == dict(enumerate(hard))


def test_envelope_writes_nulls(spark):
    changes = spark.sql(
        """SELECT CAST(NULL AS STRUCT<id: BIGINT, s: STRING>) AS before, named_struct('id', 1L, 's', CAST(NULL AS STRING)) AS after,
           'c' AS op, CAST(NULL AS STRUCT<db: STRING>) AS source, 5L AS ts_ms"""
    )
    text = to_envelope(changes).first().value
    assert json.loads(text) == {"before": None, "after": {"id": 1, "s": None}, "op": "c", "source": None, "ts_ms": 5}


def test_parse_envelope_with_decimals_and_malformed(spark):
    frame = envelopes(spark, [{"op": "u", "before": None, "after": {"id": 1, "amount": "J2w="}}, '{"op":', "prose"])
    parsed = parse_envelope(frame, "id BIGINT, amount DECIMAL(10,2)", decimals={"amount": ("base64", 10, 2)}, malformed="bad")
    good, cut, prose = parsed.collect()
    assert (str(good.after.amount), good.before, good.bad) == ("100.92", None, None)
    assert (cut.after, cut.bad) == (None, '{"op":') and prose.bad == "prose"


def test_op_image_checks_images(spark):
    row = "struct<id: bigint>"
    cases = [("c", None, 1, True), ("r", None, 1, True), ("u", 1, 1, True), ("d", 1, None, True),
             ("c", 1, 1, False), ("u", None, 1, False), ("d", 1, 1, False), ("x", 1, 1, False)]
    frame = spark.createDataFrame([(op, b, a) for op, b, a, _ in cases], "op STRING, b BIGINT, a BIGINT").select(
        "op",
        F.when(F.col("b").isNotNull(), F.struct(F.col("b").alias("id"))).cast(row).alias("before"),
        F.when(F.col("a").isNotNull(), F.struct(F.col("a").alias("id"))).cast(row).alias("after"),
    )
    got = op_image(frame, "id").collect()
    assert [r.images_fit_op for r in got] == [fits for *_, fits in cases]
    assert all(r.key == 1 and r.image.id == 1 for r in got)


def test_extract_row_of_any_shape(spark):
    texts = ['{"after":{"id":1,"s":"a"}}', '{"after":{"s":"a"}}', '{"after":null}', '{"id":2,"s":"b"}', "junk", None]
    env = extract_row(envelopes(spark, texts), "envelope", "id BIGINT, s STRING").collect()
    flat = extract_row(envelopes(spark, texts), "flat", "id BIGINT, s STRING").collect()
    assert [r.row.id if r.row else None for r in env] == [1, None, None, None, None, None]
    assert [r.row.id if r.row else None for r in flat] == [None, None, None, 2, None, None]


def test_upsert_record(spark):
    frame = spark.createDataFrame([(1, None, False), (2, "x", True)], "id BIGINT, s STRING, gone BOOLEAN")
    kept, gone = to_upsert_record(frame, ["id"], ["id", "s"], F.col("gone")).collect()
    assert (json.loads(kept.key), json.loads(kept.value)) == ({"id": 1}, {"id": 1, "s": None})
    assert (json.loads(gone.key), gone.value) == ({"id": 2}, None)


def test_update_delta(spark, small):
    changes = derived.account_changes(derived.events(spark, small))
    rows = update_delta(changes, ["amount"], ["status"]).collect()
    assert rows and all(r.op == "u" and r.amount_delta == r.after.amount - r.before.amount for r in rows)
    assert all(r.status_changed == (r.after.status != r.before.status) for r in rows)


def test_filter_tables_by_text_and_by_column(spark):
    frame = envelopes(spark, [{"source": {"db": "a", "table": "t"}}, {"source": {"db": "b", "table": "t"}}, {"x": 1}, "?"])
    assert filter_tables(frame, ["a.t"]).count() == 1
    named = spark.createDataFrame([("a", "t"), ("a", "s"), ("b", "t")], "db STRING, tbl STRING")
    assert filter_tables(named, ["a.t", "a.s"], db="db", table="tbl").count() == 2


def test_table_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("a", "t", "x"), ("b", "t", "y")], "db STRING, tbl STRING, value STRING").write.partitionBy(
        "db", "tbl"
    ).parquet(path)
    plan = filter_tables(spark.read.parquet(path), ["a.t"], db="db", table="tbl")._jdf.queryExecution().executedPlan().toString()
    assert "(tbl#" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]


def test_read_changelog_formats(spark, tmp_path):
    frame = envelopes(spark, [{"source": {"db": "a", "table": "t"}}, {"source": {"db": "a", "table": "s"}}])
    frame.write.text(str(tmp_path / "text"))
    assert read_changelog(spark, str(tmp_path / "text"), ["a.t"], fmt="text").count() == 1
    frame.withColumn("offset", F.lit(1)).write.json(str(tmp_path / "json"))
    assert read_changelog(spark, str(tmp_path / "json"), fmt="json").where("offset = 1").count() == 2


def test_read_table_drops_other_tables(spark, small):
    rows = read_table(derived.database_log(spark, small), ORDERS, db="shop")
    assert rows.count() == 1500 and read_table(derived.database_log(spark, small), ORDERS, db="other").count() == 0


@pytest.mark.parametrize(("lower", "upper", "parts"), [(0, 99, 4), (5, 5, 3), (-10, 10, 7), (1, 3, 10), (0, 10**15, 3)])
def test_key_ranges_cover_every_key_once(spark, lower, upper, parts):
    ranges = key_ranges("k", lower, upper, parts)
    keys = sorted({lower - 5, lower, lower + 1, (lower + upper) // 2, upper, upper + 5})
    frame = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k BIGINT")
    hits = frame.select("k", sum(F.when(F.expr(r), 1).otherwise(0) for r in ranges).alias("n")).collect()
    assert all(h.n == 1 for h in hits) and len(ranges) <= parts


def test_state_as_of_folds_ties_by_position(spark):
    rows = [(1, 10, 5, "c", "first"), (1, 11, 5, "u", "second"), (2, 13, 5, "u", "second"), (2, 12, 5, "c", "first"), (2, 14, 6, "d", None)]
    log = spark.createDataFrame(rows, "id int, pos int, ts int, op string, v string")
    assert {r.id: r.v for r in state_as_of(log, ["id"], "pos", 5, cut="ts").collect()} == {1: "second", 2: "second"}


def _log(spark):
    def text(db, table, i):
        row = f'{{"id": {i}, "status": "s{i}", "destination": "d{i}"}}'
        return f'{{"before": null, "after": {row}, "source": {{"db": "{db}", "table": "{table}", "pos": {i}}}, "op": "c", "ts_ms": 0}}'

    names = [("shop", "orders"), ("shop", "outbox_events"), ("other", "orders")]
    rows = [(text(*names[i % 3], i),) for i in range(30)] + [("no envelope",), (None,)]
    return spark.createDataFrame(rows, "value STRING").selectExpr("'t' AS topic", "0 AS partition", "1L AS offset", "'k' AS key", "value", "current_timestamp() AS timestamp")


@pytest.mark.parametrize("streaming", [False, True])
def test_log_by_table_is_pruned_and_parsed_once(spark, streaming):
    path = work_dir(spark, "by-table")
    if streaming:
        source = work_dir(spark, "flat")
        _log(spark).write.parquet(source)
        flow = spark.readStream.schema(_log(spark).schema).parquet(source)
        stream_changelog(flow, path, work_dir(spark, "cp")).awaitTermination()
    else:
        write_changelog(_log(spark), path)
    log = read_outbox(spark, path, "shop", by_table=True)
    rows = read_table(log, OUTBOX_EVENTS, db="shop")
    assert sorted(r.id for r in rows.collect()) == list(range(1, 30, 3))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(db#" in plan and "(table#" in plan
    # No parse to find the table: the filters are on directories.
    assert "get_json_object" not in plan and "from_json" not in plan.split("PartitionFilters")[1]
    files = {f.split("/table=")[1].split("/")[0] for f in log.where("db = 'shop' AND table = 'outbox_events'").inputFiles()}
    assert "outbox_events" in files
    scanned = read_changelog(spark, path, ["shop.orders", "other.orders"], by_table=True)
    assert scanned.count() == 20 and {r.db for r in scanned.select("db").distinct().collect()} == {"shop", "other"}
    # With all tables, texts that name none are there too; a filter by text finds the same rows as one by directory.
    whole = read_changelog(spark, path, by_table=True)
    assert whole.count() == 32 and filter_tables(whole, ["shop.orders"]).count() == 10
    assert read_table(whole, ORDERS, db="other").count() == 10 and read_table(whole.drop("db", "table"), ORDERS).count() == 20


def test_log_by_table_can_be_streamed(spark):
    path, out = work_dir(spark, "by-table"), work_dir(spark, "out")
    write_changelog(_log(spark), path)
    rows = read_table(read_changelog(spark, path, ["shop.orders"], streaming=True, by_table=True), ORDERS)
    rows.select("id").writeStream.option("checkpointLocation", work_dir(spark, "cp")).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(0, 30, 3))
