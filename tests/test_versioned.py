"""Versioned upsert state: against a plain dict over many batches, with failures between the steps of a batch."""

from __future__ import annotations

import random

import pytest

from changeflow.session import work_dir
from changeflow.streaming.sinks import FileTarget, StreamOptions, read_upsert, write_keyed
from changeflow.streaming.versioned import RECORD, VersionedState


def batch(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def fold(into, rows):
    for key, offset, value in rows:
        if key not in into or offset > into[key][0]:
            into[key] = (offset, value)


def held(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {key: (offset, value) for key, offset, value in rows}


def batches(n, seed):
    """Changes of 40 keys; positions come out of order over batches, and some keys are deleted."""
    draw, out = random.Random(seed), []
    offsets = list(range(n * 12))
    for k in range(0, len(offsets) - 24, 24):
        part = offsets[k : k + 36]
        draw.shuffle(part)
        offsets[k : k + 36] = part
    for k in range(n):
        out.append([(f"k{draw.randrange(40)}", o, None if draw.random() < 0.2 else f"v{o}") for o in offsets[k * 12 : k * 12 + 12]])
    return out


@pytest.mark.parametrize("limit, ratio", [(3, 100.0), (16, 0.5), (1, 0.0)])
def test_state_equals_a_plain_fold(spark, limit, ratio):
    state = VersionedState(work_dir(spark, "state"), buckets=4, limit=limit, ratio=ratio)
    assert state.current(spark) is None and state.live(spark).count() == 0
    want = {}
    for number, rows in enumerate(batches(7, 1)):
        version = state.apply(batch(spark, rows), number)
        fold(want, rows)
        assert held(state.records(spark)) == want
        assert len(version.deltas) < limit and version.batch_id == number
    assert held(state.live(spark)) == {k: v for k, v in want.items() if v[1] is not None}


def test_empty_batches_and_hot_keys(spark):
    state = VersionedState(work_dir(spark, "state"), buckets=2, limit=4)
    state.apply(batch(spark, []), 0)
    state.apply(batch(spark, [("hot", o, f"v{o}") for o in range(500)] + [("other", 1, None)]), 1)
    state.apply(batch(spark, []), 2)
    assert held(state.records(spark)) == {"hot": (499, "v499"), "other": (1, None)}
    assert state.current(spark).batch_id == 2


def test_a_batch_that_runs_again_changes_nothing(spark):
    state = VersionedState(work_dir(spark, "state"), buckets=2)
    state.apply(batch(spark, [("a", 1, "x")]), 0)
    before = state.current(spark)
    state.apply(batch(spark, [("a", 9, "other")]), 0)
    assert state.current(spark) == before and held(state.records(spark)) == {"a": (1, "x")}


@pytest.mark.parametrize("step", ["_commit", "_compact"])
def test_a_batch_that_fails_is_not_seen_and_runs_again(spark, monkeypatch, step):
    state = VersionedState(work_dir(spark, "state"), buckets=2, limit=2, ratio=100.0)
    want, rows = {}, batches(5, 2)
    done = getattr(VersionedState, step)
    for number, part in enumerate(rows):
        failed = False

        def fails(self, *args):
            nonlocal failed
            if not failed:
                failed = True
                if step == "_compact":
                    done(self, *args)  # the other generation is written, the manifest is not
                raise RuntimeError("lost")
            return done(self, *args)

        monkeypatch.setattr(VersionedState, step, fails)
        try:
            state.apply(batch(spark, part), number)
        except RuntimeError:
            assert held(state.records(spark)) == want
            state.apply(batch(spark, part), number)
        fold(want, part)
        assert held(state.records(spark)) == want


def test_untouched_buckets_stay_and_old_ones_go(spark):
    path = work_dir(spark, "state")
    state = VersionedState(path, buckets=8, limit=1)
    state.apply(batch(spark, [(f"k{i}", i, "x") for i in range(60)]), 0)
    files = {}
    for number in range(1, 9):
        state.apply(batch(spark, [("k7", 100 + number, "y")]), number)
        files[number] = set(spark.read.parquet(f"{path}/base").inputFiles())
    touched = next(b for b, (gen, _) in state.current(spark).base.items() if any(f"bucket={b}/" in f for f in files[8] - files[7]))
    assert all(f"bucket={touched}/" in f for f in files[8] ^ files[7])
    # Two generations of the touched bucket, one of the others, two manifests, however many versions there were.
    assert len({f.rsplit("/", 1)[0] for f in files[8]}) == 8 + 1
    assert len(spark.read.parquet(f"{path}/manifest").inputFiles()) == 2
    assert len(spark.read.parquet(f"{path}/delta").select("slot").distinct().collect()) <= 2


def test_a_scan_of_a_folded_state_shuffles_nothing(spark):
    state = VersionedState(work_dir(spark, "state"), buckets=4, limit=1)
    state.apply(batch(spark, [(f"k{i}", i, "x") for i in range(30)]), 0)
    plan = state.live(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [" in plan


def test_the_number_of_buckets_is_kept(spark):
    path = work_dir(spark, "state")
    VersionedState(path, buckets=2).apply(batch(spark, [("a", 1, "x")]), 0)
    with pytest.raises(ValueError, match="2 buckets"):
        VersionedState(path, buckets=3).current(spark)


def test_a_reader_of_the_last_version_is_not_disturbed(spark):
    state = VersionedState(work_dir(spark, "state"), buckets=2, limit=2, ratio=100.0)
    want = {}
    for number, rows in enumerate(batches(8, 4)):
        version = state.apply(batch(spark, rows), number)
        fold(want, rows)
        before, seen = dict(want), version
        # One more version is written while this one is read.
        if number == 6:
            frame = state.records(spark, seen)
            state.apply(batch(spark, [("k1", 10_000, "new")]), 7)
            assert held(frame) == before
            break


def test_several_topics_and_jobs_share_a_target(spark):
    root = work_dir(spark, "keyed")
    target = FileTarget(f"{root}/out", buckets=2)
    source = f"{root}/in"
    parts = [
        [("007", 1, "a", "x"), ("b", 1, "a", "u")],
        [("007", 3, "a", None), ("007", 2, "a", "late"), ("b", 2, "c", "w")],
        [("b", 3, "a", "v")],
    ]
    for part in parts:
        spark.createDataFrame(part, "topic STRING, offset BIGINT, key STRING, value STRING").coalesce(1).write.mode("append").parquet(source)

    def run(job):
        stream = spark.readStream.schema("topic STRING, offset BIGINT, key STRING, value STRING").option("maxFilesPerTrigger", 1).parquet(source)
        write_keyed(stream, ["007", "b"], target, StreamOptions("t", job, f"{root}/cp", interval=None)).awaitTermination()

    def read(topic):
        return sorted((r["key"], r["value"]) for r in read_upsert(spark, target, topic).collect())

    for job in ("one", "one", "two"):
        run(job)
        assert read("007") == [] and read("b") == [("a", "v"), ("c", "w")]
    assert target.state_of("t-one", "b").current(spark).batch_id == 2
    nothing = FileTarget(f"{root}/empty")
    nothing.enter(spark, "j")
    with pytest.raises(ValueError, match="no job"):
        read_upsert(spark, nothing, "b")
