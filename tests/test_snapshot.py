"""Chunked snapshots of a table that changes meanwhile, against its state, with failures between and inside chunks."""

from __future__ import annotations

import random

import pytest

from changeflow.operators.changelog import current_state
from changeflow.session import work_dir
from changeflow.sources.snapshot import ChunkedSnapshot

SCHEMA = "id BIGINT, pos BIGINT, op STRING, amount BIGINT"


class Source:
    """A table and its log; every look at the position lets some more changes happen."""

    def __init__(self, spark, seed, keys, per_look):
        self.spark, self.draw, self.keys, self.per_look = spark, random.Random(seed), keys, per_look
        self.table, self.log, self.reads = {}, [], []
        for _ in range(3 * len(keys)):
            self.change()

    def change(self):
        key = self.draw.choice(self.keys)
        if self.draw.random() < 0.25 and key in self.table:
            self.log.append((key, len(self.log), "d", None))
            del self.table[key]
        else:
            op = "u" if key in self.table else "c"
            self.table[key] = self.draw.randrange(10**6)
            self.log.append((key, len(self.log), op, self.table[key]))

    def position(self):
        last = len(self.log) - 1
        for _ in range(self.per_look):
            self.change()
        return last

    def read(self, where):
        rows = self.spark.createDataFrame(list(self.table.items()), "id BIGINT, amount BIGINT").where(where)
        self.reads.append({r["id"] for r in rows.collect()})
        return rows

    def high(self):
        """As ``position``, but the changes happen before it is noted: the read has not seen them."""
        for _ in range(self.per_look):
            self.change()
        return len(self.log) - 1

    def frame(self):
        return self.spark.createDataFrame(self.log, SCHEMA)


def positions(source):
    """Low and high in turn: changes happen after the low one is noted and before the high one is."""
    turn = [False]

    def look():
        turn[0] = not turn[0]
        return source.position() if turn[0] else source.high()

    return look


def state(snapshot, spark, source):
    folded = current_state(snapshot.changes(spark, source.frame()), ["id"], "pos")
    rows = [(r["id"], r["amount"]) for r in folded.collect()]
    assert len(rows) == len({k for k, _ in rows})
    return dict(rows)


@pytest.mark.parametrize("together, parts", [(1, 4), (3, 7)])
def test_snapshot_equals_the_table_while_it_changes(spark, together, parts):
    # Keys beyond the bounds come up too.
    source = Source(spark, 3, list(range(-5, 60)), 15)
    snapshot = ChunkedSnapshot(work_dir(spark, "snapshot"), "id", 0, 50, parts)
    assert snapshot.changes(spark, source.frame()).count() == 0
    assert snapshot.take(spark, source.read, positions(source), together) == parts
    assert state(snapshot, spark, source) == source.table
    for _ in range(40):
        source.change()
    assert state(snapshot, spark, source) == source.table


def test_a_snapshot_goes_on_where_it_was(spark):
    source = Source(spark, 4, list(range(40)), 5)
    snapshot = ChunkedSnapshot(work_dir(spark, "snapshot"), "id", 0, 39, 4)
    assert snapshot.take(spark, source.read, positions(source), limit=2) == 2
    # The finished half is right, the other half is not there.
    assert state(snapshot, spark, source) == {k: v for k, v in source.table.items() if k < 20}
    before = len(source.reads)
    assert snapshot.take(spark, source.read, positions(source)) == 2
    assert not any(k < 20 for read in source.reads[before:] for k in read)
    assert snapshot.take(spark, source.read, positions(source)) == 0
    assert state(snapshot, spark, source) == source.table


def test_a_chunk_that_fails_is_read_again(spark):
    source = Source(spark, 5, list(range(30)), 5)
    snapshot = ChunkedSnapshot(work_dir(spark, "snapshot"), "id", 0, 29, 3)
    look, looks = positions(source), [0]

    def lost():
        looks[0] += 1
        if looks[0] == 4:  # the rows of the second chunk are written, its marker is not
            raise RuntimeError("lost")
        return look()

    with pytest.raises(RuntimeError, match="lost"):
        snapshot.take(spark, source.read, lost)
    for _ in range(30):
        source.change()
    assert state(snapshot, spark, source) == {k: v for k, v in source.table.items() if k < 10}
    assert snapshot.take(spark, source.read, positions(source)) == 2
    assert state(snapshot, spark, source) == source.table


def test_an_empty_table(spark):
    snapshot = ChunkedSnapshot(work_dir(spark, "snapshot"), "id", 0, 9, 2)
    empty = spark.createDataFrame([], "id BIGINT, amount BIGINT")
    assert snapshot.take(spark, empty.where, lambda: -1) == 2
    log = spark.createDataFrame([(1, 0, "c", 5), (8, 1, "c", 6), (8, 2, "d", None)], SCHEMA)
    assert [(r.id, r.amount) for r in current_state(snapshot.changes(spark, log), ["id"], "pos").collect()] == [(1, 5)]
