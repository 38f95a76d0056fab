from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from changeflow.operators.keyed_order import (
    number_in_key,
    position_chunk,
    previous_in_key,
    running_sum_in_key,
)


@pytest.fixture(scope="module")
def log(spark):
    """600 positions; one key holds half of them, some keys are rare, keys and values have nulls."""
    chance = random.Random(7)
    rows = []
    for pos in range(600):
        key = 0 if chance.random() < 0.5 else chance.randrange(1, 40)
        value = None if chance.random() < 0.1 else chance.randrange(1000)
        rows.append((pos, None if key in (1, 2, 3) else key, None if key % 3 == 2 else f"g{key % 3}", value))
    chance.shuffle(rows)
    return spark.createDataFrame(rows, "pos BIGINT, k INT, g STRING, v INT").cache()


def same(got, want):
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("keys", [["k"], ["k", "g"], []])
@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_previous_equals_lag(log, keys, width):
    got = previous_in_key(log, keys, "pos", ["v", "pos"], position_chunk("pos", width))
    window = Window.partitionBy(*keys).orderBy("pos")
    same(got, log.select("*", F.lag("v").over(window).alias("prev_v"), F.lag("pos").over(window).alias("prev_pos")))


@pytest.mark.parametrize("keys", [["k"], ["k", "g"], []])
@pytest.mark.parametrize("width", [1, 9, 10_000])
def test_number_and_running_sum(log, keys, width):
    chunk = position_chunk("pos", width)
    window = Window.partitionBy(*keys).orderBy("pos")
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    numbered = number_in_key(log, keys, "pos", chunk)
    got = running_sum_in_key(numbered, keys, "pos", {"total": F.col("v"), "n": F.lit(2)}, chunk)
    seq, total, n = F.row_number().over(window), F.sum("v").over(so_far), F.sum(F.lit(2)).over(so_far)
    same(got, log.select("*", seq.alias("seq"), total.alias("total"), n.alias("n")))


def test_empty_log(log):
    none = log.where("false")
    assert previous_in_key(none, ["k"], "pos", ["v"], position_chunk("pos")).collect() == []
    assert number_in_key(none, ["k"], "pos", position_chunk("pos")).collect() == []


def test_nothing_runs_while_a_plan_is_built(spark, log):
    log.count()
    spark.sparkContext.setJobGroup("built", "plans only")
    try:
        previous_in_key(log, ["k"], "pos", ["v"], position_chunk("pos", 10))
        number_in_key(log, ["k"], "pos", position_chunk("pos", 10))
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("built") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("add", [
    lambda df: previous_in_key(df, ["k"], "pos", ["v"], position_chunk("pos", 10)),
    lambda df: number_in_key(df, ["k"], "pos", position_chunk("pos", 10)),
])
def test_rows_are_shuffled_once(spark, log, add, tmp_path):
    log.write.parquet(str(tmp_path / "log"))
    got = add(spark.read.parquet(str(tmp_path / "log")))
    got.collect()
    text = got._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    # The rows by (key, chunk), their last rows by key, and what these carry by (key, chunk) again.
    dealt = [line for line in final.splitlines() if "Exchange" in line and "REPARTITION_BY_COL" in line]
    assert len([line for line in dealt if "Reused" not in line]) == 1, final
    assert "ReusedExchange" in final, final
