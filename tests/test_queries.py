"""Every registered query against its SQL, and what its plan must not hold."""

from __future__ import annotations

import importlib.util
from decimal import Decimal
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

ROOT = Path(__file__).resolve().parent.parent
_spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry)
OWN = list(entry.catalog.QUERIES)

TABLES = ["orders", "customer", "events", "documents", "pages", "lineitem"]


@pytest.fixture(scope="module")
def database(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


def normal(rows):
    def cell(value):
        return str(value.normalize()) if isinstance(value, Decimal) else str(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, small, database, name):
    got = entry.queries()[name](spark, small)
    columns = sorted(got.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    for shape in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        # A single row or a report of totals may end in one task; nothing else may.
        assert shape not in plan or (shape == "SinglePartition" and ENDS_IN_ONE_TASK.get(name)), shape
    cursor = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    assert normal(got.select(*columns).collect()) == normal(want)


# Totals over the whole input: every task sends one row.
ENDS_IN_ONE_TASK = {name: True for name in ("count_matching", "sink_completeness", "recovery_unit")}


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["id", "pos", "op", "amount", "status"] and frame.count() > 0


def test_every_query_has_its_sql():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())
