"""The corpus pipeline end to end, and each query's columns."""

from __future__ import annotations

import corpus_pipeline
import pytest

from changeflow.llm.common import table
from changeflow.llm.queries import QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = spark.createDataFrame(stage(spark, docs, small).collect(), docs.schema)
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert docs.columns == COLUMNS and set(after) <= before and len(after) == len(set(after)), name
    pieces = corpus_pipeline.run(spark, small)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == set(after)


def test_stages_on_an_empty_table(spark, small):
    docs = table(spark, small, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).collect() == []


@pytest.mark.parametrize("name", QUERIES)
def test_query_covers_its_table(spark, small, name):
    got = QUERIES[name](spark, small)
    source = {"op2": "pages", "op5": "pages", "op9": "pages", "op11": "embeddings"}.get(name.split("_")[0], "documents")
    rows, n = got.count(), table(spark, small, source).count()
    if name.split("_")[0] not in ("op1", "op3", "op5", "op11", "op13"):
        assert rows == n
    assert rows > 0
