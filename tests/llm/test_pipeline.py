"""The pipeline and the registered queries."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from checks.base import Check
from checks.compare_results import compare, duck
from inventrace.llm import queries

SF = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, why = compare(spark, duck(SF), Check(queries.QUERIES[name], queries.ORACLE_SQL[name]), SF)
    assert ok, why


def test_every_operator_is_registered():
    names = set(entry_point.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names and "pipeline" not in entry_point.oracle_sql()


def test_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/stage{len(seen)}")
        docs = spark.read.parquet(path)
        rows = docs.collect()
        seen.append((name, docs.columns, rows))
    for _, columns, _ in seen[:-1]:
        assert columns == DOCUMENTS
    kept = {r.doc_id for r in seen[0][2]}
    assert {d for d, q in labels.items() if q == 1} <= kept
    assert sum(d not in kept for d, q in labels.items() if q == 0) > 0
    assert len(seen[1][2]) == len(seen[0][2]) and {r.doc_id for r in seen[1][2]} == kept
    assert any(r.text != before[r.doc_id].text for r in seen[1][2])
    assert len({r.doc_id for r in seen[2][2]}) == len(seen[2][2]) <= len(seen[1][2])
    assert {r.doc_id for r in seen[3][2]} <= {r.doc_id for r in seen[2][2]}
    assert sorted((r.doc_id, r.text) for r in seen[4][2]) == sorted((r.doc_id, r.text) for r in seen[3][2])


def test_pipeline_takes_odd_and_no_rows(spark, odd, empty):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for table in (odd, empty):
        docs = table.select(*plain)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
