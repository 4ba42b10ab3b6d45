"""Plan shapes that must hold at any scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.audit import pages, payload
from checks.base import run_ts
from checks.catalog import CHECKS
from checks.state import OWNED, audit_events, mapping, order_snapshot, order_state
from inventrace.operators import attribution, upsert
from inventrace.plans import audit_log
from inventrace.sources import landed

SF = "/root/testdata/sf0.001"
NEVER = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonRDD", "MapInPandas", "FlatMapGroups"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_join_and_no_python_in_any_query(spark):
    bad = {}
    for name, c in CHECKS.items():
        text = plan(c.query(spark, SF))
        hits = [n for n in NEVER if n in text]
        if hits:
            bad[name] = hits
    assert not bad


def test_snapshot_merge_shuffles_each_side_once(spark):
    text = plan(upsert.compare(OWNED, order_snapshot(spark, SF), order_state(spark, SF), run_ts()))
    assert text.count("Exchange hashpartitioning") == 2


def test_run_anchor_reaches_the_event_scan(spark):
    """The attribution window is pushed to the scan, which reads only what attribution needs."""
    cells = spark.createDataFrame([("USER", "1", "view")], "service_type string, resource_id string, field_name string")
    out = attribution.attribute(cells, audit_events(spark, SF), mapping(spark), run_ts())
    text = plan(out)
    assert "GreaterThan(ts," in text and "LessThan(ts," in text
    assert "props" not in text and "value:" not in text


@pytest.mark.parametrize("name", ["recent_n_per_group", "res_athena"])
def test_top_n_is_limited_before_the_shuffle(spark, name):
    text = plan(CHECKS[name].query(spark, SF))
    assert text.count("WindowGroupLimit") == 2


def test_each_event_is_parsed_once(spark):
    """Filters above the parse are not pushed below it with a copy of the parse each."""
    events = audit_log.events_from_pages(pages(spark, SF, payload()), run_ts())
    assert plan(events).count("from_json(StructField(eventID") == 1


def test_details_in_several_pages_are_one_row(spark):
    rows = [("a", "r", 2, "k", ["c"]), ("a", "r", 1, "k", ["a", "b"]), ("a", "r", 1, "other", None), ("b", "r", None, "k", ["x"])]
    flat = spark.createDataFrame(rows, "account_id string, region string, page int, k string, v array<string>")
    found = landed.by_key(flat.select("account_id", "region", "page", F.struct("k", "v").alias("doc")), F.col("doc.k"), "k", lists={"v": F.col("doc.v")})
    assert {(r.account_id, r.k): r.v for r in found.collect()} == {("a", "k"): ["a", "b", "c"], ("a", "other"): [], ("b", "k"): ["x"]}


def test_attribution_shuffles_little(spark):
    """One as-of join serves the evidence of the resource and of the field, and one join brings it to the cells."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(CHECKS["attr_field_fallback"].query(spark, SF))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(shuffles) <= 8, text
