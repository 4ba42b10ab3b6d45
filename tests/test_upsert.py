"""Properties of the comparison, and repeated keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.base import run_ts
from checks.state import LINES, ORDERS, order_snapshot, order_state
from inventrace.operators import upsert

SF = "/root/testdata/sf0.001"


def test_comparing_with_itself_changes_nothing(spark):
    state = order_state(spark, SF)
    compared = upsert.compare(ORDERS, state.drop("last_updated"), state, run_ts())
    assert upsert.changed_cells(ORDERS, compared).count() == 0
    assert {r[0] for r in compared.select("_action").distinct().collect()} == {"touch"}


def test_second_run_is_quiet_and_significant_is_a_subset(spark):
    snapshot, state = order_snapshot(spark, SF), order_state(spark, SF)
    first = upsert.compare(ORDERS, snapshot, state, run_ts())
    cells = upsert.changed_cells(ORDERS, first)
    kept = upsert.significant(cells)
    assert kept.exceptAll(cells).count() == 0 and 0 < kept.count() < cells.count()
    second = upsert.compare(ORDERS, snapshot, upsert.new_state(ORDERS, first), run_ts())
    row = upsert.counters(ORDERS, second).first()
    assert (row.inserted, row.updated) == (0, 0) and row.matched == row.processed


def test_repeated_keys_keep_the_last_row(spark):
    columns = "line_id string, account_id string, region string, quantity double, supplier bigint"
    hot = [("x", "a", "r", float(i), i) for i in range(500)]
    snapshot = spark.createDataFrame([*hot, ("y", "a", "r", 1.0, 1), (None, "a", "r", 1.0, 1)], columns)
    stored = [("x", "a", "r", 5.0, 5, datetime(2024, 1, 1)), ("x", "a", "r", 499.0, 499, datetime(2024, 1, 2))]
    state = spark.createDataFrame(stored, columns + ", last_updated timestamp_ntz")
    out = upsert.compare(LINES, snapshot, state, run_ts(), state_is_unique=False)
    rows = {r.line_id: r for r in out.collect()}
    assert (rows["x"].quantity, rows["x"]._copies, rows["x"]._action) == (499.0, 500, "touch")
    assert rows["y"]._action == "insert"


def test_null_replaces_a_value_and_reordered_list_keeps_the_old_text(spark):
    from inventrace.specs.registry import SPECS

    ec2 = SPECS["ec2"]
    base = {c: "v" for c in ec2.column_names} | {"security_groups": ["a", "b"], "storage_volumes": []}
    new = base | {"security_groups": ["b", "a"], "key_name": None}
    state = spark.createDataFrame([base], ec2.columns).withColumn("last_updated", F.lit("2024-01-01").cast("timestamp_ntz"))
    compared = upsert.compare(ec2, spark.createDataFrame([new], ec2.columns), state, run_ts())
    row = compared.first()
    assert row.security_groups == ["a", "b"] and row.key_name is None and row._action == "update"
    cell = upsert.changed_cells(ec2, compared).first()
    assert (cell.field_name, cell.old_value, cell.new_value) == ("keyname", "v", None)
    history = upsert.history_rows(upsert.changed_cells(ec2, compared).withColumn("changed_by", F.lit("u"))).first()
    assert history.new_value == "None"


def test_upsert_api_without_events(spark):
    from inventrace import upsert as api

    result = api(ORDERS, order_snapshot(spark, SF), order_state(spark, SF), run_ts())
    assert {r[0] for r in result.changes.select("changed_by").distinct().collect()} == {"unknown"}
    assert result.metrics.first().processed == order_state(spark, SF).count()
    assert result.state.count() > order_state(spark, SF).count()


def test_record_id_conflict_ignores_other_accounts(spark):
    from inventrace.specs.registry import SPECS

    dns = SPECS["route53"]

    def rows(*pairs):
        return spark.createDataFrame(
            [({c: "v" for c in dns.column_names} | {"record_id": r, "account_id": a, "ttl": t}) for r, a, t in pairs],
            dns.columns,
        )

    state = rows(("r1", "b", "60")).withColumn("last_updated", F.lit("2024-01-01").cast("timestamp_ntz"))
    snapshot = rows(("r1", "a", "1"), ("r1", "b", "2"), ("r2", "d", "3"), ("r2", "c", "4"))
    compared = upsert.compare(dns, snapshot, state, run_ts())
    got = {(r.record_id, r.account_id): (r.ttl, r._action) for r in compared.collect()}
    assert got == {("r1", "b"): ("2", "update"), ("r2", "c"): ("4", "insert")}
    row = upsert.counters(dns, compared).first()
    assert (row.processed, row.inserted, row.updated) == (4, 1, 1)
