"""Nearest event: window edges, ties, slices, hot resources, the evidence chain."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from inventrace.operators import attribution

T0 = datetime(2024, 1, 10, 12)
EVENT = "resource_id string, event_time timestamp_ntz, event_id string, user_name string"


def near(spark, anchors, events, slice_s=300):
    probes = spark.createDataFrame(anchors, "resource_id string, changed_at timestamp_ntz")
    ev = spark.createDataFrame(events, EVENT)
    rows = attribution.nearest_event(probes, ev, ["resource_id"], "changed_at", slice_s=slice_s)
    found = rows.select("resource_id", "changed_at", "_best.user_name").collect()
    assert len(found) == len({(r[0], r[1]) for r in found})
    return {(r[0], r[1]): r[2] for r in found}


def test_window_is_exclusive(spark):
    day = timedelta(days=1)
    events = [("a", T0 - day, "1", "u1"), ("b", T0 + day - timedelta(microseconds=1), "2", "u2"), ("c", T0 + day, "3", "u3")]
    assert near(spark, [("a", T0), ("b", T0), ("c", T0)], events) == {("b", T0): "u2"}


def test_ties_go_to_the_earlier_event_then_the_smaller_id(spark):
    h = timedelta(hours=1)
    events = [
        ("a", T0 + h, "0", "later"), ("a", T0 - h, "9", "earlier"),
        ("b", T0 + h, "7", "big"), ("b", T0 + h, "3", "small"),
        ("c", T0, "5", "exact2"), ("c", T0, "4", "exact1"),
    ]
    got = near(spark, [("a", T0), ("b", T0), ("c", T0), ("c", T0)], events)
    assert got == {("a", T0): "earlier", ("b", T0): "small", ("c", T0): "exact1"}


def test_against_brute_force_with_a_hot_resource(spark):
    rng = random.Random(7)

    def moment():
        return T0 + timedelta(seconds=rng.randrange(-3 * 86400, 3 * 86400, 30))

    def name():
        return "hot" if rng.random() < 0.5 else f"r{rng.randrange(6)}"

    events = [(name(), moment(), f"{i:04d}", f"u{i}") for i in range(400)]
    anchors = [(name(), moment()) for _ in range(300)]
    want = {}
    for key, at in anchors:
        gaps = [
            (abs(t - at), t, i, u) for k, t, i, u in events if k == key and abs(t - at) < timedelta(days=1)
        ]
        if gaps:
            want[(key, at)] = min(gaps)[3]
    for slice_s in (60, 300, 7200):
        assert near(spark, anchors, events, slice_s) == want


def test_chain_and_case(spark):
    events = spark.createDataFrame(
        [
            ("EC2", "i-1", "StopInstances", T0, "1", "direct"),
            ("IAM", "i-2", "StopInstances", T0, "2", "related"),
            ("Redshift", "w-1", "ModifyCluster", T0 - timedelta(days=90), "3", "old"),
            ("Redshift", "w-1", "TagResource", T0 - timedelta(days=80), "4", "tagger"),
        ],
        "resource_type string, resource_name string, event_name string, event_time timestamp_ntz, event_id string, user_name string",
    )
    cells = spark.createDataFrame(
        [("EC2", "i-1", "State"), ("EC2", "i-2", "state"), ("EC2", "i-2", "keyname"), ("EC2", "i-3", "state")],
        "service_type string, resource_id string, field_name string",
    )
    mapping = attribution.field_map(spark)
    anchor = F.lit(T0.isoformat(" ")).cast("timestamp_ntz")
    for at in (anchor, "at"):
        got = attribution.attribute(cells.withColumn("at", anchor), events, mapping, at)
        by = {(r.resource_id, r.field_name): r.changed_by for r in got.collect()}
        assert by == {
            ("i-1", "State"): "direct", ("i-2", "state"): "related", ("i-2", "keyname"): "unknown", ("i-3", "state"): "unknown",
        }
    warehouse = spark.createDataFrame(
        [("REDSHIFT", "w-1", "node_type"), ("REDSHIFT", "w-1", "app_id"), ("REDSHIFT", "w-2", "app_id")],
        "service_type string, resource_id string, field_name string",
    )
    got = attribution.attribute(warehouse, events, mapping, anchor, latest_first=True)
    by = {(r.resource_id, r.field_name): r.changed_by for r in got.collect()}
    assert by == {("w-1", "node_type"): "old", ("w-1", "app_id"): "tagger", ("w-2", "app_id"): "unknown"}
