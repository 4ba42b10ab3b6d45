"""Audit expressions, insert-or-ignore, and stream equal to batch."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from inventrace.functions import audit
from inventrace.plans import audit_log
from inventrace.streaming import audit_stream
from tests.fixtures.documents import audit_event, land


def name_of(spark, source, req, resp=None):
    df = spark.range(1).select(F.lit(req).cast("string").alias("q"), F.lit(resp).cast("string").alias("p"))
    q, p = F.col("q"), F.col("p")
    out = audit.resource_name(F.lit(source), q, F.try_parse_json(q), p, F.try_parse_json(p))
    return df.select(out).first()[0]


def test_resource_name_ladder(spark):
    ec2 = "ec2.amazonaws.com"
    assert name_of(spark, ec2, '{"instancesSet":{"items":[{"instanceId":"i-1"}]},"instanceId":"i-2"}') == "i-1"
    assert name_of(spark, ec2, '{"resourcesSet":{"items":[{}]},"instanceId":"i-2"}') == "unknown"
    assert name_of(spark, ec2, '{"resourcesSet":{"items":[]},"instanceId":"i-2"}') == "i-2"
    assert name_of(spark, ec2, '{"groupId":"g","vpcId":"v"}') == "v"
    assert name_of(spark, "x", '{"vpcId":"v"}', '{"functionName":"f","keyId":"k"}') == "k"
    assert name_of(spark, "x", '{"zId":"z","aId":"a"}') == "z"
    assert name_of(spark, "x", '{"userName":"u","someIdentifierX":"s"}') == "s"
    assert name_of(spark, "x", '{"n":1}', None) == "unknown"
    assert name_of(spark, "x", None, None) == "unknown"


def test_null_request_keeps_the_event(spark):
    """A request that is null, text or a list counts as empty for its own row only."""
    events = [audit_event("1", "AttachVolume", "ec2.amazonaws.com", "2024-01-15T10:00:00Z", r) for r in (None, "text", [1])]
    pages = spark.createDataFrame(
        [("1", "n", "r", (events,))], f"account_id string, account_name string, region string, doc struct<{audit_log.RAW_DOC}>"
    )
    rows = audit_log.events_from_pages(pages).collect()
    assert [r.changes for r in rows] == ['{"action":"attachvolume"}'] * 3
    assert {r.resource_name for r in rows} == {"attachvolume"}


def test_first_copy_wins_and_known_ids_are_ignored(spark):
    rows = [("e", "2024-01-01", a, r) for a in ("b", "a") for r in ("z", "y")] * 50 + [("k", "2024-01-01", "a", "y")]
    ev = spark.createDataFrame(rows, "event_id string, t string, account_id string, region string").withColumn(
        "event_time", F.col("t").cast("timestamp_ntz")
    )
    known = spark.createDataFrame([("k",)], "event_id string")
    got = audit_log.new_events(ev, known).collect()
    assert [(r.event_id, r.account_id, r.region) for r in got] == [("e", "a", "y")]


def test_stream_equals_batch(spark, tmp_path):
    stop = {"instancesSet": {"items": [{"instanceId": "i-1"}]}}
    day1 = [audit_event(str(i), "StopInstances", "ec2.amazonaws.com", f"2024-01-1{i}T10:00:00Z", stop) for i in range(5)]
    day2 = [day1[3], audit_event("9", "StartInstances", "ec2.amazonaws.com", "2024-01-15T10:00:00Z", stop), {"CloudTrailEvent": "{"}]
    land(tmp_path, "2024-01-15", {"cloudtrail": {"events": [{"Events": day1}]}})
    land(tmp_path, "2024-01-16", {"cloudtrail": {"events": [{"Events": day2}]}})
    source = str(tmp_path / "cloudtrail" / "events")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # the second start finds nothing new
        pages = audit_stream.read_pages(spark, source, max_files=1)
        audit_stream.start(audit_stream.stream_events(pages), out, checkpoint).awaitTermination()
    batch_pages = spark.read.schema(
        f"account_id string, account_name string, region string, doc struct<{audit_log.RAW_DOC}>"
    ).json(source)
    batch = audit_log.first_copies(audit_log.events_from_pages(batch_pages))
    stream = spark.read.parquet(out).select(*batch.columns)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.collect()))
    assert batch.count() == 6
    assert json.loads(batch.first().changes)["instances"] == "i-1"
