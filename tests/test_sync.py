"""End to end: landed files of two days -> state, history, counters; flatten of every service."""

from __future__ import annotations

import copy
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from inventrace import SPECS, Sync, flatten, select_services
from inventrace.sources.landed import read_raw
from inventrace.sources.state import merge_statement
from tests.fixtures.documents import DOCS, EXPECTED, audit_event, land

DAY1, DAY2 = datetime(2024, 1, 15, 12), datetime(2024, 1, 16, 12)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    land(root, "2024-01-15", DOCS)
    changed = copy.deepcopy(DOCS)
    instance = changed["ec2"]["instances"][0]["Reservations"][0]["Instances"][0]
    instance["State"]["Name"] = "stopped"
    instance["SecurityGroups"].reverse()
    changed["ec2"]["instances"][0]["Reservations"][0]["Instances"].pop()
    changed["codebuild"]["projects"][0]["projects"][0]["source"]["type"] = "S3"
    changed["cloudfront"]["details"][0]["Distribution"]["DistributionConfig"]["Comment"] = "new"
    changed["sns"]["topics"][0]["Topics"].append({"TopicArn": "arn:aws:sns:r:1:t2"})
    changed["route53"]["records"][0]["ResourceRecordSets"][0]["ResourceRecords"][0]["Value"] = "2.2.2.2"
    land(root, "2024-01-16", changed)
    stop = {"instancesSet": {"items": [{"instanceId": "i-1"}]}}
    first = [
        audit_event("1", "StartInstances", "ec2.amazonaws.com", "2024-01-15T10:00:00Z", stop),
        audit_event("1", "StartInstances", "ec2.amazonaws.com", "2024-01-15T10:00:00Z", stop),
        audit_event("2", "DescribeInstances", "ec2.amazonaws.com", "2024-01-15T10:00:00Z", None),
        audit_event("3", "CreateBucket", "s3.amazonaws.com", "2023-12-01T10:00:00Z", {"bucketName": "old"}),
        {"CloudTrailEvent": "{broken"}, {"CloudTrailEvent": None}, {"CloudTrailEvent": "[]"},
    ]
    second = [
        first[0],
        audit_event("4", "StopInstances", "ec2.amazonaws.com", "2024-01-16T11:00:00Z", stop, user="bob"),
        audit_event("5", "UpdateAddon", "eks.amazonaws.com", "2024-01-16T11:00:00Z", None),
    ]
    land(root, "2024-01-15", {"cloudtrail": {"events": [{"Events": first}]}})
    land(root, "2024-01-16", {"cloudtrail": {"events": [{"Events": second}]}})
    return root


@pytest.mark.parametrize("service", list(SPECS))
def test_flatten_of_landed_files(spark, landing, service):
    spec = SPECS[service]
    rows = flatten(spec, read_raw(spark, str(landing), spec, "2024-01-15")).collect()
    rows = sorted(rows, key=lambda r: r[spec.resource_id])
    assert len(rows) == len(EXPECTED[service])
    for row, want in zip(rows, EXPECTED[service]):
        got = row.asDict()
        assert {k: got[k] for k in want} == want
        assert (got["account_id"], got["account_name"]) == ("111", "prod")


def test_two_runs(spark, landing, tmp_path):
    store = str(tmp_path / "store")
    services = ["cloudtrail", "ec2", "codebuild", "cloudfront", "sns", "route53"]
    one = {r.service: r for r in Sync(spark, str(landing), store, DAY1).run(services).collect()}
    assert (one["cloudtrail"].inserted, one["ec2"].inserted, one["ec2"].updated) == (1, 2, 0)
    assert one["ec2"].message == "EC2: 2 nuevos"

    sync = Sync(spark, str(landing), store, DAY2)
    two = {r.service: r for r in sync.run(services).collect()}
    assert (two["cloudtrail"].inserted, two["cloudtrail"].status) == (2, "2 nuevos")
    assert (two["ec2"].inserted, two["ec2"].updated, two["ec2"].matched) == (0, 1, 1)
    assert (two["sns"].inserted, two["sns"].updated, two["sns"].message) == (1, 0, "SNS: 1 nuevos")
    assert two["codebuild"].message == "CODEBUILD: 1 actualizados"

    history = {
        (h.service_type, h.resource_id, h.field_name): (h.old_value, h.new_value, h.changed_by, h.region)
        for h in sync.store.history().collect()
    }
    # The record value is a field whose changes are never significant; reordered groups are no change at all.
    assert history == {
        ("EC2", "i-1", "state"): ("running", "stopped", "bob", "us-east-1"),
        ("CODEBUILD", "pr", "source_provider"): ("GITHUB", "S3", "unknown", "us-east-1"),
        ("CLOUDFRONT", "E1", "comment"): ("", "new", "unknown", "us-east-1"),
    }
    state = {r.instance_id: r for r in sync.store.read(SPECS["ec2"]).collect()}
    assert state["i-1"].state == "stopped" and state["i-1"].security_groups == ["web", "db"]
    assert state["i-1"].last_updated == DAY2 and state["i-2"].last_updated == DAY1
    record = sync.store.read(SPECS["route53"]).where(F.col("ttl") == "60").first()
    assert record.record_value == "2.2.2.2"

    # The same run again: same state, same history, events ignored.
    again = {r.service: r for r in Sync(spark, str(landing), store, DAY2).run(services).collect()}
    assert (again["ec2"].inserted, again["ec2"].updated) == (0, 1)
    assert sync.store.history().count() == 3
    events = spark.read.parquet(sync.events_path)
    assert sorted(r.event_id for r in events.select("event_id").collect()) == ["1", "4", "5"]
    assert {r.resource_name for r in events.collect()} == {"i-1", "updateaddon"}


def test_unchanged_snapshot_is_idempotent(spark, landing, tmp_path):
    store = str(tmp_path / "store")
    Sync(spark, str(landing), store, DAY1).run(["s3", "glue", "kms", "eks", "ssm"]).collect()
    later = Sync(spark, str(landing), store, datetime(2024, 1, 15, 18))
    for r in later.run(["s3", "glue", "kms", "eks", "ssm"]).collect():
        assert (r.inserted, r.updated, r.status) == (0, 0, "0 cambios")
        assert r.matched == r.processed > 0
    assert later.store.history().count() == 0
    assert later.store.expire(SPECS["s3"], keep=1) == ["20240115T120000"]
    assert later.store.versions("s3") == ["20240115T180000"] and later.store.read(SPECS["s3"]).count() == 1


def test_service_selection():
    chosen = select_services(["all"])
    assert chosen[0] == "cloudtrail" and len(chosen) == 26
    assert select_services(["s3", "ec2"]) == ["ec2", "s3"]
    with pytest.raises(ValueError):
        select_services(["nope"])


def test_merge_statement_uses_the_whole_key():
    sql = merge_statement(SPECS["lambda"], "t1", "s1")
    assert "t.function_name = s.function_name AND t.account_id = s.account_id AND t.region = s.region" in sql


def test_shuffle_size_follows_the_input(spark, landing, tmp_path):
    from inventrace.session import sized_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    sync = Sync(spark, str(landing), str(tmp_path / "empty"), DAY1)
    assert sync.input_bytes(SPECS["ec2"]) > 0
    for size, partitions in ((1000, 4), (10**12, 7451), (10**14, 745_059), (0, 4)):
        with sized_shuffles(spark, size) as n:
            assert n == partitions == int(spark.conf.get(key))
        assert spark.conf.get(key, None) == before
