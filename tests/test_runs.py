"""Repeatable runs: manifests, change folders, what a repeat reads, what a failure leaves."""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from inventrace import SPECS, Sync
from inventrace.operators import upsert
from inventrace.plans import audit_log
from inventrace.sources.landed import bytes_at
from inventrace.sources.latest import LatestEvents, latest_per_key
from inventrace.sources.manifest import Manifest, ManifestLog, RunExpired
from inventrace.sources.state import MOST_CHANGES, StateStore
from tests.fixtures.documents import audit_event

STACKS, DAY = SPECS["cloudformation"], datetime(2024, 1, 1, 12)


def land(root, day, rows, name="a"):
    """rows: stack name -> status."""
    folder = root / "cloudformation" / "stacks" / f"dt={day:%Y-%m-%d}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [{"account_id": "1", "account_name": "p", "region": "r", "doc": {"Stacks": [{"StackName": n, "StackStatus": s, "Description": "".join(hashlib.sha256(f"{n}{k}".encode()).hexdigest() for k in range(4))[:200]}]}} for n, s in rows.items()]
    (folder / f"{name}.json").write_text("\n".join(map(json.dumps, lines)) + "\n")


def land_events(root, day, events, name="a"):
    folder = root / "cloudtrail" / "events" / f"dt={day:%Y-%m-%d}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps({"account_id": "1", "account_name": "p", "region": "r", "doc": {"Events": events}}) + "\n")


def statuses(store):
    return {r.stack_name: r.stack_status for r in store.read(STACKS).collect()}


def history(store):
    return sorted((r.run_id, r.resource_id, r.old_value, r.new_value, r.changed_by) for r in store.history().collect())


@pytest.fixture
def place(tmp_path):
    return tmp_path / "landing", str(tmp_path / "store")


def test_manifest_log(spark, tmp_path):
    log = ManifestLog(spark, str(tmp_path / "log"))
    assert not log.exists() and log.runs() == [] and log.read("a") is None
    log.start()
    assert log.exists()
    log.commit(Manifest("20240101T000000", None, ("p",), 4, "a int", ("x/y",), {"n": 1}))
    again = log.commit(Manifest("20240101T000000", None, ("q",)))
    assert again.tries == 1 and log.read("20240101T000000").parts == ("q",)
    log.commit(Manifest("20240102T000000", "20240101T000000", ("q", "r")))
    log.expire("20240101T000000")
    assert log.runs() == ["20240101T000000", "20240102T000000"] and log.runs(kept_only=True) == ["20240102T000000"]
    assert log.read("20240101T000000").expired and log.read("20240102T000000").parent == "20240101T000000"


def test_two_writers_cannot_commit_the_same_try(spark, tmp_path, monkeypatch):
    log = ManifestLog(spark, str(tmp_path / "log"))
    log.commit(Manifest("1", None, ("a",)))
    monkeypatch.setattr(log, "_latest", lambda: {})  # what a second writer saw before the first committed
    with pytest.raises(RuntimeError):
        log.commit(Manifest("1", None, ("b",)))
    monkeypatch.undo()
    assert log.read("1").parts == ("a",)


def test_a_run_writes_what_changed(spark, place):
    root, path = place
    names = [f"s{k}" for k in range(3000)]
    land(root, DAY, dict.fromkeys(names, "UP"))
    land(root, DAY + timedelta(days=1), dict.fromkeys(names, "UP") | {"s7": "DOWN", "new": "UP"})
    store = StateStore(spark, path)
    for d in (0, 1):
        summary = Sync(spark, str(root), path, DAY + timedelta(days=d)).run(["cloudformation"]).first()
    assert (summary.processed, summary.inserted, summary.updated, summary.matched) == (3001, 1, 1, 3000)
    manifest = store.log("cloudformation").read("20240102T120000")
    base, change = store.part_bytes(STACKS, manifest)
    assert manifest.parent == "20240101T120000" and change < base / 2
    part = spark.read.parquet(f"{path}/state/cloudformation/{manifest.parts[1]}")
    assert {r.stack_name for r in part.where("description IS NOT NULL").collect()} == {"s7", "new"}
    state = store.read(STACKS)
    assert state.count() == 3001 and state.where("length(description) = 200 AND last_updated = '2024-01-02 12:00:00'").count() == 3001
    assert statuses(store)["s7"] == "DOWN" and statuses(store)["s8"] == "UP"


def test_only_the_snapshot_is_shuffled(spark, place):
    root, path = place
    land(root, DAY, {f"s{k}": "UP" for k in range(50)})
    land(root, DAY + timedelta(days=1), {f"s{k}": "X" for k in range(5)})
    for d in (0, 1):
        Sync(spark, str(root), path, DAY + timedelta(days=d)).run(["cloudformation"])
    store = StateStore(spark, path)
    manifest = store.log("cloudformation").read("20240102T120000")
    assert len(manifest.parts) == 2
    with store.clustered(STACKS, manifest) as state:
        compared = upsert.compare(STACKS, state.drop("last_updated"), state, F.lit("2024-01-03").cast("timestamp_ntz"))
        text = compared._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 0 and text.count("Bucketed: true") == 2
        snapshot = spark.createDataFrame(store.read(STACKS).drop("last_updated").collect(), state.drop("last_updated").schema)
        text = upsert.compare(STACKS, snapshot, state, F.lit("2024-01-03").cast("timestamp_ntz"))._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1
        assert sorted(r.stack_status for r in state.collect()).count("X") == 5
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("inventrace_")]


def test_a_whole_copy_alone_is_read_as_it_stands(spark, place, monkeypatch):
    root, path = place
    monkeypatch.setattr("inventrace.plans.sync.MOST_CHANGES", 0)  # every run writes a whole copy
    for d in range(2):
        land(root, DAY + timedelta(days=d), {f"s{k}": "UP" for k in range(9)})
        Sync(spark, str(root), path, DAY + timedelta(days=d)).run(["cloudformation"])
    store = StateStore(spark, path)
    manifest = store.log("cloudformation").read("20240102T120000")
    assert len(manifest.parts) == 1
    with store.clustered(STACKS, manifest) as state:
        assert "Aggregate" not in state._jdf.queryExecution().executedPlan().toString()
        assert sorted(state.collect()) == sorted(store.read(STACKS).select(*state.columns).collect())


def test_changes_are_merged_into_a_whole_copy(spark, place):
    root, path = place
    store, seen = StateStore(spark, path), []
    for d in range(MOST_CHANGES + 3):
        land(root, DAY + timedelta(days=d), {f"s{k}": f"v{d if k == d else 0}" for k in range(40)})
        Sync(spark, str(root), path, DAY + timedelta(days=d), keep_versions=1).run(["cloudformation"])
        seen.append(len(store.log("cloudformation").read(f"{DAY + timedelta(days=d):%Y%m%dT%H%M%S}").parts))
    assert seen[0] == 1 and max(seen) <= MOST_CHANGES + 1 and 1 in seen[1:]
    assert statuses(store) == {f"s{k}": f"v{MOST_CHANGES + 2 if k == MOST_CHANGES + 2 else 0}" for k in range(40)}
    needed = {p for v in store.versions("cloudformation") for p in store.log("cloudformation").read(v).parts}
    assert {p.name for p in (place[0].parent / "store" / "state" / "cloudformation").iterdir()} == needed


@pytest.mark.parametrize("keep", [1, 2])
def test_repeats_leave_state_and_history(spark, place, keep):
    root, path = place
    days = [DAY + timedelta(days=d) for d in range(3)]
    for d, day in enumerate(days):
        land(root, day, {"carried": "UP"} if d == 0 else {})
        land(root, day, {"a": f"v{d}", f"only{d}": "UP"}, "b")
    store, counts = StateStore(spark, path), {}
    for day in days:
        counts[day] = Sync(spark, str(root), path, day, keep_versions=keep).run(["cloudformation"]).collect()
    state, rows = statuses(store), history(store)
    assert state == {"a": "v2", "carried": "UP", "only0": "UP", "only1": "UP", "only2": "UP"} and len(rows) == 2
    for d, day in enumerate(days):
        again = Sync(spark, str(root), path, day, keep_versions=keep)
        if keep == 1 and d == 1:
            with pytest.raises(RunExpired):
                again.run(["cloudformation"])
        else:
            assert again.run(["cloudformation"]).collect() == counts[day]
        assert statuses(store) == state and history(store) == rows
    if keep == 1:
        with pytest.raises(RunExpired):  # a new run before all kept versions, which are no first ones
            store.parent_of(STACKS, "20231201T000000")


def test_a_repeat_reads_the_files_of_the_first_try(spark, place):
    root, path = place
    land(root, DAY, {"a": "UP"})
    first = Sync(spark, str(root), path, DAY).run(["cloudformation"]).collect()
    land(root, DAY, {"b": "UP"}, "later")
    assert Sync(spark, str(root), path, DAY).run(["cloudformation"]).collect() == first
    assert statuses(StateStore(spark, path)) == {"a": "UP"}
    Sync(spark, str(root), path, DAY + timedelta(hours=6)).run(["cloudformation"])
    assert statuses(StateStore(spark, path)) == {"a": "UP", "b": "UP"}


def test_a_repeat_sees_the_events_of_the_first_try(spark, place):
    root, path = place
    day = DAY + timedelta(days=1)
    land(root, DAY, {"a": "UP"})
    land(root, day, {"a": "DOWN"})
    event = lambda n, user, at: audit_event(n, "UpdateStack", "cloudformation.amazonaws.com", at, {"stackName": "a"}, user=user)
    land_events(root, day, [event("1", "ann", "2024-01-02T10:00:00Z")])
    services = ["cloudtrail", "cloudformation"]
    Sync(spark, str(root), path, DAY).run(["cloudformation"])
    Sync(spark, str(root), path, day).run(services)
    rows = history(StateStore(spark, path))
    assert [r[-1] for r in rows] == ["ann"]
    land_events(root, day, [event("2", "bob", "2024-01-02T11:59:00Z")], "late")
    Sync(spark, str(root), path, day + timedelta(days=1)).run(["cloudtrail"])
    assert audit_log.read_events(spark, f"{path}/cloudtrail_events").count() == 2
    Sync(spark, str(root), path, day).run(services)
    assert history(StateStore(spark, path)) == rows


def test_a_run_that_failed_before_its_manifest_starts_again(spark, place, monkeypatch):
    root, path = place
    days = [DAY, DAY + timedelta(days=1)]
    land(root, days[0], {"a": "UP", "gone": "UP"})
    land(root, days[1], {"a": "DOWN"})
    Sync(spark, str(root), path, days[0]).run(["cloudformation"])
    broken = Sync(spark, str(root), path, days[1])
    monkeypatch.setattr(broken.store, "append_history", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        broken.run(["cloudformation"])
    store = StateStore(spark, path)
    assert statuses(store) == {"a": "UP", "gone": "UP"} and store.versions("cloudformation") == ["20240101T120000"]
    summary = Sync(spark, str(root), path, days[1]).run(["cloudformation"]).first()
    assert (summary.updated, summary.matched) == (1, 1)
    assert statuses(store) == {"a": "DOWN", "gone": "UP"} and len(history(store)) == 1
    assert len(list((place[0].parent / "store" / "state" / "cloudformation").iterdir())) == 2  # the failed try's folder is gone


def test_versions_without_manifest_are_taken_over(spark, place):
    root, path = place
    store = StateStore(spark, path)
    old = spark.createDataFrame([("a", "1", "r", "UP"), ("kept", "1", "r", "UP")], "stack_name string, account_id string, region string, stack_status string")
    empty = store.read(STACKS)
    missing = [F.lit(None).cast(t).alias(c) for c, t in empty.drop("last_updated").dtypes if c not in old.columns]
    snapshot = old.select("*", *missing).select(*STACKS.column_names)
    store.write(STACKS, upsert.compare(STACKS, snapshot, empty, F.lit("2024-01-01").cast("timestamp_ntz")), "20240101T000000")
    land(root, DAY, {"a": "DOWN"})
    Sync(spark, str(root), path, DAY).run(["cloudformation"])
    assert statuses(store) == {"a": "DOWN", "kept": "UP"} and store.versions("cloudformation") == ["20240101T000000", "20240101T120000"]
    with pytest.raises(RunExpired):
        store.parent_of(STACKS, "20240101T000000")


def test_new_column_is_no_change(spark, place):
    root, path = place
    land(root, DAY, {"a": "UP", "carried": "UP"})
    land(root, DAY + timedelta(days=1), {"a": "UP"})
    Sync(spark, str(root), path, DAY).sync_resource(STACKS)
    wider = replace(STACKS, columns=f"{STACKS.columns}, note string", flatten=lambda raw: STACKS.flatten(raw).withColumn("note", F.lit("n")))
    got = Sync(spark, str(root), path, DAY + timedelta(days=1)).sync_resource(wider).first()
    store = StateStore(spark, path)
    assert (got.updated, got.matched) == (0, 1) and store.history().count() == 0
    assert {r.stack_name: r.note for r in store.read(wider).collect()} == {"a": "n", "carried": None}
    assert bytes_at(spark, f"{path}/manifests/cloudformation") > 0


def test_latest_events_are_those_of_all_days(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("inventrace.sources.latest.MOST_PARTS", 2)
    monkeypatch.setattr("inventrace.sources.latest.KEPT_ENTRIES", 2)
    schema = "resource_type string, resource_name string, event_name string, event_time timestamp_ntz, event_id string, user_name string"
    table = LatestEvents(StateStore(spark, str(tmp_path)))
    assert table.entry() is None and table.read(None) is None
    rows, entries = [], []
    for n in range(6):
        new = [("ec2", f"i{(n + k) % 4}", "Stop", datetime(2024, 1, 1 + (n * 5 + k) % 7), f"{n}{k}", f"u{n}{k}") for k in range(3)]
        rows += new
        entries.append(table.add(spark.createDataFrame(new, schema), spark.createDataFrame(rows, schema)))
    want = {r.resource_name: r.user_name for r in latest_per_key(spark.createDataFrame(rows, schema)).collect()}
    got = latest_per_key(table.read(table.entry())).collect()
    assert {r.resource_name: r.user_name for r in got} == want and {r.resource_type for r in got} == {"EC2"}
    assert table.read(entries[0]) is None and table.read(entries[-2]) is not None


def test_no_column_is_cut_by_default(spark, place):
    from inventrace.specs.limits import LENGTHS, WIDTHS, limited

    root, path = place
    for d, end in enumerate("ab"):
        folder = root / "cloudformation" / "stacks" / f"dt={DAY + timedelta(days=d):%Y-%m-%d}"
        folder.mkdir(parents=True)
        doc = {"Stacks": [{"StackName": "s", "StackStatus": "UP", "Description": "x" * 600 + end}]}
        (folder / "a.json").write_text(json.dumps({"account_id": "1", "account_name": "p", "region": "r", "doc": doc}) + "\n")
    for name, specs, changes in (("whole", SPECS, 1), ("cut", {s: limited(x) for s, x in SPECS.items()}, 0)):
        for d in (0, 1):
            Sync(spark, str(root), f"{path}-{name}", DAY + timedelta(days=d), specs=specs).run(["cloudformation"])
        assert StateStore(spark, f"{path}-{name}").history().count() == changes
    assert all(set(w) <= set(SPECS[s].column_names) for s, w in WIDTHS.items()) and set(LENGTHS) <= set(SPECS)


def test_replayed_pages_are_read_by_the_next_run(spark, place):
    from inventrace import replay

    root, path = place
    land(root, DAY, {"a": "UP"})
    folder = root / "cloudformation" / "stacks" / f"dt={DAY:%Y-%m-%d}"
    good = json.dumps({"account_id": "1", "account_name": "p", "region": "r", "doc": {"Stacks": [{"StackName": "b", "StackStatus": "UP"}]}})
    (folder / "cut.json").write_text(good[:-2] + "\n" + "nonsense\n")
    Sync(spark, str(root), path, DAY).run(["cloudformation"])
    store, later = StateStore(spark, path), Sync(spark, str(root), path, DAY + timedelta(days=1))
    assert statuses(store) == {"a": "UP"}
    for _ in range(2):
        got = replay(later, "cloudformation", lambda c: F.concat(c, F.lit("}}"))).collect()
        assert [(r.origin, r.dataset, r.taken, r.left) for r in got] == [("20240101T120000", "stacks", 1, 1)]
    later.run(["cloudformation"])
    assert statuses(store) == {"a": "UP", "b": "UP"}
    assert [(r.run_id, r.origin) for r in store.replayed().collect()] == [("replay-20240102T120000", "20240101T120000")]
    again = replay(Sync(spark, str(root), path, DAY + timedelta(days=2)), "cloudformation").collect()
    assert [(r.origin, r.taken, r.left) for r in again] == [("20240101T120000", 0, 1)]
