"""Quarantine replay: what a run rejected is read again, each row once per replay, with lineage to the run that rejected it.

Audit events that can be read now go to the event table, pages of a resource back to its landing folder for the next run. What still cannot be
read is rejected anew, under the replay's name. A replay that is repeated reads the same rows and leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.operators import report
from inventrace.plans import audit_log
from inventrace.plans.sync import Sync
from inventrace.session import discard, scratch
from inventrace.sources.landed import ENVELOPE
from inventrace.sources.latest import LatestEvents
from inventrace.sources.manifest import Manifest
from inventrace.specs.registry import AUDIT

Repair = Callable[[Column], Column]


def replay(sync: Sync, service: str, repair: Repair | None = None) -> DataFrame:
    """origin (the run that rejected), dataset, taken, left: what became of the rejected rows of a service that no replay has read yet.

    ``repair`` rewrites the stored text before it is parsed. Rows that lack an id or a part of their key have no page to be read again, and
    events outside the look-back stay rejected; both are left alone. Of a resource, call it before the run of the same date.
    """
    store, log = sync.store, sync.store.log(f"replay_{service}")
    name, known = f"replay-{sync.run_id}", log.read(sync.run_id)
    done = {r for run in log.runs() if run != sync.run_id for r in log.read(run).inputs}
    origins = known.inputs if known else tuple(sorted(r for r in store.rejecting_runs(service) if r not in done and r != name))
    rows = store.rejected().where((F.col("service") == service) & F.col("run_id").isin(list(origins)) & ~F.col("dataset").isin("", "late"))
    rows = rows.select(F.coalesce("origin", "run_id").alias("origin"), "dataset", "account_id", "content", (repair or (lambda c: c))(F.col("content")).alias("text"))
    read = _events(sync, rows) if service == AUDIT else _pages(sync, service, rows)
    folder = scratch(sync.spark, "replay")
    read.write.parquet(folder)
    read = sync.spark.read.schema(read.schema).parquet(folder)
    if service == AUDIT:
        _take_events(sync, read)
    elif known is None:
        _land(sync, service, read)
    store.quarantine(read.where("broken").select("dataset", "account_id", "content", "origin"), service, name)
    event_id = F.col("event.event_id") if service == AUDIT else F.lit(None).cast("string")
    store.write_lineage(read.where("NOT broken").select("origin", "dataset", "account_id", event_id.alias("event_id"), "content"), service, name)
    counts = read.groupBy("origin", "dataset").agg(F.count_if(~F.col("broken")).alias("taken"), F.count_if("broken").alias("left")).collect()
    log.start()
    if known is None:
        log.commit(Manifest(sync.run_id, None, inputs=origins, counts={"taken": sum(r.taken for r in counts), "left": sum(r.left for r in counts)}))
    discard(sync.spark, folder)
    return sync.spark.createDataFrame([tuple(r) for r in counts], "origin string, dataset string, taken long, left long")


def _events(sync: Sync, rows: DataFrame) -> DataFrame:
    """One row per payload: origin, dataset, account_id, content, broken, important, event. A row is a payload, or a page line with several."""
    page = F.from_json("text", f"{ENVELOPE}, doc struct<{audit_log.RAW_DOC}>")
    whole = audit_log.once(rows, page, "page")
    payloads = F.coalesce(F.transform("page.doc.Events", lambda e: e["CloudTrailEvent"]), F.array("text"))
    cut = whole.select(
        "origin", "dataset", "content", F.coalesce("page.account_id", "account_id").alias("account_id"), "page.account_name", "page.region", F.explode(payloads).alias("payload")
    ).where(F.coalesce("payload", F.lit("")) != "")
    parsed = audit_log.detailed(cut).withColumn("broken", F.col("d").isNull() | F.col("d._corrupt").isNotNull())
    parsed = parsed.withColumn("important", ~F.col("broken") & audit_log.is_important(F.col("d.eventName"), F.col("d.eventSource")))
    typed = audit_log.typed_columns(parsed)
    event = F.when(~F.col("broken"), F.col("_event"))
    return typed.select("origin", "dataset", "account_id", "content", "broken", "important", event.alias("event"))


def _take_events(sync: Sync, read: DataFrame) -> None:
    events = read.where("important").select("event.*")
    audit_log.append_events(sync.spark, events, sync.events_path, sync.run_ts, sync.look_back_days)
    fresh = audit_log.stored_at(sync.spark, sync.events_path, sync.run_ts, sync.look_back_days)
    LatestEvents(sync.store).add(fresh, audit_log.read_events(sync.spark, sync.events_path))


def _pages(sync: Sync, service: str, rows: DataFrame) -> DataFrame:
    """The rows with ``broken``: whether the text is still no page of its dataset."""
    parts = []
    for dataset, doc in sync.specs[service].raw.items():
        own = rows.where(F.col("dataset") == dataset)
        page = audit_log.once(own, F.from_json("text", f"{ENVELOPE}, doc struct<{doc}>"), "page")
        parts.append(page.select(*rows.columns, F.col("page.doc").isNull().alias("broken")))
    return report.union_all(parts)


def _land(sync: Sync, service: str, read: DataFrame) -> None:
    for dataset in sync.specs[service].raw:
        lines = read.where((F.col("dataset") == dataset) & ~F.col("broken")).select("text")
        if not lines.isEmpty():
            lines.write.mode("append").text(f"{sync.landing}/{service}/{dataset}/dt={sync.run_date}")
