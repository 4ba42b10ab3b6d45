"""Inventory sync: landed snapshots -> flat rows -> merged state, attributed history, counters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from contextlib import ExitStack
from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inventrace.functions.text import clip
from inventrace.operators import attribution, report
from inventrace.operators import upsert as merging
from inventrace.plans import audit_log
from inventrace.session import discard, scratch, sized_shuffles
from inventrace.sources.landed import bytes_at, corrupt_lines, list_files, list_raw, read_dataset, read_raw, split_invalid
from inventrace.sources.latest import LatestEvents
from inventrace.sources.manifest import Manifest
from inventrace.sources.state import MOST_CHANGED, MOST_CHANGES, StateStore
from inventrace.specs.model import Raw, ResourceSpec
from inventrace.specs.registry import AUDIT, SPECS, select_services


def flatten(spec: ResourceSpec, raw: Raw, run_ts: Column | None = None) -> DataFrame:
    """Landed documents -> one typed row per resource; rows without an id or a part of their key are left out."""
    return flatten_all(spec, raw, run_ts)[0]


def flatten_all(spec: ResourceSpec, raw: Raw, run_ts: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of :func:`flatten`, the rows it leaves out)."""
    columns = [clip(F.col(c), spec.widths[c]).alias(c) if c in spec.widths else F.col(c) for c in spec.column_names]
    flat = (spec.flatten(raw, run_ts=run_ts) if spec.timed else spec.flatten(raw)).select(*columns)
    return split_invalid(flat, spec.resource_id, key=spec.key)


def diff(spec: ResourceSpec, snapshot: DataFrame, state: DataFrame, run_ts: Column) -> DataFrame:
    """Every differing cell of matched rows, significant or not."""
    return merging.changed_cells(spec, merging.compare(spec, snapshot, state, run_ts))


def attribute(
    spec: ResourceSpec, cells: DataFrame, events: DataFrame, mapping: DataFrame, anchor: Column | str, latest: DataFrame | None = None
) -> DataFrame:
    return attribution.attribute(cells, events, mapping, anchor, latest_first=spec.latest_lookup, latest=latest)


@dataclass
class Result:
    state: DataFrame
    changes: DataFrame
    metrics: DataFrame


def upsert_frames(
    spec: ResourceSpec,
    compared: DataFrame,
    events: DataFrame,
    mapping: DataFrame,
    anchor: Column | str,
    latest: DataFrame | None = None,
) -> Result:
    """State, history and counters, all from one compared frame."""
    cells = merging.significant(merging.changed_cells(spec, compared))
    changes = merging.history_rows(attribute(spec, cells, events, mapping, anchor, latest))
    return Result(merging.new_state(spec, compared), changes, merging.counters(spec, compared))


def upsert(
    spec: ResourceSpec,
    snapshot: DataFrame,
    state: DataFrame,
    run_ts: Column,
    events: DataFrame | None = None,
    mapping: DataFrame | None = None,
    anchor: Column | str | None = None,
) -> Result:
    """New state, attributed history and counters of one snapshot, as lazy frames.

    Each frame repeats the comparison when it is used; :class:`Sync` writes it once instead.
    ``anchor`` is the time changes are attributed around, the run time by default.
    """
    spark = snapshot.sparkSession
    events = events if events is not None else spark.createDataFrame([], audit_log.EVENT_COLUMNS)
    mapping = mapping if mapping is not None else attribution.field_map(spark)
    compared = merging.compare(spec, snapshot, state, run_ts)
    return upsert_frames(spec, compared, events, mapping, run_ts if anchor is None else anchor)


class Sync:
    """One run over a landing folder and a state store.

    ``look_back_days`` bounds the age of audit events that are taken in, and of the landed audit files that a run still picks up; older events
    count as ``rejected`` in the summary. ``keep_versions`` is how many runs of a table can be repeated: their versions and the ones they started from
    stay, older ones are given up after each run.

    ``specs`` are the resource specs by service; :func:`inventrace.specs.limits.limited` gives those with the limits of earlier loaders.

    A run can be repeated: it starts from the version that its first try started from, reads the files that one read, sees the audit events
    that one saw, and so leaves the same state, history and counters. Where that version is not kept any more it raises
    :class:`RunExpired` and changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        store: str,
        run_time: datetime,
        look_back_days: int = audit_log.LOOK_BACK_DAYS,
        keep_versions: int = 2,
        specs: Mapping[str, ResourceSpec] = SPECS,
    ):
        self.specs = specs
        self.look_back_days, self.keep_versions = look_back_days, keep_versions
        self.spark = spark
        self.landing = landing.rstrip("/")
        self.store = StateStore(spark, store)
        self.run_time = run_time
        self.run_id = run_time.strftime("%Y%m%dT%H%M%S")
        self.run_date = run_time.strftime("%Y-%m-%d")
        self.run_ts = F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
        self.mapping = attribution.field_map(spark)

    @property
    def events_path(self) -> str:
        return f"{self.store.root}/cloudtrail_events"

    def look_back_dates(self) -> list[str]:
        return [(self.run_time - timedelta(days=d)).strftime("%Y-%m-%d") for d in range(self.look_back_days, -1, -1)]

    def new_audit_files(self) -> list[str]:
        """Landed audit files of the look-back that no run has taken in yet, however late they came. What is listed is their names."""
        log, dates = self.store.log(AUDIT), self.look_back_dates()
        taken: set[str] = set()
        for run in log.runs():
            if run != self.run_id and run[:8] >= dates[0].replace("-", ""):
                taken.update(log.read(run).inputs)
        return [f for f in list_files(self.spark, f"{self.landing}/{AUDIT}/events", dates) if f not in taken]

    def ingest_audit(self) -> DataFrame:
        """Load landed audit pages that are new to the store; returns the run's counters with the funnel total / important / inserted.

        The pages are parsed once, into a scratch table of all polled events. Broken payloads and cut lines go to quarantine.
        A file counts as taken in with the run's manifest, so a run that failed reads its files again and its events are not stored twice.
        """
        landed, log = f"{self.landing}/{AUDIT}/events", self.store.log(AUDIT)
        known = log.read(self.run_id)
        files = list(known.inputs) if known else self.new_audit_files()
        with sized_shuffles(self.spark, sum(bytes_at(self.spark, f"{landed}/{d}") for d in {f.split("/")[0] for f in files})):
            pages = read_dataset(self.spark, landed, audit_log.RAW_DOC, files=files)
            scratched = scratch(self.spark, "polled")
            polled = audit_log.polled_events(pages)
            polled.write.parquet(scratched)
            polled = self.spark.read.schema(polled.schema).parquet(scratched)
            rejected = self.store.quarantine(audit_log.rejected_events(pages, polled), AUDIT, self.run_id)
            kept = polled.where("important").select("event.*")
            audit_log.append_events(self.spark, kept, self.events_path, self.run_ts, self.look_back_days)
        since = self.run_ts - F.expr(f"INTERVAL {self.look_back_days} DAYS")
        fresh = audit_log.stored_at(self.spark, self.events_path, self.run_ts, self.look_back_days)
        if known is None:
            LatestEvents(self.store).add(fresh, audit_log.read_events(self.spark, self.events_path))
        long = lambda n: F.lit(n).cast("long")
        inserted = fresh.select(long(0).alias("total"), long(0).alias("important"), long(1).alias("inserted"), long(0).alias("rejected"))
        late = F.col("important") & ~F.coalesce((F.col("event.event_time") >= since) & (F.col("event.event_time") <= self.run_ts), F.lit(False))
        funnel = polled.where("NOT broken").select(long(1).alias("total"), F.col("important").cast("long").alias("important"), long(0).alias("inserted"), late.cast("long").alias("rejected"))
        thrown = rejected.select(long(0).alias("total"), long(0).alias("important"), long(0).alias("inserted"), long(1).alias("rejected"))
        names = ("total", "important", "inserted", "rejected")
        got = report.union_all([inserted, funnel, thrown]).agg(*[F.coalesce(F.sum(c), long(0)).alias(c) for c in names]).first().asDict()
        counts = {"processed": got["inserted"], "inserted": got["inserted"], "updated": 0, "matched": 0, "total": got["total"], "important": got["important"], "rejected": got["rejected"]}
        log.start()
        log.commit(Manifest(self.run_id, None, inputs=tuple(files), counts=counts))
        discard(self.spark, scratched)
        return self._metrics(AUDIT, counts)

    def _metrics(self, service: str, counts: Mapping[str, int]) -> DataFrame:
        names = ", ".join(f"{c} long" for c in counts)
        return self.spark.createDataFrame([(service, *counts.values())], f"service string, {names}")

    def events_for(self, as_of: str) -> DataFrame:
        """Events attribution can use: the days around the run, as they were stored up to ``as_of``."""
        events = audit_log.read_events(self.spark, self.events_path, self._day_before())
        return events.where(F.col("created_at") <= F.lit(as_of).cast("timestamp_ntz"))

    def latest_for(self, spec: ResourceSpec, entry: str | None, as_of: str) -> DataFrame | None:
        """Latest events by type, name and event for resources that are attributed without a time bound.

        Without such an entry (a repeated run's may be gone) all events stored up to ``as_of`` stand in for it.
        """
        if not spec.latest_lookup:
            return None
        found = LatestEvents(self.store).read(entry)
        if found is not None:
            return found
        events = audit_log.read_events(self.spark, self.events_path).where(F.col("created_at") <= F.lit(as_of).cast("timestamp_ntz"))
        return events.withColumn("resource_type", F.upper("resource_type"))

    def _day_before(self) -> Column:
        return F.lit((self.run_time - timedelta(days=1)).strftime("%Y-%m-%d")).cast("timestamp_ntz")

    @cached_property
    def events_as_of(self) -> str:
        """When the last of the events around the run was stored; without any, the time of the run."""
        latest = audit_log.read_events(self.spark, self.events_path, self._day_before()).agg(F.max("created_at").cast("string")).first()
        return latest[0] or self.run_time.strftime("%Y-%m-%d %H:%M:%S.%f")

    def input_bytes(self, spec: ResourceSpec) -> int:
        """Landed text of the run plus stored columns, which are about four times larger in memory."""
        landed = bytes_at(self.spark, f"{self.landing}/{spec.service}/*/dt={self.run_date}")
        earlier = [v for v in self.store.versions(spec.table) if v < self.run_id]
        stored = self.store.part_bytes(spec, self.store.log(spec.table).read(earlier[-1])) if earlier else []
        return landed + 4 * sum(stored)

    def sync_resource(self, spec: ResourceSpec, raw: Raw | None = None) -> DataFrame:
        """Merge one resource and append its history; returns its counters.

        The compared frame is written once, as what this run adds to the state, with its control columns.
        History and counters read that, so the join runs once and survives lost executors. The run counts with its manifest, which is committed
        last: a run that failed before can simply be started again.
        """
        store, log = self.store, self.store.log(spec.table)
        store.adopt(spec)
        known, parent = log.read(self.run_id), store.parent_of(spec, self.run_id)
        before = log.read(parent) if parent is not None else None
        files = () if raw is not None else known.inputs if known else tuple(list_raw(self.spark, self.landing, spec, self.run_date))
        as_of = known.events_as_of if known else self.events_as_of
        entry = known.latest_as_of if known else LatestEvents(store).entry()
        added = [c for c in spec.compared if before and c not in replace(spec, columns=before.columns).column_names]
        sizes = store.part_bytes(spec, before)
        with sized_shuffles(self.spark, self.input_bytes(spec)) as wanted:
            pass
        buckets = before.buckets if before and before.buckets else wanted
        whole = not before or not before.buckets or bool(added) or wanted > 2 * buckets
        whole = whole or len(sizes) > MOST_CHANGES or sum(sizes[1:]) > MOST_CHANGED * sizes[0]
        target = wanted if whole else buckets
        with sized_shuffles(self.spark, 0, exactly=buckets), ExitStack() as open_tables:
            raw = raw if raw is not None else read_raw(self.spark, self.landing, spec, files=files)
            snapshot, left_out = flatten_all(spec, raw, self.run_ts)
            cut = [corrupt_lines(p).select(F.lit(n).alias("dataset"), "account_id", "content") for n, p in raw.items() if "_corrupt" in p.columns]
            lost = left_out.select(F.lit("").alias("dataset"), F.col("account_id").cast("string").alias("account_id"), F.to_json(F.struct("*")).alias("content"))
            rejected = store.quarantine(report.union_all([lost, *cut]), spec.service, self.run_id)
            state = open_tables.enter_context(store.clustered(spec, before)) if before and before.buckets else store.read_version(spec, parent)
            compared = merging.compare(spec, snapshot, state, self.run_ts, added=added)
            part, written = store.write_part(spec, compared, self.run_id, target, whole, deal=target != buckets or bool(spec.conflict_key))
            result = upsert_frames(spec, written, self.events_for(as_of), self.mapping, self.run_ts, self.latest_for(spec, entry, as_of))
            store.append_history(result.changes, spec.service_type, self.run_id)
            names = ("processed", "inserted", "updated", "matched")
            got = result.metrics.first()
            counts = {c: (got[c] or 0) if got else 0 for c in names} | {"rejected": rejected.count()}
        parts = (part,) if whole else (*before.parts, part)
        log.commit(Manifest(self.run_id, parent, parts, target, spec.columns, files, counts, as_of, entry))
        repeatable = store.versions(spec.table)[-self.keep_versions :]
        store.expire(spec, self.keep_versions, protected=[log.read(v).parent for v in repeatable])
        return self._metrics(spec.service, counts)

    def run(self, services: Iterable[str] = ("all",), raw: Mapping[str, Raw] | None = None) -> DataFrame:
        """All selected services, audit log first; returns the summary with one row per service."""
        metrics = []
        for service in select_services(services):
            if service == AUDIT:
                metrics.append(self.ingest_audit())
            else:
                metrics.append(self.sync_resource(self.specs[service], (raw or {}).get(service)))
        return report.run_summary(report.union_all(metrics))
