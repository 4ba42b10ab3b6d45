"""The latest event of every (resource type, resource name, event name), kept up to date by ingest.

Attribution of resources without a time bound reads this instead of all days ever stored. Each ingest adds a folder with the latest of its own events per
key; after some of them the folders are merged into one. Adding the same events twice changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inventrace.sources.manifest import Manifest, hadoop_path
from inventrace.sources.state import StateStore

KEY = ["resource_type", "resource_name", "event_name"]
COLUMNS = "resource_type string, resource_name string, event_name string, event_time timestamp_ntz, event_id string, user_name string"
#: Folders until they are merged, and entries whose folders stay readable.
MOST_PARTS, KEPT_ENTRIES = 8, 24


def latest_per_key(events: DataFrame) -> DataFrame:
    """The latest event of each key (of equally late ones the greatest id), combined before the shuffle."""
    last = F.max(F.struct("event_time", "event_id", "user_name")).alias("_last")
    return events.groupBy(*KEY).agg(last).select(*KEY, "_last.*")


class LatestEvents:
    def __init__(self, store: StateStore):
        self.spark, self.folder = store.spark, f"{store.root}/latest_events"
        self.log = store.log("latest_events")

    def entry(self) -> str | None:
        """The newest entry: what a run that starts now sees."""
        return max(self.log.runs(kept_only=True), default=None)

    def read(self, entry: str | None) -> DataFrame | None:
        """Latest events as of an entry; a key may have several rows, of which the latest counts. None where there is no such entry any more."""
        found = self.log.read(entry) if entry else None
        if found is None or found.expired:
            return None
        return self.spark.read.schema(COLUMNS).parquet(*[f"{self.folder}/{p}" for p in found.parts])

    def add(self, events: DataFrame, stored: DataFrame) -> str:
        """Take in events that were stored just now, at the first time all that are ``stored``; returns the new entry."""
        before = self.entry()
        events = events if before else stored
        parts = self.log.read(before).parts if before else ()
        rows = latest_per_key(events.select(F.upper("resource_type").alias("resource_type"), *[c for c in KEY[1:]], "event_time", F.col("event_id").cast("string").alias("event_id"), "user_name"))
        if len(parts) >= MOST_PARTS:
            rows, parts = latest_per_key(self.read(before).unionByName(rows)), ()
        part = uuid.uuid4().hex
        rows.write.parquet(f"{self.folder}/{part}")
        self.log.start()
        entry = f"{int(before or 0) + 1:012d}"
        self.log.commit(Manifest(entry, before, (*parts, part)))
        self._expire()
        return entry

    def _expire(self) -> None:
        kept = self.log.runs(kept_only=True)
        for entry in kept[:-KEPT_ENTRIES]:
            self.log.expire(entry)
        if len(kept) <= KEPT_ENTRIES:
            return
        needed = {p for e in kept[-KEPT_ENTRIES:] for p in self.log.read(e).parts}
        target, fs = hadoop_path(self.spark, self.folder)
        for status in fs.listStatus(target):
            if status.getPath().getName() not in needed:
                fs.delete(status.getPath(), True)
