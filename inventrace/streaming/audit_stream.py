"""Continuous audit ingest: typed events, each event id once, events up to ten days late.

:func:`ingest` writes into the event table of the batch side, whose ids it sees; :func:`stream_events` with :func:`start` is the form
for a table that only the stream writes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from inventrace.plans.audit_log import LOOK_BACK_DAYS, RAW_DOC, append_events, event_texts, first_copies, important, parse_events, polled_events, read_events, rejected_events, stored_layout, typed_events
from inventrace.session import discard, scratch
from inventrace.sources.landed import ENVELOPE
from inventrace.sources.latest import LatestEvents
from inventrace.sources.state import StateStore
from inventrace.specs.registry import AUDIT

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def once_per_id(events: DataFrame, ts: str = "event_time", key: str = "event_id", days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Drop repeats of an id within the watermark. The watermark column must be TIMESTAMP, not NTZ."""
    timed = events.withColumn("_event_ts", F.col(ts).cast("timestamp"))
    unique = timed.withWatermark("_event_ts", f"{days} days").dropDuplicatesWithinWatermark([key])
    return unique.drop("_event_ts")


def read_pages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed audit pages as a stream of files."""
    reader = spark.readStream.schema(f"{ENVELOPE}, doc struct<{RAW_DOC}>, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_events(pages: DataFrame) -> DataFrame:
    parsed = parse_events(event_texts(pages))
    parsed = parsed.withColumns({"event_name": F.col("d.eventName"), "event_source": F.col("d.eventSource")})
    events = typed_events(important(parsed, "event_name", "event_source").drop("event_name", "event_source"))
    return stored_layout(once_per_id(events), F.current_timestamp().cast("timestamp_ntz"))


def start(events: DataFrame, path: str, checkpoint: str, partition_by: str | None = "event_date") -> StreamingQuery:
    """Write everything available, then stop. Progress and ids are kept in ``checkpoint``.

    The default layout is that of the event table, which :func:`inventrace.plans.audit_log.read_events` reads.

    The ids of ten days do not fit on the heap of a large deployment, so state goes to RocksDB unless
    the session names another provider.
    """
    spark = events.sparkSession
    provider = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBacked" in spark.conf.get(provider, "HDFSBacked"):
        spark.conf.set(provider, ROCKSDB)
    writer = events.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(availableNow=True).start(path)


def ingest(pages: DataFrame, store: StateStore, checkpoint: str, days: int = LOOK_BACK_DAYS, now: Callable[[], datetime] | None = None) -> StreamingQuery:
    """Take everything available into the store's event table, then stop.

    Each micro-batch is parsed once. Its events are added unless their id is stored already, by batch or stream; broken payloads, cut lines and
    events outside the look-back go to quarantine, under the stream's checkpoint and batch number. A micro-batch that is run again adds and replaces the same
    rows. ``now`` gives the time that batches are stored at (the clock by default, in UTC).
    """
    clock = now or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))
    path, name = f"{store.root}/cloudtrail_events", checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def take_in(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        at = F.lit(clock().strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
        folder = scratch(spark, "polled")
        polled = polled_events(batch)
        polled.write.parquet(folder)
        polled = spark.read.schema(polled.schema).parquet(folder)
        events = polled.where("important").select("event.*")
        inside = F.coalesce(F.col("event_time").between(at - F.expr(f"INTERVAL {days} DAYS"), at), F.lit(False))
        late = events.where(~inside).select(F.lit("late").alias("dataset"), "account_id", F.to_json(F.struct("*")).alias("content"))
        store.quarantine(rejected_events(batch, polled).unionByName(late), AUDIT, f"{name}-{batch_id:09d}")
        append_events(spark, events, path, at, days)
        LatestEvents(store).add(first_copies(events.where(inside)), read_events(spark, path))
        discard(spark, folder)

    return pages.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
