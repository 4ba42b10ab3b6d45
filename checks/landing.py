"""End-to-end runs: pages built from the given tables are landed as files, and two syncs run over them."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import inventrace
from checks.base import check, run_ts, table, text
from checks.inventory import cat, lit, mixed_zones, obj
from checks.state import ORDERS, ORDERS_SQL, order_snapshot, order_state
from inventrace import session
from inventrace.plans.replay import replay
from inventrace.plans.sync import Sync
from inventrace.sources.manifest import RunExpired
from inventrace.sources.state import StateStore
from inventrace.specs.registry import SPECS
from inventrace.streaming import audit_stream
from inventrace.plans import audit_log
from checks.audit import AUDIT_SQL, as_audit, pages, payload

DAYS = (datetime(2024, 1, 14, 12), datetime(2024, 1, 15, 12))

#: Orders as stacks: the first day lacks keys that end in 9, the second those that end in 0 and changes each seventh.
#: One key in fifty is landed without an account.
STACKS_SQL = """
stacks AS (SELECT o_orderkey AS k, 'st-' || o_orderkey || repeat('x', 300) AS stack_name, 'a' || (o_orderkey % 25) AS account_id,
  CASE o_orderkey % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'eu-west-1' ELSE 'sa-east-1' END AS region,
  'S_' || o_orderstatus AS old_status, CASE WHEN o_orderkey % 7 = 0 THEN 'S_X' ELSE 'S_' || o_orderstatus END AS new_status,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS creation_time, o_orderkey % 10 < 9 AS one, o_orderkey % 10 > 0 AS two, o_orderkey % 50 = 1 AS lost
  FROM orders)
"""


def _land(rows: DataFrame, line: Column, path: str) -> None:
    rows.select(line.alias("value")).write.text(path)


def _page(account: Column, region: Column, doc: Column, page: Column | None = None) -> Column:
    return F.to_json(obj(account_id=account, account_name=F.concat(F.lit("acct "), account), region=region, page=page if page is not None else lit(0), doc=doc))


def landed_runs(spark: SparkSession, sf: str, services: list[str]) -> tuple[StateStore, DataFrame]:
    """The store after both runs, and the summary of the second one."""
    root = session.scratch(spark, "landing")
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    region = F.when(key % 3 == 0, lit("us-east-1")).when(key % 3 == 1, lit("eu-west-1")).otherwise(lit("sa-east-1"))
    account = F.when(key % 50 != 1, cat("a", key % 25))
    for day, kept in zip(DAYS, (key % 10 < 9, key % 10 > 0), strict=True):
        changed = (key % 7 == 0) & F.lit(day == DAYS[1])
        stack = obj(
            StackName=F.concat(cat("st-", key), F.repeat(lit("x"), F.lit(300))),
            StackStatus=F.when(changed, lit("S_X")).otherwise(cat("S_", F.col("o_orderstatus"))),
            CreationTime=mixed_zones(F.col("o_orderdate"), key),
        )
        path = f"{root}/cloudformation/stacks/dt={day:%Y-%m-%d}"
        _land(orders.where(kept), _page(account, region, obj(Stacks=F.array(stack))), path)
        if day == DAYS[1]:  # lines that were cut off
            cut = table(spark, sf, "nation").select(F.lit('{"account_id": "a1", "doc": {"Stacks": [').alias("value"))
            cut.write.mode("append").text(path)
        customers, cust = table(spark, sf, "customer"), F.col("c_custkey")
        name, scope = cat("k-", cust), (cat("a", cust % 25), lit("us-east-1"))
        meta = obj(KeyId=name, KeyManager=lit("CUSTOMER"), KeyState=lit("Enabled"))
        _land(customers, _page(*scope, obj(KeyMetadata=meta)), f"{root}/kms/keys/dt={day:%Y-%m-%d}")
        twice = customers.withColumn("page", F.explode(F.array(F.lit(2), F.lit(1))))
        alias = obj(KeyId=name, Aliases=F.array(obj(AliasName=F.concat(lit("alias/"), F.when(F.col("page") == 1, lit("z")).otherwise(lit("a")), text("c_custkey")))))
        _land(twice, _page(*scope, alias, F.col("page")), f"{root}/kms/aliases/dt={day:%Y-%m-%d}")
        _land(customers, _page(*scope, obj(KeyId=name)), f"{root}/kms/tags/dt={day:%Y-%m-%d}")
    store = f"{root}/store"
    for day in DAYS:
        summary = Sync(spark, root, store, day).run(services)
    return StateStore(spark, store), summary


@check(
    "sync_state",
    f"""WITH {STACKS_SQL}
    SELECT stack_name, account_id, region, CASE WHEN two THEN new_status ELSE old_status END AS stack_status, creation_time,
      CASE WHEN two THEN '2024-01-15 12:00:00' ELSE '2024-01-14 12:00:00' END AS last_updated FROM stacks WHERE NOT lost AND (one OR two)""",
)
def sync_state(spark: SparkSession, sf: str) -> DataFrame:
    """State after two runs: names beyond 255 characters stay whole, times with and without a zone are one moment."""
    store, _ = landed_runs(spark, sf, ["cloudformation"])
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("creation_time", "last_updated")}
    return store.read(SPECS["cloudformation"]).withColumns(times).select("stack_name", "account_id", "region", "stack_status", *times)


@check(
    "sync_pages",
    "SELECT 'k-' || c_custkey AS key_id, 'alias/z' || c_custkey || ', alias/a' || c_custkey AS key_name FROM customer",
)
def sync_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A detail that comes in two pages is one list, in page order, and its resource one row."""
    store, _ = landed_runs(spark, sf, ["kms"])
    return store.read(SPECS["kms"]).select("key_id", "key_name")


@check(
    "sync_history",
    f"""WITH {STACKS_SQL}
    SELECT 'CLOUDFORMATION' AS service_type, '20240115T120000' AS run_id, stack_name AS resource_id, 'stack_status' AS field_name, old_status AS old_value,
      new_status AS new_value, 'unknown' AS changed_by, account_id, region FROM stacks WHERE NOT lost AND one AND two AND old_status <> new_status""",
)
def sync_history(spark: SparkSession, sf: str) -> DataFrame:
    store, _ = landed_runs(spark, sf, ["cloudformation"])
    names = ("service_type", "run_id", "resource_id", "field_name", "old_value", "new_value", "changed_by", "account_id", "region")
    return store.history().select(*names)


@check(
    "sync_summary",
    f"""WITH {STACKS_SQL},
    c AS (SELECT 'cloudformation' AS service, count(*) FILTER (two AND NOT lost) AS processed, count(*) FILTER (two AND NOT one AND NOT lost) AS inserted,
      count(*) FILTER (two AND one AND NOT lost AND old_status <> new_status) AS updated, count(*) FILTER (two AND one AND NOT lost) AS matched,
      count(*) FILTER (two AND lost) + (SELECT count(*) FROM nation) AS rejected FROM stacks
      UNION ALL SELECT 'kms', count(*), 0, 0, count(*), 0 FROM customer)
    SELECT service, processed, inserted, updated, matched, rejected FROM c""",
)
def sync_summary(spark: SparkSession, sf: str) -> DataFrame:
    _, summary = landed_runs(spark, sf, ["cloudformation", "kms"])
    return summary.select("service", "processed", "inserted", "updated", "matched", "rejected")


@check(
    "sync_quarantine",
    f"""WITH {STACKS_SQL}
    SELECT 'cloudformation' AS service, '20240114T120000' AS run_id, '' AS dataset, count(*) AS n FROM stacks WHERE one AND lost
    UNION ALL SELECT 'cloudformation', '20240115T120000', '', count(*) FROM stacks WHERE two AND lost
    UNION ALL SELECT 'cloudformation', '20240115T120000', 'stacks', count(*) FROM nation""",
)
def sync_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a part of their key and lines that were cut off are kept aside."""
    store, _ = landed_runs(spark, sf, ["cloudformation"])
    return store.rejected().groupBy("service", "run_id", "dataset").agg(F.count(F.lit(1)).alias("n"))


@check(
    "history_retry_empty",
    "SELECT CAST(c_custkey AS VARCHAR) AS resource_id FROM customer",
)
def history_retry_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A run that is repeated without changes leaves no history of the first try; another run's stays."""
    store = StateStore(spark, session.scratch(spark, "history"))
    columns = ("service_type", "field_name", "old_value", "new_value", "changed_by", "account_id", "region")
    rows = table(spark, sf, "customer").select(text("c_custkey").alias("resource_id"), *[F.lit(c).alias(c) for c in columns])
    store.append_history(rows, "CUSTOMER", "run1")
    store.append_history(rows, "CUSTOMER", "run2")
    store.append_history(rows.where("1 = 0"), "CUSTOMER", "run2")
    return store.history().select("resource_id")


#: Customers as topics (key, display name) on three days: a sixth is not there on each day, and some names change from day to day.
RUNS = (datetime(2024, 1, 13, 12), datetime(2024, 1, 14, 12), datetime(2024, 1, 15, 12))
TOPICS_SQL = """
days AS (SELECT unnest([0, 1, 2]) AS d),
topics AS (SELECT d, 'stack-' || c_custkey AS stack_name, 'a' || (c_custkey % 25) AS account_id,
  CASE WHEN c_custkey % 10 < 3 THEN c_mktsegment || d ELSE c_mktsegment END AS status FROM customer, days WHERE c_custkey % 6 <> d),
seen AS (SELECT *, lag(status) OVER k AS before, max(d) OVER (PARTITION BY stack_name) AS last FROM topics WINDOW k AS (PARTITION BY stack_name ORDER BY d))
"""


def land_topics(spark: SparkSession, sf: str, root: str) -> None:
    """Customers as stacks, one landed folder a day; see TOPICS_SQL."""
    key = F.col("c_custkey")
    for d, day in enumerate(RUNS):
        status = F.when(key % 10 < 3, F.concat(F.col("c_mktsegment"), lit(str(d)))).otherwise(F.col("c_mktsegment"))
        stack = obj(StackName=cat("stack-", key), StackStatus=status)
        _land(table(spark, sf, "customer").where(key % 6 != d), _page(cat("a", key % 25), lit("r1"), obj(Stacks=F.array(stack))), f"{root}/cloudformation/stacks/dt={day:%Y-%m-%d}")


def topic_rows(store: StateStore) -> DataFrame:
    """State and history of the stacks as one list of texts."""
    state = store.read(SPECS["cloudformation"]).select(lit("state").alias("kind"), "stack_name", F.date_format("last_updated", "yyyy-MM-dd").alias("at"), lit("").alias("old_value"), F.col("stack_status").alias("value"))
    history = store.history().select(lit("history").alias("kind"), F.col("resource_id").alias("stack_name"), F.col("run_id").alias("at"), "old_value", F.col("new_value").alias("value"))
    return state.unionByName(history)


_TOPIC_ROWS = """
  SELECT 'state' AS kind, stack_name, strftime(DATE '2024-01-13' + CAST(d AS INTEGER), '%Y-%m-%d') AS at, '' AS old_value, status AS value FROM seen WHERE d = last
  UNION ALL SELECT 'history', stack_name, strftime(DATE '2024-01-13' + CAST(d AS INTEGER), '%Y%m%dT120000'), before, status FROM seen WHERE before <> status
"""


@check(
    "sync_retry",
    f"""WITH {TOPICS_SQL}, r AS ({_TOPIC_ROWS})
    SELECT k.keep, r.*, k.refused FROM r, (SELECT 1 AS keep, 1 AS refused UNION ALL SELECT 2, 0) AS k""",
)
def sync_retry(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs, each repeated at once, then all repeated again: state and history are those of the first tries.

    With one version kept, the second run's start is gone by then, and its repeat is refused.
    """
    root, out, spec = session.scratch(spark, "retry"), [], ["cloudformation"]
    land_topics(spark, sf, root)
    for keep in (1, 2):
        store, refused = f"{root}/store{keep}", 0
        for day in RUNS:
            first = Sync(spark, root, store, day, keep_versions=keep).run(spec).collect()
            if Sync(spark, root, store, day, keep_versions=keep).run(spec).collect() != first:
                raise ValueError("a repeated run counts differently")
        for day in RUNS:
            try:
                Sync(spark, root, store, day, keep_versions=keep).run(spec)
            except RunExpired:
                refused += 1
        out.append(topic_rows(StateStore(spark, store)).select(F.lit(keep).alias("keep"), "*", F.lit(refused).alias("refused")))
    return out[0].unionByName(out[1])


@check("state_delta", f"WITH {TOPICS_SQL} {_TOPIC_ROWS}")
def state_delta(spark: SparkSession, sf: str) -> DataFrame:
    """State read from a whole copy and the changes of two later runs."""
    root = session.scratch(spark, "delta")
    land_topics(spark, sf, root)
    for day in RUNS:
        Sync(spark, root, f"{root}/store", day).run(["cloudformation"])
    return topic_rows(StateStore(spark, f"{root}/store"))


@check(
    "state_schema_change",
    """SELECT 'stack-' || c_custkey AS stack_name, CASE WHEN c_custkey % 6 <> 2 THEN 'filled' END AS note,
      (SELECT count(*) FROM customer WHERE c_custkey % 6 NOT IN (1, 2) AND c_custkey % 10 < 3) AS changes FROM customer WHERE c_custkey % 6 <> 1 OR c_custkey % 6 <> 2""",
)
def state_schema_change(spark: SparkSession, sf: str) -> DataFrame:
    """A column that a later run adds is filled in where the resource is seen, and is no change of it."""
    root, spec = session.scratch(spark, "schema"), SPECS["cloudformation"]
    land_topics(spark, sf, root)
    store = StateStore(spark, f"{root}/store")
    Sync(spark, root, store.root, RUNS[1]).sync_resource(spec)
    wider = replace(spec, columns=f"{spec.columns}, note string", flatten=lambda raw: spec.flatten(raw).withColumn("note", lit("filled")))
    Sync(spark, root, store.root, RUNS[2]).sync_resource(wider)
    changes = store.history().where("field_name <> 'note'").count() + 1_000_000 * store.history().where("field_name = 'note'").count()
    return store.read(wider).select("stack_name", "note", F.lit(changes).cast("long").alias("changes"))


LATE = datetime(2024, 1, 15, 12)
#: Events by the day they were landed for; of those from before the last day, each third comes after that day's run.
LATE_SQL = f"""{AUDIT_SQL},
kept AS (SELECT *, date_trunc('second', ts) AS moment, ts < TIMESTAMP '2024-01-14' AND event_id % 3 = 0 AS late FROM au
  WHERE event_type IN ('view', 'signup', 'purchase') AND ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-15 12:00:00')
"""


def _land_audit(spark: SparkSession, sf: str, root: str, late: bool) -> None:
    """The pages of three days below their date; late ones are each third event."""
    chosen = (F.col("ts") >= "2024-01-12") & (F.col("ts") < "2024-01-15 12:00:00")
    is_late = (F.col("ts") < "2024-01-14") & (F.col("event_id") % 3 == 0)
    rows = as_audit(spark, sf).where(chosen & (is_late if late else ~is_late))
    doc = F.struct(F.array(F.struct(payload().alias("CloudTrailEvent"))).alias("Events"))
    lines = rows.select(F.to_json(F.struct("account_id", "account_name", "region", doc.alias("doc"))).alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    lines.write.mode("append").partitionBy("dt").text(f"{root}/cloudtrail/events")


@check(
    "ingest_late_pages",
    f"""WITH {LATE_SQL}
    SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS event_time,
      CASE WHEN late THEN '2024-01-15 12:00' WHEN moment < TIMESTAMP '2024-01-14' THEN '2024-01-13 23:59' ELSE '2024-01-15 12:00' END AS created_at FROM kept""",
)
def ingest_late_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that are landed for a day after its run are taken in by the next run; what was taken in is not read again."""
    root = session.scratch(spark, "late")
    store = f"{root}/store"
    _land_audit(spark, sf, root, late=False)
    Sync(spark, root, store, datetime(2024, 1, 13, 23, 59)).run(["cloudtrail"])
    _land_audit(spark, sf, root, late=True)
    sync = Sync(spark, root, store, LATE)
    sync.run(["cloudtrail"])
    if sync.new_audit_files() != list(StateStore(spark, store).log("cloudtrail").read(sync.run_id).inputs):
        raise ValueError("a repeat would read other files")
    if Sync(spark, root, store, datetime(2024, 1, 16, 12)).new_audit_files():
        raise ValueError("files are taken in twice")
    found = audit_log.read_events(spark, sync.events_path)
    return found.select("event_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"), F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("created_at"))


@check(
    "stream_after_batch",
    f"""WITH {LATE_SQL}
    SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN late THEN 'stream' ELSE 'batch' END AS taken_in FROM kept
    UNION ALL SELECT CAST(event_id AS VARCHAR), 'late' FROM au WHERE event_type IN ('view', 'signup', 'purchase') AND ts < TIMESTAMP '2024-01-05'
    UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'events' FROM nation""",
)
def stream_after_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A stream over pages that a batch run has taken in for the most part adds the others; broken and too late events go to quarantine."""
    root = session.scratch(spark, "both")
    store = StateStore(spark, f"{root}/store")
    _land_audit(spark, sf, root, late=False)
    batch = Sync(spark, root, store.root, LATE)
    batch.run(["cloudtrail"])
    _land_audit(spark, sf, root, late=True)
    early = as_audit(spark, sf).where(F.col("ts") < "2024-01-05")
    doc = F.struct(F.array(F.struct(payload().alias("CloudTrailEvent"))).alias("Events"))
    early.select(F.to_json(F.struct("account_id", "account_name", "region", doc.alias("doc")))).write.mode("append").text(f"{root}/cloudtrail/events/dt=2024-01-15")
    broken = table(spark, sf, "nation").select(F.to_json(F.struct(F.struct(F.array(F.struct(F.concat(lit("{"), text("n_nationkey")).alias("CloudTrailEvent"))).alias("Events")).alias("doc"))))
    broken.write.mode("append").text(f"{root}/cloudtrail/events/dt=2024-01-15")
    pages_ = audit_stream.read_pages(spark, f"{root}/cloudtrail/events")
    for again in ("one", "two"):  # the second stream finds every id stored
        audit_stream.ingest(pages_, store, f"{root}/checkpoint-{again}", now=lambda: datetime(2024, 1, 15, 13)).awaitTermination()
    events = audit_log.read_events(spark, batch.events_path)
    taken = F.when(F.col("created_at") == batch.run_ts, "batch").otherwise("stream")
    thrown = store.rejected().where("run_id LIKE 'checkpoint-one%'")
    id_of = F.when(F.col("dataset") == "late", F.get_json_object("content", "$.event_id")).otherwise(F.substring("content", 2, 10))
    return events.select("event_id", taken.alias("taken_in")).unionByName(thrown.select(id_of.alias("event_id"), F.col("dataset").alias("taken_in")))


@check(
    "quarantine_replay",
    f"""WITH {LATE_SQL}, e AS (SELECT event_id, moment FROM kept WHERE NOT late)
    SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 4 = 0 THEN '20240115T120000' END AS origin,
      CASE WHEN event_id % 4 = 0 THEN '2024-01-15 13:00' ELSE '2024-01-15 12:00' END AS created_at, 1 AS still_broken FROM e WHERE event_id % 20 <> 0
    UNION ALL SELECT NULL, '20240115T120000', NULL, count(*) FROM e WHERE event_id % 20 = 0""",
)
def quarantine_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads that lost their end are rejected, repaired and read again, once; some stay broken."""
    root = session.scratch(spark, "replay")
    key = F.col("event_id")
    cut = F.when(key % 20 == 0, lit("{{")).when(key % 4 == 0, F.substr(payload(), F.lit(1), F.length(payload()) - 1)).otherwise(payload())
    kept = (F.col("ts") >= "2024-01-12") & (F.col("ts") < "2024-01-15 12:00:00") & ~((F.col("ts") < "2024-01-14") & (key % 3 == 0))
    rows = as_audit(spark, sf).where(kept & F.col("event_type").isin("view", "signup", "purchase"))
    doc = F.struct(F.array(F.struct(cut.alias("CloudTrailEvent"))).alias("Events"))
    rows.select(F.to_json(F.struct("account_id", "account_name", "region", doc.alias("doc")))).write.text(f"{root}/cloudtrail/events/dt=2024-01-15")
    store = f"{root}/store"
    Sync(spark, root, store, LATE).run(["cloudtrail"])
    mend = lambda c: F.concat(c, lit("}"))
    again = Sync(spark, root, store, datetime(2024, 1, 15, 13))
    first = replay(again, "cloudtrail", mend).collect()
    if replay(again, "cloudtrail", mend).collect() != first:
        raise ValueError("a repeated replay counts differently")
    later = replay(Sync(spark, root, store, datetime(2024, 1, 15, 14)), "cloudtrail", lambda c: F.concat(c, lit(" ")))
    events = audit_log.read_events(spark, again.events_path).select("event_id", F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("created_at"))
    lineage = StateStore(spark, store).replayed().select("event_id", "origin")
    none = F.lit(None).cast("string")
    broken = later.where(F.col("taken") == 0).select(none.alias("event_id"), "origin", none.alias("created_at"), F.col("left").alias("still_broken"))
    return events.join(lineage, "event_id", "left").select("event_id", "origin", "created_at", F.lit(1).cast("long").alias("still_broken")).unionByName(broken)


@check(
    "stream_pages",
    f"""WITH {AUDIT_SQL}
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_name, strftime(ts, '%Y-%m-%d') AS event_date FROM au
    WHERE event_type IN ('view', 'signup', 'purchase') AND ts >= TIMESTAMP '2024-01-10'""",
)
def stream_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages as a stream; what it stores is read like the batch side's events, by day."""
    root = session.scratch(spark, "stream")
    polled = pages(spark, sf, payload())
    polled.unionByName(polled).write.json(f"{root}/landed")
    events = audit_stream.stream_events(audit_stream.read_pages(spark, f"{root}/landed"))
    audit_stream.start(events, f"{root}/events", f"{root}/checkpoint").awaitTermination()
    found = audit_log.read_events(spark, f"{root}/events", F.lit("2024-01-10").cast("timestamp_ntz"))
    return found.select("event_id", "event_name", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))


@check(
    "api_diff",
    f"""WITH {ORDERS_SQL}
    SELECT CAST(order_id AS VARCHAR) AS resource_id, field_name, old_value, new_value FROM cells""",
)
def api_diff(spark: SparkSession, sf: str) -> DataFrame:
    cells = inventrace.diff(ORDERS, order_snapshot(spark, sf), order_state(spark, sf), run_ts())
    return cells.select("resource_id", "field_name", "old_value", "new_value")


@check(
    "api_upsert",
    f"""WITH {ORDERS_SQL}
    SELECT coalesce(s.order_id, o.order_id) AS order_id, coalesce(s.status, o.status) AS status, coalesce(s.price, o.price) AS price
    FROM snap s FULL OUTER JOIN state o ON s.order_id = o.order_id""",
)
def api_upsert(spark: SparkSession, sf: str) -> DataFrame:
    result = inventrace.upsert(ORDERS, order_snapshot(spark, sf), order_state(spark, sf), run_ts())
    return result.state.select("order_id", "status", "price")
