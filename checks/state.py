"""Snapshot diff, upsert, history, attribution and table round trips."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import CHECKS, RUN_TIME, check, run_ts, table, text
from inventrace import session
from inventrace.operators import attribution, report, upsert
from inventrace.plans import audit_log
from inventrace.plans.sync import upsert_frames
from inventrace.sources.latest import LatestEvents
from inventrace.sources.state import StateStore
from inventrace.specs.model import ResourceSpec

# ---------------------------------------------------------------- orders as an inventoried resource

ORDERS = ResourceSpec(
    table="orders_state",
    service="orders",
    service_type="ORDERS",
    columns=(
        "order_id bigint, status string, priority string, price double, owner string, region string, "
        "account_name string, account_id string"
    ),
    key=("order_id",),
    resource_id="order_id",
    uncompared=("owner", "account_name"),
    raw={},
    flatten=lambda raw: raw["orders"],
)
#: The same with the owning user as the resource that audit events name.
OWNED = replace(ORDERS, resource_id="owner")


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    cust = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
        text(F.floor(cust / 10)).alias("owner"),
        F.concat(F.lit("r"), text(cust % 5)).alias("region"),
        F.concat(F.lit("acct-"), text(cust % 25)).alias("account_name"),
        F.concat(F.lit("a"), text(cust % 25)).alias("account_id"),
    )


def order_state(spark: SparkSession, sf: str) -> DataFrame:
    return order_rows(spark, sf).withColumn("last_updated", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


def order_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The same orders a run later: pending ones under a new id, urgent ones shipped, some repriced."""
    moved = F.col("status") == "P"
    return order_rows(spark, sf).withColumns(
        {
            "order_id": F.when(moved, -1 - F.col("order_id")).otherwise(F.col("order_id")),
            "status": F.when(F.col("priority") == "2-HIGH", F.lit("X")).otherwise(F.col("status")),
            "price": F.when(
                F.col("priority").isin("2-HIGH", "3-MEDIUM"), F.floor("price").cast("double") + F.lit(0.5)
            ).otherwise(F.col("price")),
            "region": F.when(F.col("priority") == "5-LOW", F.lit("r9")).otherwise(F.col("region")),
        }
    )


def order_compared(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.compare(ORDERS, order_snapshot(spark, sf), order_state(spark, sf), run_ts())


ORDERS_SQL = """
base AS (
  SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price,
         CAST(o_custkey // 10 AS VARCHAR) AS owner, 'r' || (o_custkey % 5) AS region,
         'acct-' || (o_custkey % 25) AS account_name, 'a' || (o_custkey % 25) AS account_id
  FROM orders),
state AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS last_updated FROM base),
snap AS (
  SELECT CASE WHEN status = 'P' THEN -1 - order_id ELSE order_id END AS order_id,
         CASE WHEN priority = '2-HIGH' THEN 'X' ELSE status END AS status, priority,
         CASE WHEN priority IN ('2-HIGH', '3-MEDIUM') THEN floor(price) + 0.5::DOUBLE ELSE price END AS price,
         owner, CASE WHEN priority = '5-LOW' THEN 'r9' ELSE region END AS region, account_name, account_id
  FROM base),
cells AS (
  SELECT s.order_id, s.owner, s.account_id, s.region, c.field_name, c.old_value, c.new_value
  FROM snap s JOIN state o ON s.order_id = o.order_id,
  LATERAL (VALUES ('status', o.status, s.status), ('priority', o.priority, s.priority),
                  ('price', CAST(o.price AS VARCHAR), CAST(s.price AS VARCHAR)),
                  ('region', o.region, s.region), ('account_id', o.account_id, s.account_id)
          ) c(field_name, old_value, new_value)
  WHERE c.old_value IS DISTINCT FROM c.new_value)
"""


@check(
    "snapshot_diff",
    f"""WITH {ORDERS_SQL}
    SELECT 'ORDERS' AS service_type, CAST(order_id AS VARCHAR) AS resource_id, field_name, old_value, new_value,
           account_id, region FROM cells""",
)
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.changed_cells(ORDERS, order_compared(spark, sf))


@check(
    "upsert_state",
    f"""WITH {ORDERS_SQL}
    SELECT coalesce(s.order_id, o.order_id) AS order_id, coalesce(s.status, o.status) AS status,
           coalesce(s.priority, o.priority) AS priority, coalesce(s.price, o.price) AS price,
           coalesce(o.owner, s.owner) AS owner, coalesce(s.region, o.region) AS region,
           coalesce(o.account_name, s.account_name) AS account_name, coalesce(s.account_id, o.account_id) AS account_id,
           CASE WHEN s.order_id IS NOT NULL THEN '{RUN_TIME}' ELSE '2024-01-01 00:00:00' END AS last_updated
    FROM snap s FULL OUTER JOIN state o ON s.order_id = o.order_id""",
)
def upsert_state(spark: SparkSession, sf: str) -> DataFrame:
    merged = upsert.new_state(ORDERS, order_compared(spark, sf))
    return merged.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss"))


@check(
    "upsert_metrics",
    f"""WITH {ORDERS_SQL},
    marks AS (
      SELECT s.order_id AS n, o.order_id AS old,
             (s.status, s.priority, s.price, s.region, s.account_id)
               IS DISTINCT FROM (o.status, o.priority, o.price, o.region, o.account_id) AS differs
      FROM snap s LEFT JOIN state o ON s.order_id = o.order_id),
    m AS (
      SELECT count(*) AS processed, count(*) FILTER (WHERE old IS NULL) AS inserted,
             count(*) FILTER (WHERE old IS NOT NULL AND differs) AS updated,
             count(*) FILTER (WHERE old IS NOT NULL) AS matched FROM marks)
    SELECT 'orders' AS service, processed, inserted, updated, matched,
           inserted || ' nuevos, ' || updated || ' actualizados' AS status,
           'ORDERS: ' || inserted || ' nuevos, ' || updated || ' actualizados' AS message FROM m""",
)
def upsert_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return report.run_summary(upsert.counters(ORDERS, order_compared(spark, sf)))


@check(
    "insert_new_anti",
    f"""WITH {ORDERS_SQL}
    SELECT * FROM snap WHERE NOT EXISTS (SELECT 1 FROM state o WHERE o.order_id = snap.order_id)""",
)
def insert_new_anti(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.unseen(order_snapshot(spark, sf), order_state(spark, sf), ["order_id"])


@check(
    "carry_over",
    f"""WITH {ORDERS_SQL}
    SELECT order_id, status, price, '2024-01-01 00:00:00' AS last_updated FROM state
    WHERE NOT EXISTS (SELECT 1 FROM snap s WHERE s.order_id = state.order_id)""",
)
def carry_over(spark: SparkSession, sf: str) -> DataFrame:
    kept = order_compared(spark, sf).where(F.col("_action") == "carry")
    return kept.select("order_id", "status", "price", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss").alias("last_updated"))


# ---------------------------------------------------------------- composite keys, repeated rows

LINES = ResourceSpec(
    table="lines_state",
    service="lines",
    service_type="LINES",
    columns="line_id string, account_id string, region string, quantity double, supplier bigint",
    key=("line_id", "account_id", "region"),
    resource_id="line_id",
    raw={},
    flatten=lambda raw: raw["lines"],
)


def line_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("line_id"),
        F.col("l_returnflag").alias("account_id"),
        F.col("l_linestatus").alias("region"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_suppkey").alias("supplier"),
    )


@check(
    "upsert_composite_key",
    f"""WITH base AS (
      SELECT l_orderkey || '-' || l_linenumber AS line_id, l_returnflag AS account_id, l_linestatus AS region,
             l_quantity AS quantity, l_suppkey AS supplier FROM lineitem),
    state AS (
      SELECT * FROM base QUALIFY row_number() OVER (
        PARTITION BY line_id, account_id, region ORDER BY quantity DESC, supplier DESC) = 1),
    moved AS (
      SELECT line_id, account_id, CASE WHEN account_id = 'A' THEN 'M' ELSE region END AS region,
             CASE WHEN account_id = 'R' THEN quantity + 1 ELSE quantity END AS quantity, supplier FROM base),
    snap AS (
      SELECT *, count(*) OVER (PARTITION BY line_id, account_id, region) AS copies FROM moved
      QUALIFY row_number() OVER (
        PARTITION BY line_id, account_id, region ORDER BY quantity DESC, supplier DESC) = 1)
    SELECT line_id, account_id, region,
           CASE WHEN s.line_id IS NOT NULL THEN s.quantity ELSE o.quantity END AS quantity,
           coalesce(s.supplier, o.supplier) AS supplier, coalesce(s.copies, 0) AS copies,
           CASE WHEN o.quantity IS NULL THEN 'insert' WHEN s.quantity IS NULL THEN 'carry'
                WHEN s.quantity <> o.quantity OR s.supplier <> o.supplier THEN 'update' ELSE 'touch' END AS action
    FROM snap s FULL OUTER JOIN state o USING (line_id, account_id, region)""",
)
def upsert_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """Three-column key; repeated rows on both sides are reduced to the last one."""
    rows = line_rows(spark, sf)
    snapshot = rows.withColumns(
        {
            "region": F.when(F.col("account_id") == "A", F.lit("M")).otherwise(F.col("region")),
            "quantity": F.col("quantity") + F.when(F.col("account_id") == "R", F.lit(1.0)).otherwise(F.lit(0.0)),
        }
    )
    state = rows.withColumn("last_updated", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    compared = upsert.compare(LINES, snapshot, state, run_ts(), state_is_unique=False)
    return compared.select(*LINES.column_names, F.col("_copies").alias("copies"), F.col("_action").alias("action"))


CUSTOMERS = ResourceSpec(
    table="customers_state",
    service="customers",
    service_type="CUSTOMERS",
    columns="id bigint, name string, segment string, account_id string, account_name string, region string",
    key=("id", "account_id", "account_name"),
    resource_id="id",
    raw={},
    flatten=lambda raw: raw["customers"],
)


def customer_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        text("c_nationkey").alias("account_id"),
        F.concat(F.lit("n"), text("c_nationkey")).alias("account_name"),
        F.lit("eu").alias("region"),
    )


@check(
    "identity_change_insert",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS account_id,
         'n' || c_nationkey AS account_name,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'carry' ELSE 'touch' END AS action FROM customer
       UNION ALL
       SELECT c_custkey, c_name, c_mktsegment,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'moved' ELSE CAST(c_nationkey AS VARCHAR) END,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'renamed' ELSE 'n' || c_nationkey END, 'insert'
       FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
)
def identity_change_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Same id under another account (or account name): a second row, and the stored one stays."""
    rows = customer_rows(spark, sf)
    snapshot = rows.withColumns(
        {
            "account_id": F.when(F.col("segment") == "BUILDING", F.lit("moved")).otherwise(F.col("account_id")),
            "account_name": F.when(F.col("segment") == "MACHINERY", F.lit("renamed")).otherwise(F.col("account_name")),
        }
    )
    state = rows.withColumn("last_updated", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    compared = upsert.compare(CUSTOMERS, snapshot, state, run_ts())
    return compared.select("id", "name", "segment", "account_id", "account_name", F.col("_action").alias("action"))


# ---------------------------------------------------------------- attribution

#: Which events explain which field, for resources of type USER and ORDERS.
FIELDS = [
    ("USER", "view", "click"),
    ("USER", "view", "signup"),
    ("USER", "click", "error"),
    ("USER", "signup", "purchase"),
    ("USER", "signup", "signup"),
    ("ORDERS", "status", "purchase"),
    ("ORDERS", "price", "click"),
    ("ORDERS", "price", "view"),
]
FIELDS_SQL = "fields(service_type, field_name, event_name) AS (VALUES " + ", ".join(
    f"('{s}', '{f}', '{e}')" for s, f, e in FIELDS
) + ")"


def audit_events(spark: SparkSession, sf: str, kind: str = "USER") -> DataFrame:
    """The events table read as an audit log; the acting user is named after the event."""
    return table(spark, sf, "events").select(
        text("event_id").alias("event_id"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("event_name"),
        F.lit(kind).alias("resource_type"),
        text("user_id").alias("resource_name"),
        F.concat(F.lit("u"), text("event_id")).alias("user_name"),
    )


def mapping(spark: SparkSession) -> DataFrame:
    return session.fixed_rows(spark, FIELDS, "service_type, field_name, event_name")


def probes(spark: SparkSession, sf: str) -> DataFrame:
    """One change per event: same user, some hours later, in the field called like the event."""
    ev = table(spark, sf, "events")
    shift = F.make_dt_interval(hours=F.lit(7) + F.floor(F.col("value") / 4).cast("int"))
    return ev.select(
        F.col("event_id").alias("change_id"),
        F.lit("User").alias("service_type"),
        text("user_id").alias("resource_id"),
        F.col("event_type").alias("field_name"),
        (F.col("ts") + shift).alias("changed_at"),
    )


PROBES_SQL = """
audit AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time, event_type AS event_name,
         CAST(user_id AS VARCHAR) AS resource_name, 'u' || event_id AS user_name FROM events),
probes AS (
  SELECT event_id AS change_id, CAST(user_id AS VARCHAR) AS resource_id, event_type AS field_name,
         ts + to_hours(CAST(7 + floor(value / 4) AS BIGINT)) AS changed_at FROM events)
"""
GAP = "abs(epoch_us(a.event_time) - epoch_us(p.changed_at))"


@check(
    "attr_nearest_24h",
    f"""WITH {PROBES_SQL},
    near AS (
      SELECT p.change_id, a.user_name, {GAP} AS gap FROM probes p JOIN audit a
        ON a.resource_name = p.resource_id AND {GAP} < 86400000000
      QUALIFY row_number() OVER (PARTITION BY p.change_id ORDER BY gap, a.event_time, a.event_id) = 1)
    SELECT p.change_id, p.resource_id, coalesce(n.user_name, 'unknown') AS changed_by, n.gap AS gap_us
    FROM probes p LEFT JOIN near n USING (change_id)""",
)
def attr_nearest_24h(spark: SparkSession, sf: str) -> DataFrame:
    p = probes(spark, sf)
    ev = audit_events(spark, sf).withColumnRenamed("resource_name", "resource_id")
    near = attribution.nearest_event(p, ev, ["resource_id"], "changed_at")
    return p.join(near, ["resource_id", "changed_at"], "left").select(
        "change_id",
        "resource_id",
        F.coalesce("_best.user_name", F.lit(attribution.UNKNOWN)).alias("changed_by"),
        F.col("_best.rank.gap").alias("gap_us"),
    )


@check(
    "attr_field_fallback",
    f"""WITH {FIELDS_SQL}, {PROBES_SQL},
    near AS (
      SELECT p.change_id, a.user_name FROM probes p
        JOIN fields f ON f.service_type = 'USER' AND f.field_name = p.field_name
        JOIN audit a ON a.resource_name = p.resource_id AND a.event_name = f.event_name AND {GAP} < 86400000000
      QUALIFY row_number() OVER (PARTITION BY p.change_id ORDER BY {GAP}, a.event_time, a.event_id) = 1)
    SELECT p.change_id, p.field_name, coalesce(n.user_name, 'unknown') AS changed_by
    FROM probes p LEFT JOIN near n USING (change_id)""",
)
def attr_field_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Events carry another resource type, so only the field's events can match."""
    done = attribution.attribute(probes(spark, sf), audit_events(spark, sf, "OTHER"), mapping(spark), "changed_at")
    return done.select("change_id", "field_name", "changed_by")


@check(
    "attr_latest",
    f"""WITH {FIELDS_SQL}, {PROBES_SQL},
    picked AS (
      SELECT p.change_id, a.user_name FROM probes p JOIN audit a ON a.resource_name = p.resource_id
      WHERE a.event_name IN (SELECT event_name FROM fields f WHERE f.service_type = 'USER' AND f.field_name = p.field_name)
         OR p.field_name NOT IN (SELECT field_name FROM fields WHERE service_type = 'USER')
      QUALIFY row_number() OVER (PARTITION BY p.change_id ORDER BY a.event_time DESC, a.event_id DESC) = 1)
    SELECT p.change_id, p.field_name, coalesce(n.user_name, 'unknown') AS changed_by
    FROM probes p LEFT JOIN picked n USING (change_id)""",
)
def attr_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event of the field's events, or of any event where the field has none listed."""
    return _by_latest(spark, sf, audit_events(spark, sf).withColumn("event_id", text("event_id")))


def _by_latest(spark: SparkSession, sf: str, latest: DataFrame) -> DataFrame:
    """Attribution with nothing but the latest events to go by."""
    none = audit_events(spark, sf).where("1 = 0")
    done = attribution.attribute(probes(spark, sf), none, mapping(spark), "changed_at", latest_first=True, latest=latest)
    return done.select("change_id", "field_name", "changed_by")


@check("attr_latest_table", CHECKS["attr_latest"].sql)
def attr_latest_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the latest-event table, which three ingests kept up to date, the last events first."""
    events, day = audit_events(spark, sf), F.dayofmonth("event_time")
    table_ = LatestEvents(StateStore(spark, session.scratch(spark, "latest")))
    for part in (events.where(day > 20), events.where(day.between(8, 20)), events.where(day < 10)):
        table_.add(part, part)
    return _by_latest(spark, sf, table_.read(table_.entry()))


CHAIN_SQL = f"""
hits AS (
  SELECT order_id, field_name, old_value, new_value, c.owner, c.account_id, c.region, a.user_name,
         abs(epoch_us(a.event_time) - epoch_us(TIMESTAMP '{RUN_TIME}')) AS gap, a.event_time, a.event_id,
         a.event_name
  FROM cells c LEFT JOIN audit a ON a.resource_name = c.owner
    AND abs(epoch_us(a.event_time) - epoch_us(TIMESTAMP '{RUN_TIME}')) < 86400000000)
"""


@check(
    "attr_chain",
    f"""WITH {FIELDS_SQL}, {PROBES_SQL}, {ORDERS_SQL}, {CHAIN_SQL},
    typed AS (SELECT *, event_name IN ('view', 'error') AS is_direct FROM hits),
    ranked AS (
      SELECT h.*, CASE WHEN is_direct THEN 1
             WHEN EXISTS (SELECT 1 FROM fields f WHERE f.service_type = 'ORDERS' AND f.field_name = h.field_name
                          AND f.event_name = h.event_name) THEN 2 ELSE 3 END AS tier FROM typed h)
    SELECT CAST(order_id AS VARCHAR) AS order_id, field_name,
           CASE WHEN tier < 3 THEN user_name ELSE 'unknown' END AS changed_by
    FROM ranked
    QUALIFY row_number() OVER (PARTITION BY order_id, field_name ORDER BY tier, gap, event_time, event_id) = 1""",
)
def attr_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Direct event of the type, else a related event of the field, else unknown; one anchor for the run.

    Only views and errors carry the resource's own type here, so both steps of the chain are used.
    """
    ev = audit_events(spark, sf).withColumn(
        "resource_type", F.when(F.col("event_name").isin("view", "error"), F.lit("Orders")).otherwise(F.lit("Other"))
    )
    cells = (
        order_compared(spark, sf)
        .select("order_id", "owner", F.explode("_changes").alias("c"))
        .select(
            text("order_id").alias("order_id"),
            F.lit("ORDERS").alias("service_type"),
            F.col("owner").alias("resource_id"),
            F.col("c.field_name").alias("field_name"),
        )
    )
    done = attribution.attribute(cells, ev, mapping(spark), run_ts())
    return done.select("order_id", "field_name", "changed_by")


HISTORY_SQL = f"""
kept AS (SELECT * FROM cells WHERE field_name <> 'region'),
near AS (
  SELECT resource_name, user_name FROM audit
  WHERE abs(epoch_us(event_time) - epoch_us(TIMESTAMP '{RUN_TIME}')) < 86400000000
  QUALIFY row_number() OVER (PARTITION BY resource_name
    ORDER BY abs(epoch_us(event_time) - epoch_us(TIMESTAMP '{RUN_TIME}')), event_time, event_id) = 1)
"""


@check(
    "history_emit",
    f"""WITH {PROBES_SQL}, {ORDERS_SQL}, {HISTORY_SQL}
    SELECT 'ORDERS' AS service_type, owner AS resource_id, field_name, coalesce(old_value, 'None') AS old_value,
           coalesce(new_value, 'None') AS new_value, coalesce(n.user_name, 'unknown') AS changed_by,
           account_id, region
    FROM kept LEFT JOIN near n ON n.resource_name = kept.owner""",
)
def history_emit(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot to attributed history: diff, significance, attribution, text values."""
    compared = upsert.compare(OWNED, order_snapshot(spark, sf), order_state(spark, sf), run_ts())
    return upsert_frames(OWNED, compared, audit_events(spark, sf, "Orders"), mapping(spark), run_ts()).changes


@check(
    "system_name_suppress",
    """SELECT event_id, 'arn:aws:lambda:eu:1:function:' || CASE event_type WHEN 'error' THEN 'generate-external-id'
         WHEN 'view' THEN 'cid-CID-Analytics' ELSE 'fn-' || user_id END AS resource_id
       FROM events WHERE event_type NOT IN ('error', 'view')""",
)
def system_name_suppress(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of vendor-installed functions leave no history, whatever the spelling of the type."""
    kind = F.col("event_type")
    name = F.when(kind == "error", F.lit("generate-external-id")).when(kind == "view", F.lit("cid-CID-Analytics"))
    cells = table(spark, sf, "events").select(
        "event_id",
        F.lit("Lambda").alias("service_type"),
        F.concat(
            F.lit("arn:aws:lambda:eu:1:function:"), name.otherwise(F.concat(F.lit("fn-"), text("user_id")))
        ).alias("resource_id"),
        F.lit("handler").alias("field_name"),
        F.lit("a").alias("old_value"),
        F.lit("b").alias("new_value"),
    )
    return upsert.significant(cells).select("event_id", "resource_id")


# ---------------------------------------------------------------- stored tables


@check(
    "state_roundtrip",
    f"""WITH {ORDERS_SQL}
    SELECT coalesce(s.order_id, o.order_id) AS order_id, coalesce(s.status, o.status) AS status,
           coalesce(s.price, o.price) AS price FROM snap s FULL OUTER JOIN state o ON s.order_id = o.order_id""",
)
def state_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """First run stores the state rows, the second merges the snapshot; the latest version is read."""
    store = StateStore(spark, session.scratch(spark, "state"))
    first = upsert.compare(ORDERS, order_rows(spark, sf), store.read(ORDERS), F.lit("2024-01-01").cast("timestamp_ntz"))
    store.write(ORDERS, first, "20240101T000000")
    second = upsert.compare(ORDERS, order_snapshot(spark, sf), store.read(ORDERS), run_ts())
    store.write(ORDERS, second, "20240115T120000")
    return store.read(ORDERS).select("order_id", "status", "price")


@check(
    "history_append",
    f"""WITH {ORDERS_SQL},
    twice AS (SELECT 'run1' AS run_id, * FROM cells UNION ALL SELECT 'run2', * FROM cells)
    SELECT 'ORDERS' AS service_type, run_id, field_name, count(*) AS n, count(DISTINCT owner) AS owners
    FROM twice WHERE field_name <> 'region' GROUP BY run_id, field_name""",
)
def history_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs append; repeating the second run does not duplicate it."""
    store = StateStore(spark, session.scratch(spark, "history"))
    compared = upsert.compare(OWNED, order_snapshot(spark, sf), order_state(spark, sf), run_ts())
    cells = upsert.significant(upsert.changed_cells(OWNED, store.write(OWNED, compared, "run1")))
    rows = upsert.history_rows(cells.withColumn("changed_by", F.lit("unknown")))
    for run in ("run1", "run2", "run2"):
        store.append_history(rows, "ORDERS", run)
    return (
        store.resource_history("ORDERS")
        .groupBy("service_type", "run_id", "field_name")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("resource_id").alias("owners"))
    )


@check(
    "any_changed",
    f"""WITH {ORDERS_SQL}
    SELECT s.order_id, (s.status, s.price, s.region) IS DISTINCT FROM (o.status, o.price, o.region) AS changed
    FROM snap s JOIN state o ON s.order_id = o.order_id""",
)
def any_changed(spark: SparkSession, sf: str) -> DataFrame:
    new, old = order_snapshot(spark, sf).alias("n"), order_state(spark, sf).alias("o")
    pairs = [(F.col(f"o.{c}"), F.col(f"n.{c}")) for c in ("status", "price", "region")]
    return new.join(old, "order_id").select("order_id", upsert.any_changed(pairs).alias("changed"))


@check(
    "record_insert_ignore",
    """WITH target AS (SELECT 'Z_' || c_mktsegment || '_' || c_nationkey AS record_id FROM customer
                       WHERE c_nationkey < 10),
    incoming AS (SELECT 'Z_' || c_mktsegment || '_' || c_nationkey AS record_id, 'a' || (c_custkey % 7) AS account_id,
                        c_custkey AS n FROM customer)
    SELECT record_id, account_id, n FROM incoming
    WHERE record_id NOT IN (SELECT record_id FROM target)
    QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY account_id, n) = 1""",
)
def record_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """Insert-or-ignore on the record id alone: another account's row with a stored id is skipped."""
    cust = table(spark, sf, "customer")
    rid = F.concat_ws("_", F.lit("Z"), "c_mktsegment", text("c_nationkey")).alias("record_id")
    target = cust.where(F.col("c_nationkey") < 10).select(rid)
    incoming = cust.select(
        rid, F.concat(F.lit("a"), text(F.col("c_custkey") % 7)).alias("account_id"), F.col("c_custkey").alias("n")
    )
    first = incoming.groupBy("record_id", "account_id").agg(F.min("n").alias("n"))
    return upsert.unseen(first, target, ["record_id"])


# ---------------------------------------------------------------- event table


@check(
    "event_dedup_insert",
    """WITH stored AS (SELECT event_id FROM events WHERE event_type = 'signup')
    SELECT CAST(event_id AS VARCHAR) AS event_id, 'a1' AS account_id, event_type AS event_name FROM events
    WHERE event_id NOT IN (SELECT event_id FROM stored)""",
)
def event_dedup_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Every event arrives twice from overlapping polls; stored ids are ignored."""
    ev = audit_events(spark, sf).withColumn("region", F.lit("r"))
    polled = ev.withColumn("account_id", F.explode(F.array(F.lit("a2"), F.lit("a1"))))
    stored = ev.where(F.col("event_name") == "signup")
    return audit_log.new_events(polled, stored).select("event_id", "account_id", "event_name")
