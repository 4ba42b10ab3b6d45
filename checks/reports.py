"""Relational enrichment, rollups, filters, limits, unions and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import RUN_TIME, check, joined, run_ts, table, text
from inventrace.functions import text as tx
from inventrace.operators import gather, report, rollup
from inventrace.sources import landed
from inventrace.specs import delivery
from inventrace.specs.registry import select_services

# ---------------------------------------------------------------- enrichment


@check(
    "enrich_lookup_default",
    """SELECT s_suppkey, coalesce(CASE WHEN n_regionkey > 0 THEN n_name END, 'N/A') AS nation_name
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def enrich_lookup_default(spark: SparkSession, sf: str) -> DataFrame:
    """N:1 lookup; nations of region 0 have no name to find."""
    dim = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.when(F.col("n_regionkey") > 0, F.col("n_name")).alias("nation_name")
    )
    sup = table(spark, sf, "supplier")
    return gather.lookup(sup, dim, ["s_nationkey"], "nation_name", F.lit("N/A")).select("s_suppkey", "nation_name")


@check(
    "gather_children",
    """WITH o AS (SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities,
                 string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders GROUP BY o_custkey)
    SELECT c_custkey, coalesce(priorities, '') AS priorities, coalesce(statuses, '') AS statuses
    FROM customer LEFT JOIN o ON o_custkey = c_custkey""",
)
def gather_children(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct priorities and statuses of a customer's orders; customers without orders get empty lists."""
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    cust = table(spark, sf, "customer").select("c_custkey")
    children = {"priorities": (o, "o_orderpriority"), "statuses": (o, "o_orderstatus")}
    out = gather.gather_all(cust, ["c_custkey"], children)
    return out.select("c_custkey", joined("priorities").alias("priorities"), joined("statuses").alias("statuses"))


@check(
    "assoc_last_wins",
    """WITH l AS (SELECT l_orderkey, max_by(l_suppkey, (l_shipdate, l_suppkey)) AS supp FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, coalesce('s' || supp, '') AS supplier FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""",
)
def assoc_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The supplier of an order's last shipped line; "" for orders without lines."""
    links = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.struct("l_shipdate", "l_suppkey").alias("at"),
        F.concat(F.lit("s"), text("l_suppkey")).alias("item"),
    )
    o = table(spark, sf, "orders").select("o_orderkey")
    return gather.last_association(o, links, ["o_orderkey"], "item", "supplier", order="at")


@check(
    "array_membership",
    """WITH e AS (SELECT l_suppkey AS member, CAST(l_orderkey AS VARCHAR) AS id FROM lineitem
                  UNION SELECT l_partkey % 50, CAST(l_orderkey AS VARCHAR) FROM lineitem)
    SELECT s_suppkey, count(id) AS n, coalesce(min(id), '') AS first_id, coalesce(max(id), '') AS last_id
    FROM supplier LEFT JOIN e ON member = s_suppkey GROUP BY s_suppkey""",
)
def array_membership(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose member array (suppliers) contains the supplier, as pairs and counted."""
    holders = table(spark, sf, "lineitem").select(
        text("l_orderkey").alias("id"), F.array(F.col("l_suppkey"), F.col("l_partkey") % 50).alias("members")
    )
    pairs = gather.member_pairs(holders, [], "s_suppkey", "members", "id")
    return _pair_counts(table(spark, sf, "supplier").select("s_suppkey"), pairs, "s_suppkey")


def _pair_counts(df: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    counted = pairs.groupBy(key).agg(F.count("id").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    empty = F.lit("")
    return df.join(counted, key, "left").select(
        key, F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("first_id", empty).alias("first_id"), F.coalesce("last_id", empty).alias("last_id"),
    )


@check(
    "or_join",
    """SELECT c_custkey, count(DISTINCT l.id) AS n, coalesce(min(l.id), '') AS first_id, coalesce(max(l.id), '') AS last_id
    FROM customer LEFT JOIN (
      SELECT id, a AS k FROM (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS a FROM orders)
      UNION SELECT CAST(o_orderkey AS VARCHAR), o_orderkey // 10 FROM orders) l ON l.k = c_custkey GROUP BY c_custkey""",
)
def or_join(spark: SparkSession, sf: str) -> DataFrame:
    """Edges that touch a customer on either end, as pairs and counted."""
    edges = table(spark, sf, "orders").select(
        text("o_orderkey").alias("id"), F.col("o_custkey").alias("a"), F.floor(F.col("o_orderkey") / 10).alias("b")
    )
    pairs = gather.end_pairs(edges, [], "c_custkey", ("a", "b"), "id")
    return _pair_counts(table(spark, sf, "customer").select("c_custkey"), pairs, "c_custkey")


@check(
    "two_hop_set",
    """WITH m AS (SELECT DISTINCT o_custkey, x AS brand FROM orders JOIN lineitem ON l_orderkey = o_orderkey,
                  LATERAL (SELECT unnest([l_returnflag, l_linestatus]) AS x))
    SELECT c_custkey, coalesce(string_agg(brand, ',' ORDER BY brand), '') AS flags
    FROM customer LEFT JOIN m ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def two_hop_set(spark: SparkSession, sf: str) -> DataFrame:
    """customer -> lines of its orders -> distinct flags."""
    middle = table(spark, sf, "orders").join(
        table(spark, sf, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(F.col("o_custkey").alias("c_custkey"), F.array("l_returnflag", "l_linestatus").alias("members"))
    cust = table(spark, sf, "customer").select("c_custkey")
    out = gather.two_hop(cust, middle, ["c_custkey"], "members", "flags")
    return out.select("c_custkey", joined("flags").alias("flags"))


# ---------------------------------------------------------------- rollups


@check(
    "compliance_rollup",
    """WITH c AS (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'N') AS good,
                 count(*) FILTER (WHERE l_returnflag IS DISTINCT FROM 'N') AS bad FROM lineitem GROUP BY l_suppkey)
    SELECT l_suppkey, good AS compliant_resources, bad AS non_compliant_resources,
      round_even(good::DOUBLE / (good + bad) * 100.0::DOUBLE, 2) AS compliance_percentage,
      CAST(floor(bad * 0.3::DOUBLE) AS BIGINT) AS non_compliant_15_days,
      CAST(floor(bad * 0.4::DOUBLE) AS BIGINT) AS non_compliant_15_90_days,
      bad - CAST(floor(bad * 0.3::DOUBLE) AS BIGINT) - CAST(floor(bad * 0.4::DOUBLE) AS BIGINT) AS non_compliant_90_days
    FROM c""",
)
def compliance_rollup(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select(
        "l_suppkey", F.when(F.col("l_returnflag") == "N", F.lit("COMPLIANT")).otherwise(F.col("l_linestatus")).alias("Status")
    )
    return rollup.compliance(items, ["l_suppkey"])


@check(
    "latest_datapoint_sum",
    f"""WITH l AS (SELECT user_id, event_type, max_by(value, (ts, value)) AS v FROM events
                  WHERE ts >= TIMESTAMP '{RUN_TIME}' - INTERVAL 7 DAY GROUP BY user_id, event_type)
    SELECT user_id, CAST(sum(floor(v)) AS BIGINT) AS total FROM l GROUP BY user_id""",
)
def latest_datapoint_sum(spark: SparkSession, sf: str) -> DataFrame:
    since = run_ts() - F.expr("INTERVAL 7 DAYS")
    return rollup.latest_total(table(spark, sf, "events"), ["user_id"], "event_type", "ts", "value", since, "total")


@check(
    "recent_n_per_group",
    """SELECT user_id, event_id FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 50""",
)
def recent_n_per_group(spark: SparkSession, sf: str) -> DataFrame:
    newest = rollup.newest(table(spark, sf, "events"), ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id")], 50)
    return newest.select("user_id", "event_id")


@check(
    "first_n_joined",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
         l_returnflag || ':' || left(CAST(l_partkey * 1000 AS VARCHAR), 4) || ', ' || l_linestatus || ':N/A, N/A:' || l_suppkey AS revisions,
         CASE WHEN l_returnflag = 'R' THEN 'N/A' ELSE l_returnflag || ', ' || l_linestatus END AS apps FROM lineitem""",
)
def first_n_joined(spark: SparkSession, sf: str) -> DataFrame:
    """First three of four revisions, and a list that is empty for returned lines."""
    parts = F.array(
        F.concat("l_returnflag", F.lit(":"), tx.clip(text(F.col("l_partkey") * 1000), 4)),
        F.concat("l_linestatus", F.lit(":N/A")),
        F.concat(F.lit("N/A:"), text("l_suppkey")),
        F.lit("dropped"),
    )
    apps = F.when(F.col("l_returnflag") == "R", F.expr("cast(array() as array<string>)")).otherwise(
        F.array("l_returnflag", "l_linestatus")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        tx.join_or(parts, first=3).alias("revisions"), tx.join_or(apps, first=5).alias("apps"),
    )


# ---------------------------------------------------------------- nested documents


@check(
    "flatten_nested",
    """SELECT 'a' || (o_custkey % 25) AS account_id, 'r' || (o_custkey % 5) AS region, o_orderkey || '-' || k AS item_id,
         CASE k WHEN 1 THEN o_orderstatus || ',' || o_orderpriority ELSE '' END AS volumes,
         CASE k WHEN 1 THEN 3 ELSE 0 END AS n_all, 'z_' || o_orderkey || '_' || k AS record_id
       FROM orders, (VALUES (1), (2)) v(k)""",
)
def flatten_nested(spark: SparkSession, sf: str) -> DataFrame:
    """page -> groups -> items, with an optional nested list filtered by presence of an attribute."""

    def vol(name: str | None) -> Column:
        value = F.col(name) if name else F.lit(None).cast("string")
        return F.struct(F.when(value.isNotNull(), F.struct(value.alias("VolumeId"))).alias("Ebs"))

    def item(k: int) -> Column:
        volumes = F.array(vol("o_orderstatus"), vol(None), vol("o_orderpriority"))
        return F.struct(
            F.concat(text("o_orderkey"), F.lit(f"-{k}")).alias("Id"),
            (volumes if k == 1 else F.when(F.lit(False), volumes)).alias("Volumes"),
        )

    pages = table(spark, sf, "orders").select(
        F.concat(F.lit("a"), text(F.col("o_custkey") % 25)).alias("account_id"),
        F.lit("x").alias("account_name"),
        F.concat(F.lit("r"), text(F.col("o_custkey") % 5)).alias("region"),
        F.struct(F.array(F.struct(F.array(item(1)).alias("Items")), F.struct(F.array(item(2)).alias("Items"))).alias("Groups")).alias("doc"),
    )
    flat = landed.items(pages, "Groups.Items")
    volumes = F.filter(F.col("d.Volumes"), lambda v: v["Ebs"].isNotNull())
    return flat.select(
        "account_id",
        "region",
        F.col("d.Id").alias("item_id"),
        F.coalesce(F.array_join(F.transform(volumes, lambda v: v["Ebs"]["VolumeId"]), ","), F.lit("")).alias("volumes"),
        tx.count_of(F.col("d.Volumes")).cast("int").alias("n_all"),
        F.concat_ws("_", F.lit("z"), F.replace(F.col("d.Id"), F.lit("-"), F.lit("_"))).alias("record_id"),
    )


@check(
    "detail_fallback",
    """WITH d AS (SELECT l_orderkey, min(l_shipdate) AS d, min(l_returnflag) AS f FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, CASE WHEN d.l_orderkey IS NULL THEN o_orderstatus ELSE f END AS status,
      coalesce(strftime(d.d, '%Y-%m-%d'), 'N/A') AS shipped FROM orders LEFT JOIN d ON l_orderkey = o_orderkey""",
)
def detail_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Detail where there is one, else the base document, else a default."""
    detail = (
        table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.struct(F.min("l_shipdate").alias("d"), F.min("l_returnflag").alias("f")).alias("detail"))
    )
    out = table(spark, sf, "orders").join(detail, "o_orderkey", "left")
    return out.select(
        "o_orderkey",
        F.coalesce("detail.f", "o_orderstatus").alias("status"),
        tx.or_default(F.date_format("detail.d", "yyyy-MM-dd")).alias("shipped"),
    )


@check(
    "parent_detail",
    """SELECT o_orderkey || '_' || l_linenumber || '_' || l_returnflag AS record_id, o_orderpriority AS parent, l_quantity AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def parent_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Parents with their separately landed details; details keep the parent's attributes."""
    parents = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("parent"))
    details = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "key")
    rid = F.concat_ws("_", text("key"), text("l_linenumber"), "l_returnflag")
    return details.join(parents, "key").select(rid.alias("record_id"), "parent", F.col("l_quantity").alias("quantity"))


# ---------------------------------------------------------------- filters


@check(
    "filter_status",
    """SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN 'N/A'
         WHEN o_orderstatus = 'O' THEN 'CREATE_COMPLETE' ELSE 'ROLLBACK' END AS stack_status
       FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority <> '5-LOW')""",
)
def filter_status(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted stacks are left out; a stack without status is kept."""
    st = F.col("o_orderstatus")
    status = F.when(
        F.col("o_orderpriority") != "5-LOW",
        F.when(st == "F", F.lit("DELETE_COMPLETE")).when(st == "O", F.lit("CREATE_COMPLETE")).otherwise(F.lit("ROLLBACK")),
    )
    stack = F.to_json(F.struct(F.array(F.struct(text("o_orderkey").alias("StackName"), status.alias("StackStatus"))).alias("Stacks")))
    pages = table(spark, sf, "orders").select(
        F.lit("a").alias("account_id"), F.lit("n").alias("account_name"), F.lit("r").alias("region"), stack.alias("doc")
    )
    raw = {"stacks": landed.parse_pages(pages, delivery.CLOUDFORMATION.raw["stacks"])}
    return delivery.flatten_cloudformation(raw).select(F.col("stack_name").cast("long").alias("id"), "stack_status")


@check(
    "filter_owner",
    """SELECT c_custkey AS id FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""",
)
def filter_owner(spark: SparkSession, sf: str) -> DataFrame:
    """Only customer-managed keys; vendor-managed keys and keys without a manager are left out."""
    seg = F.col("c_mktsegment")
    manager = F.when(seg == "BUILDING", F.lit("AWS")).when(seg != "MACHINERY", F.lit("CUSTOMER"))
    base = table(spark, sf, "customer")

    def pages(doc: Column, name: str) -> DataFrame:
        rows = base.select(
            F.lit("a").alias("account_id"), F.lit("n").alias("account_name"), F.lit("r").alias("region"), F.to_json(doc).alias("doc")
        )
        return landed.parse_pages(rows, delivery.KMS.raw[name])

    key_id = text("c_custkey").alias("KeyId")
    raw = {
        "keys": pages(F.struct(F.struct(key_id, manager.alias("KeyManager")).alias("KeyMetadata")), "keys"),
        "aliases": pages(F.struct(key_id), "aliases"),
        "tags": pages(F.struct(key_id), "tags"),
    }
    return delivery.flatten_kms(raw).select(F.col("key_id").cast("long").alias("id"))


@check(
    "filter_region",
    """SELECT o_orderkey, s.service FROM orders JOIN (VALUES ('cloudtrail', 'O'), ('ec2', 'F'), ('s3', 'P')) s(service, st)
       ON s.st = o_orderstatus WHERE o_orderpriority = '1-URGENT'""",
)
def filter_region(spark: SparkSession, sf: str) -> DataFrame:
    """Global services from one region only, for the selected services (audit log first)."""
    chosen = select_services(["s3", "ec2", "cloudtrail"])
    letters = dict(zip(chosen, ("O", "F", "P")))
    region = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("us-east-1")).otherwise(F.lit("eu-west-1"))
    service = F.create_map(*[F.lit(x) for s, letter in letters.items() for x in (letter, s)])
    o = table(spark, sf, "orders").withColumns({"region": region, "service": F.try_element_at(service, F.col("o_orderstatus"))})
    return o.where((F.col("region") == "us-east-1") & F.col("service").isin(chosen)).select("o_orderkey", "service")


@check(
    "reject_invalid",
    """SELECT 'valid' AS side, event_id FROM events WHERE event_type IN ('click', 'signup', 'purchase')
       UNION ALL SELECT 'rejected', event_id FROM events WHERE event_type IN ('view', 'error')""",
)
def reject_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """Views lack their id and errors are malformed: both go to quarantine, nothing is lost."""
    kind = F.col("event_type")
    doc = F.when(kind == "view", F.lit('{"name": "n"}')).when(kind == "error", F.lit('{"id": "1"')).otherwise(
        F.format_string('{"id": "%s", "name": "n"}', text("event_id"))
    )
    parsed = table(spark, sf, "events").select(
        "event_id",
        F.from_json(doc, "id string, name string, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"),
    ).select("event_id", "d.*")
    valid, rejected = landed.split_invalid(parsed, "id", "_corrupt")
    return valid.select(F.lit("valid").alias("side"), "event_id").unionByName(
        rejected.select(F.lit("rejected").alias("side"), "event_id")
    )


@check(
    "union_sources",
    """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""",
)
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return report.union_all([c, s])


# ---------------------------------------------------------------- run reports


@check(
    "work_grid_coverage",
    """WITH r AS (SELECT CAST(s_nationkey AS VARCHAR) AS account_id, CASE WHEN s_acctbal > 5000 THEN 'EUROPE' ELSE 'ASIA' END AS region FROM supplier)
    SELECT CAST(n_nationkey AS VARCHAR) AS account_id, n_name AS account_name, r_name AS region, count(r.account_id) AS "rows"
    FROM nation CROSS JOIN region LEFT JOIN r ON r.account_id = CAST(n_nationkey AS VARCHAR) AND r.region = r_name
    GROUP BY ALL""",
)
def work_grid_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Every account in every region, with the resources found there."""
    accounts = table(spark, sf, "nation").select(text("n_nationkey").alias("account_id"), F.col("n_name").alias("account_name"))
    regions = table(spark, sf, "region").select(F.col("r_name").alias("region"))
    found = table(spark, sf, "supplier").select(
        text("s_nationkey").alias("account_id"),
        F.when(F.col("s_acctbal") > 5000, F.lit("EUROPE")).otherwise(F.lit("ASIA")).alias("region"),
    )
    return report.coverage(report.work_grid(accounts, regions), found)


@check(
    "errors_by_account",
    """WITH e AS (SELECT DISTINCT s_nationkey, CASE WHEN s_acctbal > 5000 THEN 'EUROPE' ELSE 'ASIA' END AS region FROM supplier),
    a AS (SELECT CAST(s_nationkey AS VARCHAR) AS account_id, string_agg(region || ': denied', '; ' ORDER BY region) AS errors
          FROM e GROUP BY s_nationkey)
    SELECT *, (SELECT count(*) FROM a) AS unreachable_accounts FROM a""",
)
def errors_by_account(spark: SparkSession, sf: str) -> DataFrame:
    errors = (
        table(spark, sf, "supplier")
        .select(
            text("s_nationkey").alias("account_id"),
            F.when(F.col("s_acctbal") > 5000, F.lit("EUROPE")).otherwise(F.lit("ASIA")).alias("region"),
            F.lit("denied").alias("error"),
        )
        .distinct()
    )
    lists = report.errors_by_account(errors).select("account_id", F.array_join("errors", "; ").alias("errors"))
    return lists.withColumn("unreachable_accounts", report.unreachable(errors).scalar())
