"""Audit-log queries: parsing, filters, resource and user names, change summaries, funnel, stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import RUN_TIME, check, run_ts, table, text
from inventrace import session
from inventrace.functions import audit
from inventrace.operators import report
from inventrace.plans import audit_log
from inventrace.streaming import audit_stream

#: Event type of the given table -> audit event name and source.
AS_AUDIT = {
    "view": ("StartInstances", "ec2.amazonaws.com"),
    "signup": ("CreateBucket", "s3.amazonaws.com"),
    "click": ("DescribeInstances", "ec2.amazonaws.com"),
    "purchase": ("UpdateProject", "codebuild.amazonaws.com"),
    "error": ("CreateTrail", "cloudtrail.amazonaws.com"),
}


def pick(kind: Column, index: int) -> Column:
    col = F.lit(None).cast("string")
    for name, pair in AS_AUDIT.items():
        col = F.when(kind == name, F.lit(pair[index])).otherwise(col)
    return col


def as_audit(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events", spread=True)
    return ev.withColumns(
        {
            "event_name": pick(F.col("event_type"), 0),
            "event_source": pick(F.col("event_type"), 1),
            "account_id": F.concat(F.lit("a"), text(F.col("user_id") % 5)),
            "account_name": F.concat(F.lit("acct "), text(F.col("user_id") % 5)),
            "region": F.concat(F.lit("r"), text(F.col("user_id") % 3)),
        }
    )


def named(i: int) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v[i]}'" for k, v in AS_AUDIT.items()) + " END"


AUDIT_SQL = f"""
au AS (SELECT *, {named(0)} AS event_name, {named(1)} AS event_source, 'a' || (user_id % 5) AS account_id,
         'r' || (user_id % 3) AS region FROM events)
"""


def payload() -> Column:
    """A full event document; its request differs by event type."""
    request = (
        F.when(
            F.col("event_type") == "view",
            F.to_json(F.struct(F.struct(F.array(F.struct(F.concat(F.lit("i-"), text("user_id")).alias("instanceId"))).alias("items")).alias("instancesSet"))),
        )
        .when(
            F.col("event_type") == "signup",
            F.to_json(F.struct(F.concat(F.lit("b-"), text("user_id")).alias("bucketName"), F.col("value").alias("n"))),
        )
        .otherwise(F.lit("null"))
    )
    head = F.to_json(
        F.struct(
            text("event_id").alias("eventID"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
            F.col("event_name").alias("eventName"),
            F.col("event_source").alias("eventSource"),
            F.struct(F.concat(F.lit("arn:aws:sts::1:assumed-role/adm/u"), text("user_id")).alias("arn")).alias("userIdentity"),
        )
    )
    return F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(', "requestParameters": '), request, F.lit("}"))


def pages(spark: SparkSession, sf: str, text_of: Column) -> DataFrame:
    """Landed pages holding two events each: the event and an empty payload."""
    envelope = F.array(F.struct(text_of.alias("CloudTrailEvent")), F.struct(F.lit("").alias("CloudTrailEvent")))
    return as_audit(spark, sf).select("account_id", "account_name", "region", F.struct(envelope.alias("Events")).alias("doc"))


@check(
    "audit_parse_skip_bad",
    f"""WITH {AUDIT_SQL}
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_name, 'u' || user_id AS user_name, account_id, region
    FROM au WHERE event_type NOT IN ('error', 'purchase')""",
)
def audit_parse_skip_bad(spark: SparkSession, sf: str) -> DataFrame:
    """Errors carry cut payloads, purchases a JSON array: both are skipped, the rest is read."""
    kind = F.col("event_type")
    cut = F.when(kind == "error", F.substr(payload(), F.lit(1), F.length(payload()) - 3)).when(
        kind == "purchase", F.lit("[1, 2]")
    ).otherwise(payload())
    parsed = audit_log.parse_events(audit_log.event_texts(pages(spark, sf, cut)))
    return parsed.select(
        F.col("d.eventID").alias("event_id"),
        F.col("d.eventName").alias("event_name"),
        audit.user_name(F.col("d.userIdentity")).alias("user_name"),
        "account_id",
        "region",
    )


@check(
    "res_cloudtrail_events",
    f"""WITH {AUDIT_SQL}
    SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, event_name,
      event_source, 'u' || user_id AS user_name,
      CASE event_type WHEN 'view' THEN 'i-' || user_id WHEN 'signup' THEN 'b-' || user_id ELSE 'updateproject' END AS resource_name,
      CASE event_type WHEN 'view' THEN 'EC2' WHEN 'signup' THEN 'S3' ELSE 'CODEBUILD' END AS resource_type, region,
      CASE event_type WHEN 'view' THEN '{{"instances":"i-' || user_id || '","action":"start"}}'
        WHEN 'signup' THEN '{{"action":"createbucket","bucket":"b-' || user_id || '"}}' ELSE '{{"action":"updateproject"}}' END AS changes,
      account_id, 'acct ' || (user_id % 5) AS account_name
    FROM au WHERE event_type IN ('view', 'signup', 'purchase')
      AND date_trunc('second', ts) BETWEEN TIMESTAMP '{RUN_TIME}' - INTERVAL 10 DAY AND TIMESTAMP '{RUN_TIME}'""",
)
def res_cloudtrail_events(spark: SparkSession, sf: str) -> DataFrame:
    """Pages to typed events: parse, important filter, look-back, names, types and summaries."""
    events = audit_log.events_from_pages(pages(spark, sf, payload()), run_ts())
    return events.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))


@check(
    "event_filter_semi",
    f"""WITH {AUDIT_SQL}
    SELECT event_id, event_name, event_source FROM au WHERE event_type IN ('view', 'signup', 'purchase')
      AND ts >= TIMESTAMP '{RUN_TIME}' - INTERVAL 10 DAY AND ts <= TIMESTAMP '{RUN_TIME}'""",
)
def event_filter_semi(spark: SparkSession, sf: str) -> DataFrame:
    """Both the name and the source must be listed; the name DescribeInstances and the source cloudtrail are not."""
    recent = audit_log.recent(as_audit(spark, sf), run_ts(), ts="ts")
    return audit_log.important(recent, "event_name", "event_source").select("event_id", "event_name", "event_source")


@check(
    "event_type_lookup",
    f"""WITH {AUDIT_SQL}
    SELECT event_id, CASE event_source WHEN 'ec2.amazonaws.com' THEN 'EC2' WHEN 's3.amazonaws.com' THEN 'S3'
      WHEN 'cloudtrail.amazonaws.com' THEN 'CLOUDTRAIL' WHEN 'codebuild.amazonaws.com' THEN 'CODEBUILD' ELSE 'UNKNOWN' END AS resource_type,
      event_source = 's3.amazonaws.com' OR event_source LIKE 'ec2%' AS valid FROM au""",
)
def event_type_lookup(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("event_type").isin("view", "click"), F.lit("i-1")).otherwise(F.lit("x"))
    return as_audit(spark, sf).select(
        "event_id",
        audit.resource_type(F.col("event_source")).alias("resource_type"),
        audit.valid_resource(name, F.col("event_source")).alias("valid"),
    )


@check(
    "ingest_funnel",
    f"""WITH {AUDIT_SQL}
    SELECT region, account_id, count(*) AS total, count(*) FILTER (WHERE event_type IN ('view', 'signup', 'purchase')) AS important,
      count(*) FILTER (WHERE event_type IN ('view', 'purchase')) AS inserted FROM au GROUP BY region, account_id""",
)
def ingest_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """All polled events, those that are important, and those not stored before (signups are)."""
    ev = as_audit(spark, sf)
    stored = ev.where(F.col("event_type") == "signup").select("event_id", F.lit(True).alias("stored"))
    marked = ev.withColumn("important", audit_log.is_important(F.col("event_name"), F.col("event_source"))).join(stored, "event_id", "left")
    flags = marked.withColumn("inserted", F.col("important") & F.col("stored").isNull())
    return report.ingest_funnel(flags, ["region", "account_id"])


@check(
    "json_extract_priority",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'r-' || event_id WHEN 'click' THEN 'vol-' || event_id
      WHEN 'signup' THEN 'resp-' || event_id WHEN 'purchase' THEN 'second-' || user_id
      ELSE 'unknown' END AS resource_name FROM events""",
)
def json_extract_priority(spark: SparkSession, sf: str) -> DataFrame:
    """One rung of the ladder per event type: item set, request field, response field, any id-like key, none."""
    kind, eid, uid = F.col("event_type"), text("event_id"), text("user_id")

    def js(template: str, *values: Column) -> Column:
        return F.format_string(template, *values)

    req = (
        F.when(kind == "view", js('{"instanceId": "i-x", "resourcesSet": {"items": [{"resourceId": "r-%s"}]}}', eid))
        .when(kind == "click", js('{"groupId": "g-1", "instanceId": "", "volumeId": "vol-%s"}', eid))
        .when(kind == "signup", F.lit('{"zoneId": "z", "n": 1}'))
        # The excluded, numeric and empty keys are passed over; dbName comes before aName and keeps its place,
        # with the value of the response.
        .when(
            kind == "purchase",
            js('{"requestId": "q", "sizeId": 7, "emptyName": "", "dbName": "first-%s", "aName": "x"}', uid),
        )
        .otherwise(F.lit('{"userName": "me", "note": "n", "count": 3}'))
    )
    resp = (
        F.when(kind == "signup", js('{"name": "late", "instanceId": "resp-%s"}', eid))
        .when(kind == "purchase", js('{"zzz": 1, "dbName": "second-%s"}', uid))
        .otherwise(F.lit(None).cast("string"))
    )
    ev = table(spark, sf, "events", spread=True).withColumns({"req": req, "resp": resp})
    ev = ev.withColumns({"rv": F.try_parse_json("req"), "pv": F.try_parse_json("resp")})
    source = F.lit("ec2.amazonaws.com")
    name = audit.resource_name(source, F.col("req"), F.col("rv"), F.col("resp"), F.col("pv"))
    return ev.select("event_id", name.alias("resource_name"))


@check(
    "user_chain_last50",
    """SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN c_name WHEN c_nationkey < 10 THEN right(repeat('p', 60) || c_name, 50)
      WHEN c_nationkey < 15 THEN 'me' || c_custkey WHEN c_nationkey < 20 THEN 'Root' ELSE 'system' END AS user_name FROM customer""",
)
def user_chain_last50(spark: SparkSession, sf: str) -> DataFrame:
    key, none = F.col("c_nationkey"), F.lit(None).cast("string")
    identity = F.struct(
        F.when(key < 5, F.col("c_name")).when(key < 10, F.lit("")).alias("userName"),
        F.when(key < 10, F.concat(F.lit("arn:x/role/"), F.repeat(F.lit("p"), F.lit(60)), F.col("c_name"))).alias("arn"),
        F.when((key >= 10) & (key < 15), F.concat(F.lit("AIDA:me"), text("c_custkey"))).alias("principalId"),
        F.when((key >= 15) & (key < 20), F.lit("Root")).when(key < 23, F.lit("unknown")).otherwise(none).alias("type"),
    )
    return table(spark, sf, "customer").select("c_custkey", audit.user_name(identity).alias("user_name"))


@check(
    "change_summary_json",
    """SELECT event_id, CASE CAST(floor(value) AS BIGINT) % 15
      WHEN 0 THEN '{"tags":"Name=' || user_id || ', env="}' WHEN 1 THEN '{"instances":"i-1, i-' || user_id || '","action":"stop"}'
      WHEN 2 THEN '{"action":"attachvolume","volume":"v' || user_id || '"}'
      WHEN 3 THEN '{"action":"createsubnet","cidr":"10.0.0.0/16","vpc":"vpc' || user_id || '"}'
      WHEN 4 THEN '{"action":"reboot","instance":"db' || user_id || '"}'
      WHEN 5 THEN '{"attributes":"instanceType={''value'': ''t3.large''}, disableApiTermination=True"}'
      WHEN 6 THEN '{"public_ip":"False"}' WHEN 7 THEN '{"attributes":"enableDnsSupport=False"}'
      WHEN 8 THEN '{"tags":"team=' || user_id || '"}' WHEN 9 THEN '{"action":"enable_encryption","encryption":"enabled"}'
      WHEN 10 THEN '{"versioning":"suspended"}' WHEN 11 THEN '{"deleted_images":"2"}'
      WHEN 12 THEN '{"action":"update_config","fields":"logging, access"}' WHEN 13 THEN '{"action":"createtags"}'
      ELSE '{"action":"runinstances"}' END AS changes FROM events""",
)
def change_summary_json(spark: SparkSession, sf: str) -> DataFrame:
    uid = text("user_id")
    cases: list[tuple[str, str]] = [
        ("CreateTags", '{"tagSet": {"items": [{"key": "Name", "value": "%s"}, {"key": "env"}]}}'),
        ("StopInstances", '{"instancesSet": {"items": [{"instanceId": "i-1"}, {"instanceId": "i-%s"}]}}'),
        ("AttachVolume", '{"instanceId": "", "volumeId": "v%s"}'),
        ("CreateSubnet", '{"vpcId": "vpc%s", "cidrBlock": "10.0.0.0/16"}'),
        ("RebootDBInstance", '{"dBInstanceIdentifier": "db%s"}'),
        ("ModifyInstanceAttribute", '{"disableApiTermination": true, "instanceType": {"value": "t3.large"}, "x": "%s"}'),
        ("ModifySubnetAttribute", '{"mapPublicIpOnLaunch": false, "x": "%s"}'),
        ("ModifyVpcAttribute", '{"enableDnsSupport": false, "x": "%s"}'),
        ("PutBucketTagging", '{"tagging": {"tagSet": [{"key": "team", "value": "%s"}]}}'),
        ("PutBucketEncryption", '{"bucketName": "%s"}'),
        ("PutBucketVersioning", '{"versioningConfiguration": {"status": "Suspended"}, "b": "%s"}'),
        ("BatchDeleteImage", '{"imageIds": [{"imageTag": "%s"}, {"imageTag": "b"}]}'),
        ("UpdateClusterConfig", '{"update": {"logging": {"k": "%s"}, "access": 1}}'),
        ("CreateTags", '{"tagSet": {"items": []}, "x": "%s"}'),
        ("RunInstances", '{"imageId": "%s"}'),
    ]
    index = F.floor("value").cast("long") % len(cases)
    name, req = F.lit(cases[-1][0]), F.format_string(cases[-1][1], uid)
    for i, (event, template) in enumerate(cases[:-1]):
        name = F.when(index == i, F.lit(event)).otherwise(name)
        req = F.when(index == i, F.format_string(template, uid)).otherwise(req)
    ev = table(spark, sf, "events", spread=True).withColumns({"name": name, "req": req})
    ev = ev.withColumn("rv", F.try_parse_json("req"))
    return ev.select("event_id", audit.change_summary(F.col("name"), F.col("req"), F.col("rv")).alias("changes"))


@check(
    "stream_audit_dedup",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS event_name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time
       FROM events""",
)
def stream_audit_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream in which each event comes twice; each id is written once."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    twice = stream.withColumn("poll", F.explode(F.array(F.lit(1), F.lit(2))))
    typed = twice.select(text("event_id").alias("event_id"), F.col("event_type").alias("event_name"), F.col("ts").alias("event_time"))
    out = session.scratch(spark, "stream")
    audit_stream.start(audit_stream.once_per_id(typed), f"{out}/events", f"{out}/checkpoint", None).awaitTermination()
    done = spark.read.parquet(f"{out}/events")
    return done.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
