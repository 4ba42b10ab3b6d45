"""Stacks, audit trails, associations, state machines, delivery pipelines, builds, topics, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.functions.dates import micros_text, utc_naive
from inventrace.functions.text import (
    MISSING,
    clip,
    first_items,
    count_of,
    ids,
    join_or,
    last_segment,
    or_default,
    or_default_blank,
)
from inventrace.operators.rollup import ageing, compliance, distinct_prefixes
from inventrace.sources.landed import by_key, items
from inventrace.specs.model import PROVENANCE, Raw, ResourceSpec

TAGS = "array<struct<Key: string, Value: string>>"
SCOPE = ["account_id", "region"]


def _scope_columns() -> list[Column]:
    return [
        F.col("region"),
        F.col("account_name"),
        F.col("account_id"),
    ]


def flatten_cloudformation(raw: Raw) -> DataFrame:
    d = F.col("d")
    live = items(raw["stacks"], "Stacks").where(~d["StackStatus"].eqNullSafe(F.lit("DELETE_COMPLETE")))
    return live.select(
        d["StackName"].alias("stack_name"),
        or_default(d["StackStatus"]).alias("stack_status"),
        utc_naive(d["CreationTime"]).alias("creation_time"),
        or_default_blank(d["Description"]).alias("description"),
        join_or(d["Capabilities"]).alias("capabilities"),
        *_scope_columns(),
    )


CLOUDFORMATION = ResourceSpec(
    table="cloudformation",
    service="cloudformation",
    service_type="CLOUDFORMATION",
    columns=(
        "stack_name string, stack_status string, creation_time timestamp_ntz, description string, "
        "capabilities string, region string, account_name string, account_id string"
    ),
    key=("stack_name", "account_id", "region"),
    resource_id="stack_name",
    comparators={"capabilities": "comma_trimmed"},
    raw={
        "stacks": (
            "Stacks array<struct<StackName: string, StackStatus: string, CreationTime: string, "
            f"Description: string, Capabilities: array<string>, Tags: {TAGS}>>"
        )
    },
    flatten=flatten_cloudformation,
)


def yes_no(flag: Column, default: bool) -> Column:
    return F.when(F.coalesce(flag, F.lit(default)), F.lit("Yes")).otherwise(F.lit("No"))


def log_uri(bucket: Column, prefix: Column) -> Column:
    uri = F.concat(F.lit("s3://"), bucket, F.lit("/"), or_default(prefix, ""))
    return F.when(F.coalesce(bucket, F.lit(MISSING)) != MISSING, uri).otherwise(F.lit(MISSING))


def flatten_trails(raw: Raw) -> DataFrame:
    d = F.col("d")
    return items(raw["trails"], "trailList").select(
        d["Name"].alias("trail_name"),
        log_uri(d["S3BucketName"], d["S3KeyPrefix"]).alias("log_location"),
        yes_no(d["IsMultiRegionTrail"], False).alias("is_multi_region"),
        yes_no(d["IsOrganizationTrail"], False).alias("is_organization"),
        yes_no(d["IncludeGlobalServiceEvents"], True).alias("include_global_events"),
        *_scope_columns(),
    )


TRAILS = ResourceSpec(
    table="cloudtrail_trails",
    service="cloudtrail_trails",
    service_type="CLOUDTRAIL",
    columns=(
        "trail_name string, log_location string, is_multi_region string, is_organization string, "
        "include_global_events string, region string, account_name string, account_id string"
    ),
    key=("trail_name", "account_id"),
    resource_id="trail_name",
    raw={
        "trails": (
            "trailList array<struct<Name: string, S3BucketName: string, S3KeyPrefix: string, "
            "IsMultiRegionTrail: boolean, IsOrganizationTrail: boolean, IncludeGlobalServiceEvents: boolean>>"
        )
    },
    flatten=flatten_trails,
)


def flatten_ssm(raw: Raw) -> DataFrame:
    d = F.col("d")
    base = items(raw["associations"], "Associations").withColumn("_id", d["AssociationId"])
    checks = items(raw["compliance"], "ComplianceItems").select(*SCOPE, d["Id"].alias("_id"), d["Status"].alias("Status"))
    joined = base.join(compliance(checks, [*SCOPE, "_id"]), [*SCOPE, "_id"], "left")
    zero = F.lit(0).cast("long")
    defaults = ageing(zero, zero)
    return joined.select(
        F.col("_id").alias("association_id"),
        or_default(d["Name"]).alias("association_name"),
        or_default(d["DocumentName"]).alias("domain"),
        *[F.coalesce(c, zero).alias(c) for c in ("compliant_resources", "non_compliant_resources")],
        *[F.coalesce(F.col(c), v).alias(c) for c, v in defaults.items()],
        *_scope_columns(),
    )


SSM = ResourceSpec(
    table="ssm",
    service="ssm",
    service_type="SSM",
    columns=(
        "association_id string, association_name string, domain string, compliant_resources bigint, "
        "non_compliant_resources bigint, compliance_percentage double, non_compliant_15_days bigint, "
        "non_compliant_15_90_days bigint, non_compliant_90_days bigint, region string, account_name string, "
        "account_id string"
    ),
    key=("association_id",),
    resource_id="association_id",
    raw={
        "associations": "Associations array<struct<AssociationId: string, Name: string, DocumentName: string>>",
        "compliance": "ComplianceItems array<struct<Id: string, Status: string>>",
    },
    flatten=flatten_ssm,
)


def flatten_stepfunctions(raw: Raw, recent_executions: int | None = None) -> DataFrame:
    """State machines; triggers are told from the names of all landed executions, or of the first ``recent_executions``."""
    d = F.col("d")
    base = items(raw["state_machines"], "stateMachines").withColumn("_arn", d["stateMachineArn"])
    key = [*SCOPE, "_arn"]

    arn = F.col("doc.stateMachineArn")
    details = by_key(raw["details"], arn, "_arn", first={"_role": or_default(F.col("doc.roleArn"))})
    versions = by_key(raw["versions"], arn, "_arn", lists={"_list": F.col("doc.stateMachineVersions")})
    versions = versions.select(*key, count_of(F.col("_list")).alias("_versions"))
    names = F.transform("doc.executions", lambda e: e["name"])
    runs = by_key(raw["executions"], arn, "_arn", lists={"_list": names})
    runs = runs.select(*key, distinct_prefixes(F.col("_list"), recent_executions).alias("_triggers"))
    joined = base.join(details, key, "left").join(versions, key, "left").join(runs, key, "left")
    found = F.col("_role").isNotNull()
    role = F.when(F.col("_role") != MISSING, last_segment(F.col("_role"), "/"))
    return joined.select(
        F.col("_arn").alias("stepfunction_arn"),
        last_segment(F.col("_arn"), ":").alias("instance_id"),
        or_default(d["name"]).alias("stepfunction_name"),
        or_default(d["definition"]).alias("description"),
        F.when(found, or_default(F.col("_triggers"), 1)).otherwise(F.lit(1)).cast("long").alias("triggers"),
        F.when(found, or_default(F.col("_versions"), 1)).otherwise(F.lit(1)).cast("long").alias("versions"),
        or_default(role).alias("roles_permissions"),
        or_default(d["status"], "ACTIVE").alias("status"),
        *_scope_columns(),
    )


STEPFUNCTIONS = ResourceSpec(
    table="stepfunctions",
    service="stepfunctions",
    service_type="STEP-FUNCTIONS",
    columns=(
        "stepfunction_arn string, instance_id string, stepfunction_name string, description string, "
        "triggers bigint, versions bigint, roles_permissions string, status string, region string, "
        "account_name string, account_id string"
    ),
    key=("stepfunction_arn",),
    resource_id="stepfunction_arn",
    raw={
        "state_machines": (
            "stateMachines array<struct<stateMachineArn: string, name: string, definition: string, status: string>>"
        ),
        "details": "stateMachineArn string, roleArn string",
        "versions": "stateMachineArn string, stateMachineVersions array<struct<stateMachineVersionArn: string>>",
        "executions": "stateMachineArn string, executions array<struct<name: string>>",
    },
    flatten=flatten_stepfunctions,
)


def flatten_codepipeline(raw: Raw, recent_runs: int | None = None, shown_revisions: int | None = None, revision_chars: int | None = 10) -> DataFrame:
    """Pipelines with their landed runs; the parameters bound the runs that count and the revisions shown, whose ids are abbreviated (None: whole)."""
    d, runs, last = F.col("d"), F.col("_runs"), F.col("_last")
    base = items(raw["listed"], "pipelines").withColumn("_name", d["name"])
    listed = by_key(raw["executions"], F.col("doc.pipelineName"), "_name", lists={"_all": F.col("doc.pipelineExecutionSummaries")})
    summaries = listed.select(*SCOPE, "_name", first_items(F.col("_all"), recent_runs).alias("_runs"))
    joined = base.join(summaries, [*SCOPE, "_name"], "left").withColumn("_last", F.get("_runs", F.lit(0)))
    revisions = F.transform(
        last["sourceRevisions"],
        lambda r: F.concat(or_default(r["actionName"]), F.lit(":"), or_default(r["revisionId"]) if revision_chars is None else clip(or_default(r["revisionId"]), revision_chars)),
    )
    status = (
        F.when(runs.isNull(), F.lit("Unknown"))
        .when(F.size(runs) == 0, F.lit("Never executed"))
        .otherwise(or_default(last["status"], "Unknown"))
    )
    return joined.select(
        F.col("_name").alias("pipeline_name"),
        status.alias("last_execution_status"),
        join_or(revisions, first=shown_revisions).alias("latest_source_revisions"),
        micros_text(last["startTime"]).alias("last_execution_started"),
        count_of(runs).alias("recent_executions"),
        *_scope_columns(),
    )


CODEPIPELINE = ResourceSpec(
    table="codepipeline",
    service="codepipeline",
    service_type="CODEPIPELINE",
    columns=(
        "pipeline_name string, last_execution_status string, latest_source_revisions string, "
        "last_execution_started string, recent_executions bigint, region string, account_name string, "
        "account_id string"
    ),
    key=("pipeline_name", "account_id"),
    resource_id="pipeline_name",
    raw={
        "listed": "pipelines array<struct<name: string>>",
        "executions": (
            "pipelineName string, pipelineExecutionSummaries array<struct<status: string, startTime: string, "
            "sourceRevisions: array<struct<actionName: string, revisionId: string>>>>"
        ),
    },
    flatten=flatten_codepipeline,
)


def flatten_codebuild(raw: Raw) -> DataFrame:
    """Projects with their details; a listed project without details is left out."""
    d = F.col("d")
    listed = raw["listed"].select(*SCOPE, F.explode("doc.projects").alias("_name"))
    details = items(raw["projects"], "projects").withColumn("_name", or_default(d["name"]))
    return details.join(listed.distinct(), [*SCOPE, "_name"], "left_semi").select(
        F.col("_name").alias("project_name"),
        or_default(d["source"]["type"]).alias("source_provider"),
        or_default(d["source"]["location"]).alias("repository"),
        F.lit(MISSING).alias("last_build_status"),
        or_default(d["description"]).alias("description"),
        micros_text(d["lastModified"]).alias("last_modified"),
        *PROVENANCE,
    )


CODEBUILD = ResourceSpec(
    table="codebuild",
    service="codebuild",
    service_type="CODEBUILD",
    columns=(
        "project_name string, source_provider string, repository string, last_build_status string, "
        "description string, last_modified string, account_name string, account_id string"
    ),
    key=("project_name", "account_id"),
    resource_id="project_name",
    uncompared=("account_name",),
    fixed_region="us-east-1",
    raw={
        "listed": "projects array<string>",
        "projects": (
            "projects array<struct<name: string, source: struct<type: string, location: string>, "
            "description: string, lastModified: string>>"
        ),
    },
    flatten=flatten_codebuild,
)


def flatten_sns(raw: Raw) -> DataFrame:
    d = F.col("d")
    arn = or_default(d["TopicArn"])
    name = F.when(arn != MISSING, last_segment(arn, ":")).otherwise(F.lit(MISSING))
    return items(raw["topics"], "Topics").select(
        arn.alias("topic_arn"),
        name.alias("topic_name"),
        F.lit(MISSING).alias("domain"),
        name.alias("display_name"),
        F.lit("Standard").alias("type"),
        *PROVENANCE,
    )


SNS = ResourceSpec(
    table="sns",
    service="sns",
    service_type="SNS",
    columns=(
        "topic_arn string, topic_name string, domain string, display_name string, type string, "
        "account_name string, account_id string"
    ),
    key=("topic_arn", "account_id"),
    resource_id="topic_arn",
    uncompared=("account_name",),
    fixed_region="us-east-1",
    raw={"topics": "Topics array<struct<TopicArn: string>>"},
    flatten=flatten_sns,
)

# Key type labels.
SYMMETRIC, ASYMMETRIC = "Simétrica", "Asimétrica"


def key_type(spec: Column) -> Column:
    return F.when(spec == "SYMMETRIC_DEFAULT", F.lit(SYMMETRIC)).otherwise(F.lit(ASYMMETRIC))


def flatten_kms(raw: Raw) -> DataFrame:
    """Customer-managed keys with their aliases and tags."""
    d = F.col("d")
    own = items(raw["keys"], "").where(d["KeyMetadata"]["KeyManager"] == "CUSTOMER")
    base = own.select("account_id", "account_name", "region", d["KeyMetadata"].alias("d")).withColumn("_id", d["KeyId"])
    key = [*SCOPE, "_id"]
    key_id = F.col("doc.KeyId")
    aliases = by_key(raw["aliases"], key_id, "_id", lists={"_aliases": ids(F.col("doc.Aliases"), "AliasName")})
    tags = by_key(raw["tags"], key_id, "_id", lists={"_tags": F.col("doc.Tags")})
    spec = or_default(d["KeySpec"], "SYMMETRIC_DEFAULT")
    return base.join(aliases, key, "left").join(tags, key, "left").select(
        F.col("_id").alias("key_id"),
        join_or(F.col("_aliases")).alias("key_name"),
        or_default(d["KeyState"]).alias("estado"),
        key_type(spec).alias("key_type"),
        spec.alias("key_spec"),
        F.coalesce("_tags", F.expr("cast(array() as array<struct<TagKey: string, TagValue: string>>)")).alias("tags"),
        *PROVENANCE,
    )


_KMS_TAGS = "array<struct<TagKey: string, TagValue: string>>"

KMS = ResourceSpec(
    table="kms",
    service="kms",
    service_type="KMS",
    columns=(
        "key_id string, key_name string, estado string, key_type string, key_spec string, "
        f"tags {_KMS_TAGS}, account_name string, account_id string"
    ),
    key=("key_id", "account_id"),
    resource_id="key_id",
    comparators={c: "list" for c in ("key_name", "estado", "key_type", "key_spec", "tags", "account_name")},
    compact_names=True,
    fixed_region="us-east-1",
    raw={
        "keys": "KeyMetadata struct<KeyId: string, KeyManager: string, KeyState: string, KeySpec: string>",
        "aliases": "KeyId string, Aliases array<struct<AliasName: string>>",
        "tags": f"KeyId string, Tags {_KMS_TAGS}",
    },
    flatten=flatten_kms,
)

SPECS = [CLOUDFORMATION, TRAILS, SSM, STEPFUNCTIONS, CODEPIPELINE, CODEBUILD, SNS, KMS]
