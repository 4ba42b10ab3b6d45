"""Databases, warehouses, buckets, ETL jobs, ad-hoc SQL queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.functions.dates import utc_naive, utc_text
from inventrace.functions.text import (
    MISSING,
    clip,
    count_of,
    first_table,
    flags,
    human_bytes,
    join_or,
    or_default,
    tag_value,
    tag_value_last,
)
from inventrace.operators.gather import lookup
from inventrace.operators.rollup import latest_total, newest
from inventrace.sources.landed import items
from inventrace.specs.model import PROVENANCE, Raw, ResourceSpec

TAGS = "array<struct<Key: string, Value: string>>"
SCOPE = ["account_id", "region"]


def _scope_columns() -> list[Column]:
    return [
        F.col("region"),
        F.col("account_name"),
        F.col("account_id"),
    ]


def flatten_rds(raw: Raw) -> DataFrame:
    d = F.col("d")
    base = items(raw["instances"], "DBInstances").withColumn("_group", d["DBSubnetGroup"]["DBSubnetGroupName"])
    groups = items(raw["subnet_groups"], "DBSubnetGroups").select(
        *SCOPE, d["DBSubnetGroupName"].alias("_group"), d["VpcId"].alias("vpc")
    )
    return lookup(base, groups, [*SCOPE, "_group"], "vpc", F.lit(MISSING)).select(
        d["DBInstanceIdentifier"].alias("db_instance_id"),
        or_default(d["DBName"]).alias("db_name"),
        d["Engine"].alias("engine_type"),
        or_default(d["EngineVersion"]).alias("engine_version"),
        or_default(d["AllocatedStorage"].cast("string")).alias("storage_size"),
        d["DBInstanceClass"].alias("instance_type"),
        d["DBInstanceStatus"].alias("status"),
        "region",
        or_default(d["Endpoint"]["Address"]).alias("endpoint"),
        or_default(d["Endpoint"]["Port"].cast("string")).alias("port"),
        "vpc",
        (count_of(d["ReadReplicaDBInstanceIdentifiers"]) > 0).alias("has_replica"),
        *PROVENANCE,
    )


RDS = ResourceSpec(
    table="rds",
    service="rds",
    service_type="RDS",
    columns=(
        "db_instance_id string, db_name string, engine_type string, engine_version string, storage_size string, "
        "instance_type string, status string, region string, endpoint string, port string, vpc string, "
        "has_replica boolean, account_name string, account_id string"
    ),
    key=("db_instance_id", "account_id"),
    resource_id="db_instance_id",
    compact_names=True,
    raw={
        "instances": (
            "DBInstances array<struct<DBInstanceIdentifier: string, DBName: string, Engine: string, "
            "EngineVersion: string, AllocatedStorage: bigint, DBInstanceClass: string, DBInstanceStatus: string, "
            "Endpoint: struct<Address: string, Port: bigint>, DBSubnetGroup: struct<DBSubnetGroupName: string>, "
            "ReadReplicaDBInstanceIdentifiers: array<string>>>"
        ),
        "subnet_groups": "DBSubnetGroups array<struct<DBSubnetGroupName: string, VpcId: string>>",
    },
    flatten=flatten_rds,
)


def flatten_redshift(raw: Raw) -> DataFrame:
    d = F.col("d")
    return items(raw["clusters"], "Clusters").select(
        d["ClusterIdentifier"].alias("database_id"),
        tag_value_last(d["Tags"], "AppId").alias("app_id"),
        or_default(d["DBName"]).alias("database_name"),
        or_default(d["NodeType"]).alias("node_type"),
        or_default(d["NumberOfNodes"], 1).alias("node_count"),
        or_default(d["ClusterVersion"]).alias("engine_version"),
        or_default(d["TotalStorageCapacityInMegaBytes"], 0).cast("string").alias("storage_size"),
        or_default(d["ClusterStatus"]).alias("status"),
        "region",
        or_default(d["Endpoint"]["Address"]).alias("endpoint"),
        or_default(d["Endpoint"]["Port"], 0).alias("port"),
        or_default(d["ClusterSubnetGroupName"]).alias("replication"),
        *PROVENANCE,
    )


REDSHIFT = ResourceSpec(
    table="redshift",
    service="redshift",
    service_type="REDSHIFT",
    columns=(
        "database_id string, app_id string, database_name string, node_type string, node_count bigint, "
        "engine_version string, storage_size string, status string, region string, endpoint string, port bigint, "
        "replication string, account_name string, account_id string"
    ),
    key=("database_id", "account_id"),
    resource_id="database_id",
    comparators={
        c: "list"
        for c in (
            "app_id", "database_name", "node_type", "node_count", "engine_version", "storage_size", "status",
            "region", "endpoint", "port", "replication", "account_name",
        )
    },
    latest_lookup=True,
    raw={
        "clusters": (
            "Clusters array<struct<ClusterIdentifier: string, DBName: string, NodeType: string, "
            "NumberOfNodes: bigint, ClusterVersion: string, TotalStorageCapacityInMegaBytes: bigint, "
            "ClusterStatus: string, Endpoint: struct<Address: string, Port: bigint>, "
            f"ClusterSubnetGroupName: string, Tags: {TAGS}>>"
        )
    },
    flatten=flatten_redshift,
)

# Storage classes whose size metrics make up a bucket's capacity, and their look-back.
STORAGE_TYPES = ["StandardStorage", "StandardIAStorage", "ReducedRedundancyStorage", "GlacierStorage"]
METRIC_DAYS = 7


def bucket_capacity(points: DataFrame, run_ts: Column) -> DataFrame:
    """Bucket size from the latest datapoint of each storage class in the last week."""
    since = run_ts - F.expr(f"INTERVAL {METRIC_DAYS} DAYS")
    kept = points.where(F.col("StorageType").isin(STORAGE_TYPES))
    return latest_total(kept, [*SCOPE, "_name"], "StorageType", "Timestamp", "Maximum", since, "_bytes")


def flatten_s3(raw: Raw, run_ts: Column | None = None) -> DataFrame:
    """Buckets with their settings. ``raw["metrics"]``, if landed, carries size datapoints.

    Datapoints count up to a week before ``run_ts``; without it, before the time that the collector wrote next to them.
    """
    d, x = F.col("d"), F.col("x")
    key = [*SCOPE, "_name"]
    base = items(raw["buckets"], "Buckets").select(*SCOPE, "account_name", d["Name"].alias("_name"))
    details = items(raw["details"], "").select(*SCOPE, d["Bucket"].alias("_name"), d.alias("x"))
    df = base.join(details, key, "left")
    if "metrics" in raw:
        points = items(raw["metrics"], "").select(
            *SCOPE,
            d["Bucket"].alias("_name"),
            d["StorageType"].alias("StorageType"),
            utc_naive(d["Timestamp"]).alias("Timestamp"),
            d["Maximum"].alias("Maximum"),
            (utc_naive(d["RunTime"]) if run_ts is None else run_ts).alias("_run"),
        )
        sizes = bucket_capacity(points, F.col("_run"))
        capacity = human_bytes(F.coalesce("_bytes", F.lit(0)))
        df = df.join(sizes, key, "left").withColumn("_capacity", capacity)
    else:
        df = df.withColumn("_capacity", F.lit(MISSING))
    block = x["PublicAccessBlockConfiguration"]
    notify = x["NotificationConfiguration"]
    network = F.when(block.isNull(), F.lit("Unknown")).when(
        F.coalesce(block["BlockPublicAcls"], F.lit(False)), F.lit("Private")
    )
    enabled = F.lit("Enabled")
    return df.select(
        F.col("_name").alias("bucket_name"),
        tag_value(x["TagSet"], "Name", "").alias("_display"),
        F.coalesce(F.nullif(x["LocationConstraint"], F.lit("")), F.lit("us-east-1")).alias("region"),
        F.lit("Active").alias("status"),
        tag_value(x["TagSet"], "Owner").alias("owner"),
        join_or(
            flags(
                ("Lambda", count_of(notify["LambdaConfigurations"]) > 0),
                ("SQS", count_of(notify["QueueConfigurations"]) > 0),
                ("SNS", count_of(notify["TopicConfigurations"]) > 0),
            ),
            "None",
            ",",
        ).alias("integrations"),
        network.otherwise(F.lit("Public")).alias("network_config"),
        F.when(x["ReplicationConfiguration"].isNotNull(), enabled).otherwise(F.lit("Disabled")).alias("backup_recovery"),
        F.when(x["ServerSideEncryptionConfiguration"].isNotNull(), enabled)
        .otherwise(F.lit("Disabled"))
        .alias("encryption"),
        or_default(x["VersioningStatus"], "Disabled").alias("versioning"),
        F.col("_capacity").alias("capacity"),
        *PROVENANCE,
    ).select(
        "bucket_name",
        F.coalesce(F.nullif("_display", F.lit("")), "bucket_name").alias("bucket_name_display"),
        "region", "status", "owner", "integrations", "network_config", "backup_recovery", "encryption", "versioning",
        "capacity",
        *PROVENANCE,
    )


S3 = ResourceSpec(
    table="s3",
    service="s3",
    service_type="S3",
    columns=(
        "bucket_name string, bucket_name_display string, region string, status string, owner string, "
        "integrations string, network_config string, backup_recovery string, encryption string, versioning string, "
        "capacity string, account_name string, account_id string"
    ),
    key=("bucket_name", "account_id"),
    resource_id="bucket_name",
    uncompared=("bucket_name_display", "region", "status", "account_name"),
    raw={
        "buckets": "Buckets array<struct<Name: string>>",
        "details": (
            f"Bucket string, TagSet {TAGS}, VersioningStatus string, LocationConstraint string, "
            "PublicAccessBlockConfiguration struct<BlockPublicAcls: boolean>, NotificationConfiguration struct<"
            "LambdaConfigurations: array<struct<Id: string>>, QueueConfigurations: array<struct<Id: string>>, "
            "TopicConfigurations: array<struct<Id: string>>>, ReplicationConfiguration struct<Role: string>, "
            "ServerSideEncryptionConfiguration struct<Rules: array<string>>"
        ),
        "metrics": (
            "Bucket string, StorageType string, Timestamp string, Maximum double, RunTime string"
        ),
    },
    optional_raw=("metrics",),
    flatten=flatten_s3,
    timed=True,
)

# Command name -> job type; anything else is ETL.
JOB_TYPES = {"glueetl": "ETL", "pythonshell": "Python Shell", "gluestreaming": "Streaming"}


def job_type(command: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in JOB_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, command), F.lit("ETL"))


def job_creator(nodes: Column, script: Column, catalog_flag: Column) -> Column:
    """Visual editor, notebook or script, by what the job definition holds."""
    has_script = F.coalesce(script, F.lit("")) != ""
    return (
        F.when(nodes.isNotNull(), F.lit("Visual"))
        .when(F.endswith(script, F.lit(".ipynb")), F.lit("Notebook"))
        .when(has_script, F.lit("Script"))
        .when(catalog_flag == "true", F.lit("Script"))
        .otherwise(F.lit("Visual"))
    )


def flatten_glue(raw: Raw) -> DataFrame:
    d = F.col("d")
    catalog = F.try_element_at(d["DefaultArguments"], F.lit("--enable-glue-datacatalog"))
    return items(raw["jobs"], "Jobs").select(
        d["Name"].alias("job_name"),
        job_type(d["Command"]["Name"]).alias("type"),
        or_default(utc_text(d["CreatedOn"])).alias("domain"),
        job_creator(d["CodeGenConfigurationNodes"], d["Command"]["ScriptLocation"], catalog).alias("created_by"),
        or_default(d["GlueVersion"]).alias("glue_version"),
        *_scope_columns(),
    )


GLUE = ResourceSpec(
    table="glue",
    service="glue",
    service_type="GLUE",
    columns=(
        "job_name string, type string, domain string, created_by string, glue_version string, region string, "
        "account_name string, account_id string"
    ),
    key=("job_name", "account_id"),
    resource_id="job_name",
    raw={
        "jobs": (
            "Jobs array<struct<Name: string, Command: struct<Name: string, ScriptLocation: string>, "
            "CodeGenConfigurationNodes: map<string,string>, DefaultArguments: map<string,string>, "
            "CreatedOn: string, GlueVersion: string>>"
        )
    },
    flatten=flatten_glue,
)

_EXECUTION = (
    "QueryExecutionId: string, Query: string, QueryExecutionContext: struct<Database: string>, "
    "Statistics: struct<TotalExecutionTimeInMillis: bigint>, "
    "Status: struct<State: string, SubmissionDateTime: string>, WorkGroup: string"
)


def _recent(df: DataFrame, when: Column, query_id: Column, newest_queries: int | None) -> DataFrame:
    """The newest queries of each account and region, all without a limit; equal times go by id."""
    if newest_queries is None:
        return df
    return newest(df, SCOPE, [utc_naive(when).desc_nulls_last(), query_id], newest_queries)


def _query_row(x: Column, query_id: Column, query: Column, database: Column, owner: Column) -> list[Column]:
    has_from = F.contains(F.upper(query), F.lit("FROM"))
    millis = F.coalesce(x["Statistics"]["TotalExecutionTimeInMillis"], F.lit(0))
    return [
        query_id.alias("query_id"),
        F.concat(F.lit("Query-"), clip(query_id, 8)).alias("query_name"),
        database.alias("domain"),
        or_default(F.nullif(query, F.lit(""))).alias("description"),
        database.alias("database_name"),
        F.when(has_from, first_table(query)).otherwise(F.lit(MISSING)).alias("tables_used"),
        (millis / F.lit(1000.0)).alias("execution_duration"),
        F.lit("On-demand").alias("execution_frequency"),
        owner.alias("owner"),
        *_scope_columns(),
    ]


def flatten_athena(raw: Raw, newest_queries: int | None = None) -> DataFrame:
    """Queries; ``newest_queries`` keeps so many of each account and region (earlier loaders kept 50)."""
    d = F.col("d")
    base = items(raw["executions"], "").select("account_id", "account_name", "region", d["QueryExecution"].alias("d"))
    kept = _recent(base, d["Status"]["SubmissionDateTime"], d["QueryExecutionId"], newest_queries)
    return kept.select(
        *_query_row(
            d,
            d["QueryExecutionId"],
            or_default(d["Query"], ""),
            or_default(d["QueryExecutionContext"]["Database"]),
            or_default(d["WorkGroup"], "primary"),
        )
    )


def flatten_tax(raw: Raw, newest_queries: int | None = None) -> DataFrame:
    """Listed query ids with their details; a listed id without details keeps defaults. ``newest_queries`` as for athena."""
    d, x = F.col("d"), F.col("x")
    listed = items(raw["listed"], "QueryExecutions").select(
        "account_id", "account_name", "region", d["QueryExecutionId"].alias("_id"), d["SubmissionDateTime"].alias("_at")
    )
    kept = _recent(listed, F.col("_at"), F.col("_id"), newest_queries)
    details = items(raw["executions"], "").select(
        *SCOPE, d["QueryExecution"]["QueryExecutionId"].alias("_id"), d["QueryExecution"].alias("x")
    )
    joined = kept.join(details, [*SCOPE, "_id"], "left")
    found = x.isNotNull()
    missing = F.lit(MISSING)
    # A found query without text keeps its empty text as the description.
    row = _query_row(
        x,
        F.col("_id"),
        F.when(found, or_default(x["Query"], "")).otherwise(missing),
        F.when(found, or_default(x["QueryExecutionContext"]["Database"])).otherwise(missing),
        F.when(found, or_default(x["WorkGroup"], "primary")).otherwise(missing),
    )
    description = F.when(found, or_default(x["Query"], "")).otherwise(missing).alias("description")
    return joined.select(*row[:3], description, *row[4:])


_QUERY_COLUMNS = (
    "query_id string, query_name string, domain string, description string, database_name string, "
    "tables_used string, execution_duration double, execution_frequency string, owner string, region string, "
    "account_name string, account_id string"
)

ATHENA = ResourceSpec(
    table="athena",
    service="athena",
    service_type="ATHENA",
    columns=_QUERY_COLUMNS,
    key=("query_id", "account_id"),
    resource_id="query_id",
    raw={"executions": f"QueryExecution struct<{_EXECUTION}>"},
    flatten=flatten_athena,
)

TAX = ResourceSpec(
    table="tax",
    service="tax",
    service_type="TAX",
    columns=_QUERY_COLUMNS,
    key=("query_id",),
    resource_id="query_id",
    raw={
        "listed": "QueryExecutions array<struct<QueryExecutionId: string, SubmissionDateTime: string>>",
        "executions": f"QueryExecution struct<{_EXECUTION}>",
    },
    flatten=flatten_tax,
)

SPECS = [RDS, REDSHIFT, S3, GLUE, ATHENA, TAX]
