"""Instances, functions, container clusters, image repositories, big-data clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.functions.text import (
    MISSING,
    count_of,
    first_items,
    first_segment,
    ids,
    join_or,
    label_when,
    last_segment,
    or_default,
    or_default_blank,
    tag_value,
)
from inventrace.operators.gather import lookup
from inventrace.sources.landed import by_key, items
from inventrace.specs.model import PROVENANCE, Raw, ResourceSpec

TAGS = "array<struct<Key: string, Value: string>>"
SCOPE = ["account_id", "region"]


def os_details(platform: Column, details: Column, image_description: Column) -> Column:
    """Windows details, else platform details, else the image description, else Linux/UNIX."""
    return (
        F.when(platform == "windows", or_default(details, "Windows"))
        .when(details.isNotNull(), details)
        .otherwise(or_default(image_description, "Linux/UNIX"))
    )


def vpc_label(vpc_id: Column, name: Column) -> Column:
    named = F.concat(vpc_id, F.lit(" ("), name, F.lit(")"))
    return F.when(F.coalesce(vpc_id, F.lit("")) == "", F.lit(MISSING)).otherwise(
        F.when(F.coalesce(name, F.lit("")) != "", named).otherwise(vpc_id)
    )


def flatten_ec2(raw: Raw) -> DataFrame:
    d = F.col("d")
    base = items(raw["instances"], "Reservations.Instances").withColumns(
        {"_vpc": d["VpcId"], "_image": d["ImageId"]}
    )
    if "vpcs" in raw:
        names = items(raw["vpcs"], "Vpcs").select(
            *SCOPE, d["VpcId"].alias("_vpc"), tag_value(d["Tags"], "Name", "").alias("_vpc_name")
        )
        base = lookup(base, names, [*SCOPE, "_vpc"], "_vpc_name", F.lit(""))
    else:
        base = base.withColumn("_vpc_name", F.lit(""))
    if "images" in raw:
        images = items(raw["images"], "Images").select(
            *SCOPE, d["ImageId"].alias("_image"), d["Description"].alias("_image_text")
        )
        base = lookup(base, images, [*SCOPE, "_image"], "_image_text", F.lit("Linux/UNIX"))
    else:
        base = base.withColumn("_image_text", F.lit("Linux/UNIX"))
    volumes = F.filter(d["BlockDeviceMappings"], lambda b: b["Ebs"].isNotNull())
    return base.select(
        d["InstanceId"].alias("instance_id"),
        tag_value(d["Tags"], "Name").alias("instance_name"),
        d["InstanceType"].alias("instance_type"),
        d["State"]["Name"].alias("state"),
        "region",
        d["Placement"]["AvailabilityZone"].alias("availability_zone"),
        vpc_label(F.col("_vpc"), F.col("_vpc_name")).alias("vpc"),
        or_default(d["SubnetId"]).alias("subnet"),
        or_default(d["ImageId"]).alias("os_image_id"),
        os_details(d["Platform"], d["PlatformDetails"], F.col("_image_text")).alias("os_details"),
        # The segment is taken after the default is filled in: an instance without profile shows "A".
        last_segment(or_default(d["IamInstanceProfile"]["Arn"]), "/").alias("iam_role"),
        ids(d["SecurityGroups"], "GroupName").alias("security_groups"),
        or_default(d["KeyName"]).alias("key_name"),
        or_default(d["PublicIpAddress"]).alias("public_ip"),
        or_default(d["PrivateIpAddress"]).alias("private_ip"),
        F.coalesce(
            F.transform(volumes, lambda b: b["Ebs"]["VolumeId"]), F.expr("cast(array() as array<string>)")
        ).alias("storage_volumes"),
        *PROVENANCE,
    )


EC2 = ResourceSpec(
    table="ec2",
    service="ec2",
    service_type="EC2",
    columns=(
        "instance_id string, instance_name string, instance_type string, state string, region string, "
        "availability_zone string, vpc string, subnet string, os_image_id string, os_details string, "
        "iam_role string, security_groups array<string>, key_name string, public_ip string, private_ip string, "
        "storage_volumes array<string>, account_name string, account_id string"
    ),
    key=("instance_id", "account_id", "account_name"),
    resource_id="instance_id",
    comparators={"security_groups": "list", "storage_volumes": "list"},
    compact_names=True,
    raw={
        "instances": (
            "Reservations array<struct<Instances: array<struct<InstanceId: string, InstanceType: string, "
            "State: struct<Name: string>, Placement: struct<AvailabilityZone: string>, VpcId: string, "
            "SubnetId: string, ImageId: string, IamInstanceProfile: struct<Arn: string>, "
            "SecurityGroups: array<struct<GroupName: string>>, KeyName: string, PublicIpAddress: string, "
            "PrivateIpAddress: string, BlockDeviceMappings: array<struct<Ebs: struct<VolumeId: string>>>, "
            f"Tags: {TAGS}, Platform: string, PlatformDetails: string>>>>"
        ),
        "vpcs": f"Vpcs array<struct<VpcId: string, Tags: {TAGS}>>",
        "images": "Images array<struct<ImageId: string, Description: string>>",
    },
    optional_raw=("vpcs", "images"),
    flatten=flatten_ec2,
)


NO_TRIGGERS = "Sin triggers"


def policy_triggers(policy: Column) -> Column:
    """Policy JSON -> JSON list of "service → source arn" (or the service alone)."""
    statements = F.from_json(
        F.get_json_object(policy, "$.Statement"), "array<struct<Principal: string, Condition: string>>"
    )

    def trigger(s: Column) -> Column:
        service = first_segment(F.get_json_object(s["Principal"], "$.Service"), ".")
        arn = F.get_json_object(s["Condition"], "$.ArnLike['AWS:SourceArn']")
        shown = F.when(arn.isNull() | (arn == MISSING), service).otherwise(F.concat(service, F.lit(" → "), arn))
        return F.when(service != MISSING, shown)

    found = F.array_compact(F.transform(statements, trigger))
    return F.to_json(F.when(count_of(found) > 0, found).otherwise(F.array(F.lit(NO_TRIGGERS))))


def flatten_lambda(raw: Raw) -> DataFrame:
    d, c = F.col("d"), F.col("c")
    base = items(raw["functions"], "Functions").withColumn("_fn", d["FunctionName"])

    def detail(name: str, *cols: Column) -> DataFrame:
        return items(raw[name], "").select(*SCOPE, d["FunctionName"].alias("_fn"), *cols)

    config = detail("configurations", d.alias("_config"))
    policy = detail("policies", d["Policy"].alias("_policy"))
    tags = detail("tags", d["Tags"].alias("_tags"))
    key = [*SCOPE, "_fn"]
    joined = base.join(config, key, "left").join(policy, key, "left").join(tags, key, "left")
    joined = joined.withColumn("c", F.coalesce(F.col("_config"), d))
    role = c["Role"]
    vpc_id = F.nullif(c["VpcConfig"]["VpcId"], F.lit(""))
    subnets = count_of(c["VpcConfig"]["SubnetIds"]).cast("string")
    return joined.select(
        F.col("_fn").alias("function_name"),
        or_default(c["Description"]).alias("description"),
        or_default(c["Handler"]).alias("handler"),
        or_default(c["Runtime"]).alias("runtime"),
        or_default(c["MemorySize"], 0).alias("memory_size"),
        or_default(c["Timeout"], 0).alias("timeout"),
        or_default(last_segment(F.nullif(role, F.lit("")), "/")).alias("role"),
        count_of(c["Environment"]["Variables"]).alias("environment"),
        policy_triggers(F.col("_policy")).alias("triggers"),
        or_default(label_when(vpc_id.isNotNull(), "VPC:", vpc_id, ",Subnets:", subnets)).alias("vpc_config"),
        "region",
        F.coalesce(F.to_json("_tags"), F.lit("{}")).alias("tags"),
        *PROVENANCE,
    )


_FUNCTION = (
    "FunctionName: string, FunctionArn: string, Description: string, Handler: string, Runtime: string, "
    "MemorySize: bigint, Timeout: bigint, Role: string, Environment: struct<Variables: map<string,string>>, "
    "VpcConfig: struct<VpcId: string, SubnetIds: array<string>>"
)

LAMBDA = ResourceSpec(
    table="lambda_functions",
    service="lambda",
    service_type="LAMBDA",
    columns=(
        "function_name string, description string, handler string, runtime string, memory_size bigint, "
        "timeout bigint, role string, environment bigint, triggers string, vpc_config string, region string, "
        "tags string, account_name string, account_id string"
    ),
    key=("function_name", "account_id", "region"),
    resource_id="function_name",
    compact_names=True,
    raw={
        "functions": f"Functions array<struct<{_FUNCTION}>>",
        "configurations": _FUNCTION,
        "policies": "FunctionName string, Policy string",
        "tags": "FunctionName string, Tags map<string,string>",
    },
    flatten=flatten_lambda,
)

# End of standard support by cluster version.
SUPPORT_ENDS = {"1.32": "Feb 25, 2026", "1.31": "Nov 25, 2025", "1.30": "Jul 25, 2025", "1.29": "Mar 25, 2025"}


def support_text(version: Column, support_type: Column) -> Column:
    ends = F.create_map(*[F.lit(x) for pair in SUPPORT_ENDS.items() for x in pair])
    until = or_default(F.try_element_at(ends, version))
    text = F.concat(F.initcap(F.coalesce(support_type, F.lit("STANDARD"))), F.lit(" - Ends "), until)
    return F.when(F.coalesce(version, F.lit("")) != "", text).otherwise(F.lit("Standard"))


def flatten_eks(raw: Raw) -> DataFrame:
    d = F.col("d")
    base = items(raw["clusters"], "").select(
        "account_id", "account_name", "region", d["cluster"].alias("d"), d["cluster"]["name"].alias("_name")
    )
    addons = by_key(raw["addons"], F.col("doc.clusterName"), "_name", lists={"_addons": F.col("doc.addons")})
    joined = base.join(addons, [*SCOPE, "_name"], "left")
    return joined.select(
        F.col("_name").alias("cluster_name"),
        last_segment(F.coalesce(d["arn"], d["name"]), "/").alias("cluster_id"),
        or_default(d["status"]).alias("status"),
        or_default_blank(d["version"]).alias("kubernetes_version"),
        F.lit("AWS").alias("provider"),
        or_default(d["resourcesVpcConfig"]["clusterSecurityGroupId"]).alias("cluster_security_group"),
        support_text(d["version"], d["supportType"]).alias("support_period"),
        F.coalesce("_addons", F.expr("cast(array() as array<string>)")).alias("addons"),
        F.coalesce(d["tags"], F.expr("cast(map() as map<string,string>)")).alias("tags"),
        *PROVENANCE,
    )


EKS = ResourceSpec(
    table="eks",
    service="eks",
    service_type="EKS",
    columns=(
        "cluster_name string, cluster_id string, status string, kubernetes_version string, provider string, "
        "cluster_security_group string, support_period string, addons array<string>, tags map<string,string>, "
        "account_name string, account_id string"
    ),
    key=("cluster_name", "account_id"),
    resource_id="cluster_name",
    comparators={
        c: "any_list"
        for c in (
            "cluster_id", "status", "kubernetes_version", "provider", "cluster_security_group", "support_period",
            "addons", "tags", "account_name",
        )
    },
    compact_names=True,
    fixed_region="us-east-1",
    raw={
        "clusters": (
            "cluster struct<name: string, arn: string, version: string, supportType: string, status: string, "
            "resourcesVpcConfig: struct<clusterSecurityGroupId: string>, tags: map<string,string>>"
        ),
        "addons": "clusterName string, addons array<string>",
    },
    flatten=flatten_eks,
)


def flatten_ecr(raw: Raw, shown_images: int | None = None) -> DataFrame:
    """Repositories with the tags of their landed images, or of the first ``shown_images``."""
    d = F.col("d")
    base = items(raw["repositories"], "repositories").withColumn("_name", d["repositoryName"])
    key = [*SCOPE, "_name"]

    name = F.col("doc.repositoryName")
    size = F.get("doc.repositoryStatistics", F.lit(0))["repositorySizeInBytes"]
    sizes = by_key(raw["statistics"], name, "_name", first={"_size": size})
    images = by_key(raw["images"], name, "_name", lists={"_all": F.col("doc.imageIds")})
    images = images.select(*key, first_items(F.col("_all"), shown_images).alias("_images"))
    tags = by_key(raw["tags"], name, "_name", lists={"_tags": F.col("doc.tags")})
    tags = tags.select(*key, tag_value(F.col("_tags"), "BusinessAppID", names=("key", "value")).alias("_app"))
    joined = base.join(sizes, key, "left").join(images, key, "left").join(tags, key, "left")
    tagged = F.filter(F.transform("_images", lambda i: i["imageTag"]), lambda t: t.isNotNull())
    return joined.select(
        F.col("_name").alias("repository_name"),
        F.coalesce(
            F.nullif(first_segment(d["repositoryUri"], "."), F.lit("")), F.col("account_id")
        ).alias("domain"),
        or_default(F.col("_app")).alias("business_app_id"),
        or_default(F.col("_size"), 0).alias("repository_size"),
        F.lit("container").alias("artifact_type"),
        F.coalesce(tagged, F.expr("cast(array() as array<string>)")).alias("image_tags"),
        *PROVENANCE,
    )


ECR = ResourceSpec(
    table="ecr",
    service="ecr",
    service_type="ECR",
    columns=(
        "repository_name string, domain string, business_app_id string, repository_size bigint, "
        "artifact_type string, image_tags array<string>, account_name string, account_id string"
    ),
    key=("repository_name", "account_id"),
    resource_id="repository_name",
    comparators={
        c: "list"
        for c in ("domain", "business_app_id", "repository_size", "artifact_type", "image_tags", "account_name")
    },
    compact_names=True,
    fixed_region="us-east-1",
    raw={
        "repositories": (
            "repositories array<struct<repositoryName: string, repositoryArn: string, repositoryUri: string>>"
        ),
        "statistics": "repositoryName string, repositoryStatistics array<struct<repositorySizeInBytes: bigint>>",
        "images": "repositoryName string, imageIds array<struct<imageTag: string>>",
        "tags": "repositoryName string, tags array<struct<key: string, value: string>>",
    },
    flatten=flatten_ecr,
)


def security_summary(config: Column, profile: Column, managed_group: Column) -> Column:
    """Configured security parts joined, "Default" when there are none."""
    has_config = F.coalesce(config, F.lit(MISSING)) != MISSING
    has_profile = F.coalesce(profile, F.lit("")) != ""
    has_group = F.coalesce(managed_group, F.lit("")) != ""
    parts = F.array_compact(
        F.array(
            label_when(has_config, "Config: ", config),
            label_when(has_profile, "IAM: ", last_segment(profile, "/")),
            label_when(has_group, "Security Groups: Configured"),
        )
    )
    return join_or(parts, "Default")


def flatten_emr(raw: Raw, shown_applications: int | None = None) -> DataFrame:
    """Clusters with the names of their applications, or of the first ``shown_applications``."""
    d, k = F.col("d"), F.col("k")
    base = items(raw["clusters"], "Clusters").withColumn("_id", d["Id"])
    details = items(raw["details"], "").select(*SCOPE, d["Cluster"]["Id"].alias("_id"), d["Cluster"].alias("k"))
    joined = base.join(details, [*SCOPE, "_id"], "left")
    found = k.isNotNull()
    apps = F.array_sort(F.array_distinct(F.transform(k["Applications"], lambda a: or_default(a["Name"], "Unknown"))))
    attrs = k["Ec2InstanceAttributes"]
    security = security_summary(
        k["SecurityConfiguration"], attrs["IamInstanceProfile"], attrs["EmrManagedMasterSecurityGroup"]
    )
    return joined.select(
        F.col("_id").alias("cluster_id"),
        or_default(d["Name"]).alias("cluster_name"),
        join_or(apps, first=shown_applications).alias("application_types"),
        or_default(k["ReleaseLabel"]).alias("version"),
        or_default(k["Status"]["State"], "UNKNOWN").alias("state"),
        "region",
        F.when(found, security).otherwise(F.lit(MISSING)).alias("security_configuration"),
        *PROVENANCE,
    )


EMR = ResourceSpec(
    table="emr",
    service="emr",
    service_type="EMR",
    columns=(
        "cluster_id string, cluster_name string, application_types string, version string, state string, "
        "region string, security_configuration string, account_name string, account_id string"
    ),
    key=("cluster_id", "account_id"),
    resource_id="cluster_id",
    raw={
        "clusters": "Clusters array<struct<Id: string, Name: string>>",
        "details": (
            "Cluster struct<Id: string, Applications: array<struct<Name: string>>, ReleaseLabel: string, "
            "Status: struct<State: string>, SecurityConfiguration: string, Ec2InstanceAttributes: "
            "struct<IamInstanceProfile: string, EmrManagedMasterSecurityGroup: string>>"
        ),
    },
    flatten=flatten_emr,
)

SPECS = [EC2, LAMBDA, EKS, ECR, EMR]
