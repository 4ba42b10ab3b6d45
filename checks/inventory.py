"""One query per resource: landed documents built from the given tables, flattened by the spec.

The documents go through JSON text and the dataset's read schema, as landed pages do. The SQL computes
the expected columns straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import check, run_ts, table, text
from inventrace.plans.sync import flatten
from inventrace.sources.landed import parse_pages
from inventrace.specs.limits import limited
from inventrace.specs.model import ResourceSpec
from inventrace.specs.registry import SPECS

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def lit(v: str) -> Column:
    return F.lit(v)


def cat(*parts: Column | str) -> Column:
    return F.concat(*[lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def obj(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def tag(key: str, value: Column) -> Column:
    return obj(Key=lit(key), Value=value)


def mixed_zones(ts: Column, key: Column) -> Column:
    """The same moment without a zone, in UTC, and two hours east."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    plain, east = F.date_format(ts, iso), F.date_format(ts + F.expr("INTERVAL 2 HOURS"), iso)
    return (
        F.when(key % 4 == 0, plain)
        .when(key % 4 == 1, F.concat(plain, F.lit("Z")))
        .when(key % 4 == 2, F.concat(east, F.lit("+02:00")))
        .otherwise(F.concat(east, F.lit("+0200")))
    )


class Landing:
    """Landed pages of one resource, built row by row from a table with a numeric key."""

    def __init__(self, service: str, base: DataFrame, key: str, **options: int):
        """With the limits of earlier loaders; ``options`` are further ones, for the resource's flatten function."""
        self.spec: ResourceSpec = limited(SPECS[service], **options)
        self.base = base
        self.key = key
        self.raw: dict[str, DataFrame] = {}

    def page(self, name: str, doc: Column, base: DataFrame | None = None, key: str | None = None) -> Landing:
        k = F.col(key or self.key)
        region = F.when(k % 3 == 0, lit("us-east-1")).when(k % 3 == 1, lit("eu-west-1")).otherwise(lit("sa-east-1"))
        rows = (base if base is not None else self.base).select(
            cat("a", k % 25).alias("account_id"), cat("acct ", k % 25).alias("account_name"), region.alias("region"),
            F.to_json(doc).alias("doc"),
        )
        self.raw[name] = parse_pages(rows, self.spec.raw[name])
        return self

    def flat(self) -> DataFrame:
        """The flat rows with nested columns and times as text."""
        flat = flatten(self.spec, self.raw, run_ts())
        out = []
        for f in flat.schema.fields:
            c = F.col(f.name)
            if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
                c = F.array_join(c, ",")
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                c = F.to_json(c)
            elif isinstance(f.dataType, T.TimestampNTZType):
                c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
            out.append(c.alias(f.name))
        return flat.select(*out)


def env(key: str) -> str:
    return (
        f"'a' || ({key} % 25) AS account_id, 'acct ' || ({key} % 25) AS account_name, "
        f"CASE {key} % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'eu-west-1' ELSE 'sa-east-1' END AS region"
    )


def env_no_region(key: str) -> str:
    return f"'a' || ({key} % 25) AS account_id, 'acct ' || ({key} % 25) AS account_name"


# ---------------------------------------------------------------- compute


@check(
    "res_ec2",
    f"""SELECT 'i-' || o_orderkey AS instance_id, CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE o_orderpriority END AS instance_name,
      't3.' || o_orderstatus AS instance_type, CASE o_orderstatus WHEN 'O' THEN 'running' ELSE 'stopped' END AS state,
      'az' || (o_custkey % 4) AS availability_zone,
      CASE o_orderstatus WHEN 'P' THEN 'N/A' WHEN 'O' THEN 'vpc-' || o_orderkey || ' (net ' || o_custkey || ')' ELSE 'vpc-' || o_orderkey END AS vpc,
      CASE o_orderstatus WHEN 'P' THEN 'N/A' ELSE 'sn-' || o_custkey END AS subnet,
      CASE WHEN o_orderpriority = '5-LOW' THEN 'N/A' ELSE 'ami-' || o_orderkey END AS os_image_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Windows' WHEN '2-HIGH' THEN 'Windows BYOL' WHEN '3-MEDIUM' THEN 'Red Hat'
        WHEN '4-NOT SPECIFIED' THEN 'image of ' || o_custkey ELSE 'Linux/UNIX' END AS os_details,
      CASE o_orderstatus WHEN 'F' THEN 'A' ELSE 'role-' || o_custkey END AS iam_role,
      CASE o_orderstatus WHEN 'F' THEN '' ELSE 'sg-b,sg-a' END AS security_groups, 'N/A' AS key_name,
      '10.0.0.' || (o_custkey % 256) AS public_ip, 'N/A' AS private_ip, 'vol-' || o_orderkey AS storage_volumes, {env('o_orderkey')}
    FROM orders""",
)
def res_ec2(spark: SparkSession, sf: str) -> DataFrame:
    st, pr, k, cust = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey"), F.col("o_custkey")
    vpc = F.when(st != "P", cat("vpc-", k))
    image = F.when(pr != "5-LOW", cat("ami-", k))
    instance = obj(
        InstanceId=cat("i-", k),
        InstanceType=cat("t3.", st),
        State=obj(Name=F.when(st == "O", lit("running")).otherwise(lit("stopped"))),
        Placement=obj(AvailabilityZone=cat("az", cust % 4)),
        VpcId=vpc,
        SubnetId=F.when(st != "P", cat("sn-", cust)),
        ImageId=image,
        IamInstanceProfile=F.when(st != "F", obj(Arn=cat("arn:aws:iam::1:instance-profile/role-", cust))),
        SecurityGroups=F.when(st != "F", F.array(obj(GroupName=lit("sg-b")), obj(GroupName=lit("sg-a")))),
        PublicIpAddress=cat("10.0.0.", cust % 256),
        BlockDeviceMappings=F.array(
            obj(Ebs=F.when(k >= 0, obj(VolumeId=cat("vol-", k)))), obj(Ebs=F.when(k < 0, obj(VolumeId=lit("x"))))
        ),
        Tags=F.when(st != "P", F.array(tag("Env", lit("e")), tag("Name", pr), tag("Name", lit("second")))),
        Platform=F.when(pr.isin("1-URGENT", "2-HIGH"), lit("windows")),
        PlatformDetails=F.when(pr == "2-HIGH", lit("Windows BYOL")).when(pr == "3-MEDIUM", lit("Red Hat")),
    )
    vpc_doc = obj(
        Vpcs=F.array(obj(VpcId=vpc, Tags=F.when(st == "O", F.array(tag("Name", cat("net ", cust))))))
    )
    image_doc = obj(
        Images=F.array(obj(ImageId=image, Description=F.when(pr == "4-NOT SPECIFIED", cat("image of ", cust))))
    )
    land = Landing("ec2", table(spark, sf, "orders", spread=True), "o_orderkey")
    land.page("instances", obj(Reservations=F.array(obj(Instances=F.array(instance)))))
    return land.page("vpcs", vpc_doc).page("images", image_doc).flat()


@check(
    "res_lambda_functions",
    f"""SELECT 'fn-' || p_partkey AS function_name, CASE WHEN p_size > 40 THEN p_name || ' v2' ELSE 'N/A' END AS description,
      'N/A' AS handler, CASE WHEN p_size > 40 THEN 'python3.13' ELSE 'python3.12' END AS runtime, CAST(p_size * 64 AS BIGINT) AS memory_size,
      CAST(0 AS BIGINT) AS timeout, CASE WHEN p_size > 40 THEN 'N/A' ELSE 'r-' || p_brand END AS role,
      CAST(CASE WHEN p_size > 40 THEN 0 ELSE 2 END AS BIGINT) AS environment,
      CASE WHEN p_size > 25 THEN '["Sin triggers"]' ELSE '["s3 → arn:aws:s3:::' || p_partkey || '"]' END AS triggers,
      CASE WHEN p_size > 40 THEN 'N/A' ELSE 'VPC:vpc-1,Subnets:2' END AS vpc_config,
      CASE WHEN p_size > 10 THEN '{{"team":"' || p_type || '"}}' ELSE '{{}}' END AS tags, {env('p_partkey')} FROM part""",
)
def res_lambda_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Large parts have an own configuration; the others fall back to the listed document."""
    k, size = F.col("p_partkey"), F.col("p_size")
    name, arn = cat("fn-", k), cat("arn:aws:lambda:eu:1:function:fn-", k)
    listed = obj(
        FunctionName=name, FunctionArn=arn, Runtime=lit("python3.12"), MemorySize=size * 64,
        Role=cat("arn:aws:iam::1:role/r-", F.col("p_brand")),
        Environment=obj(Variables=F.create_map(lit("A"), lit("1"), lit("B"), lit("2"))),
        VpcConfig=obj(VpcId=lit("vpc-1"), SubnetIds=F.array(lit("s1"), lit("s2"))),
    )
    config = obj(
        FunctionName=name, Description=cat(F.col("p_name"), " v2"), Runtime=lit("python3.13"), MemorySize=size * 64,
        Role=lit(""), VpcConfig=obj(VpcId=lit("")),
    )
    policy = cat(
        '{"Statement": [{"Principal": {"Service": "s3.amazonaws.com"}, "Condition": {"ArnLike": {"AWS:SourceArn": "arn:aws:s3:::',
        k, '"}}}]}',
    )
    land = Landing("lambda", table(spark, sf, "part", spread=True), "p_partkey")
    land.page("functions", obj(Functions=F.array(listed)))
    land.page("configurations", config, land.base.where(size > 40))
    land.page("policies", obj(FunctionName=name, Policy=policy), land.base.where(size <= 25))
    land.page("tags", obj(FunctionName=name, Tags=F.create_map(lit("team"), F.col("p_type"))), land.base.where(size > 10))
    return land.flat()


@check(
    "res_eks",
    f"""SELECT s_name AS cluster_name, CASE WHEN s_acctbal > 0 THEN 'k' || s_suppkey ELSE s_name END AS cluster_id,
      CASE WHEN s_acctbal > 5000 THEN 'ACTIVE' ELSE 'N/A' END AS status,
      CASE s_suppkey % 3 WHEN 0 THEN '1.31' WHEN 1 THEN '1.20' ELSE 'N/A' END AS kubernetes_version, 'AWS' AS provider,
      CASE WHEN s_acctbal > 5000 THEN 'sg-' || s_nationkey ELSE 'N/A' END AS cluster_security_group,
      CASE s_suppkey % 3 WHEN 0 THEN 'Extended - Ends Nov 25, 2025' WHEN 1 THEN 'Standard - Ends N/A' ELSE 'Standard' END AS support_period,
      CASE WHEN s_acctbal > 5000 THEN 'vpc-cni,coredns' ELSE '' END AS addons,
      CASE WHEN s_acctbal > 5000 THEN '{{"nation":"' || s_nationkey || '"}}' ELSE '{{}}' END AS tags, {env_no_region('s_suppkey')} FROM supplier""",
)
def res_eks(spark: SparkSession, sf: str) -> DataFrame:
    k, rich = F.col("s_suppkey"), F.col("s_acctbal") > 5000
    cluster = obj(
        name=F.col("s_name"),
        arn=F.when(F.col("s_acctbal") > 0, cat("arn:aws:eks:r:1:cluster/k", k)),
        version=F.when(k % 3 == 0, lit("1.31")).when(k % 3 == 1, lit("1.20")),
        supportType=F.when(k % 3 == 0, lit("EXTENDED")),
        status=F.when(rich, lit("ACTIVE")),
        resourcesVpcConfig=F.when(rich, obj(clusterSecurityGroupId=cat("sg-", F.col("s_nationkey")))),
        tags=F.when(rich, F.create_map(lit("nation"), text("s_nationkey"))),
    )
    land = Landing("eks", table(spark, sf, "supplier"), "s_suppkey").page("clusters", obj(cluster=cluster))
    addons = obj(clusterName=F.col("s_name"), addons=F.array(lit("vpc-cni"), lit("coredns")))
    return land.page("addons", addons, land.base.where(rich)).flat()


@check(
    "res_ecr",
    f"""SELECT 'repo-' || p_partkey AS repository_name, CASE WHEN p_size > 25 THEN 'a' || (p_partkey % 25) ELSE 'dkr' || p_size END AS domain,
      CASE WHEN p_size > 25 THEN 'N/A' ELSE p_brand END AS business_app_id,
      CAST(CASE WHEN p_size > 40 THEN 0 ELSE p_size * 1000 END AS BIGINT) AS repository_size, 'container' AS artifact_type,
      CASE WHEN p_size > 25 THEN '' ELSE 'v1,v3,v4,v5' END AS image_tags, {env_no_region('p_partkey')} FROM part""",
)
def res_ecr(spark: SparkSession, sf: str) -> DataFrame:
    """Tags of the first five images (one of them untagged); larger parts have no images or tags."""
    k, size = F.col("p_partkey"), F.col("p_size")
    name = cat("repo-", k)
    repo = obj(
        repositoryName=name, repositoryArn=cat("arn:", name),
        repositoryUri=F.when(size <= 25, cat("dkr", size, ".ecr.amazonaws.com/x")),
    )
    none = F.when(size < 0, lit(""))
    images = F.array(*[obj(imageTag=none if i == 1 else lit(f"v{i + 1}")) for i in range(7)])
    tags = F.array(obj(key=lit("x"), value=lit("y")), obj(key=lit("BusinessAppID"), value=F.col("p_brand")))
    land = Landing("ecr", table(spark, sf, "part", spread=True), "p_partkey").page("repositories", obj(repositories=F.array(repo)))
    stats = obj(repositoryName=name, repositoryStatistics=F.array(obj(repositorySizeInBytes=size * 1000)))
    small = land.base.where(size <= 25)
    land.page("statistics", stats, land.base.where(size <= 40))
    land.page("images", obj(repositoryName=name, imageIds=images), small)
    return land.page("tags", obj(repositoryName=name, tags=tags), small).flat()


@check(
    "res_emr",
    f"""SELECT 'j-' || c_custkey AS cluster_id, CASE WHEN c_nationkey < 20 THEN c_name ELSE 'N/A' END AS cluster_name,
      CASE WHEN c_nationkey < 5 THEN 'A, B, C, D, E' WHEN c_nationkey < 15 THEN 'Spark, Unknown' ELSE 'N/A' END AS application_types,
      CASE WHEN c_nationkey < 15 THEN 'emr-7' ELSE 'N/A' END AS version,
      CASE WHEN c_nationkey < 15 THEN 'RUNNING' ELSE 'UNKNOWN' END AS state,
      CASE WHEN c_nationkey < 5 THEN 'Config: ' || c_mktsegment || ', IAM: p-' || c_custkey || ', Security Groups: Configured'
        WHEN c_nationkey < 15 THEN 'Default' ELSE 'N/A' END AS security_configuration, {env('c_custkey')} FROM customer""",
)
def res_emr(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    cid = cat("j-", k)
    many = F.array(*[obj(Name=lit(x)) for x in ("F", "E", "D", "C", "B", "A", "A")])
    few = F.array(obj(Name=lit("Spark")), obj(Name=F.when(k < 0, lit("x"))), obj(Name=lit("Spark")))
    detail = obj(
        Id=cid, Applications=F.when(n < 5, many).otherwise(few), ReleaseLabel=lit("emr-7"), Status=obj(State=lit("RUNNING")),
        SecurityConfiguration=F.when(n < 5, F.col("c_mktsegment")),
        Ec2InstanceAttributes=F.when(
            n < 5, obj(IamInstanceProfile=cat("arn:x/p-", k), EmrManagedMasterSecurityGroup=lit("sg-1"))
        ),
    )
    land = Landing("emr", table(spark, sf, "customer", spread=True), "c_custkey")
    land.page("clusters", obj(Clusters=F.array(obj(Id=cid, Name=F.when(n < 20, F.col("c_name"))))))
    return land.page("details", obj(Cluster=detail), land.base.where(n < 15)).flat()


# ---------------------------------------------------------------- networks


def network(service: str, spark: SparkSession, sf: str) -> Landing:
    """Each customer is a network with two subnets, a peering to the next account's network and its parts."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    vpc = cat("vpc-", k)

    def sub(i: int) -> Column:
        return cat("sn-", k, f"-{i}")

    land = Landing(service, table(spark, sf, "customer", spread=True), "c_custkey")

    def page(name: str, doc: Column) -> None:
        if name in land.spec.raw:
            land.page(name, doc)

    def listed(name: str, *items: Column) -> Column:
        return obj(**{name: F.array(*items)})

    named = F.when(n < 20, F.array(tag("Name", F.col("c_name"))))
    page("vpcs", listed("Vpcs", obj(VpcId=vpc, CidrBlock=cat("10.", n, ".0.0/16"), State=lit("available"), Tags=named)))
    page(
        "subnets",
        listed(
            "Subnets",
            *[
                obj(
                    SubnetId=sub(i), VpcId=vpc, CidrBlock=cat(f"10.{i}.", n, ".0/24"), AvailabilityZone=cat("az", n % 2 * i),
                    State=lit("available"), Tags=F.when(n < 10, F.array(tag("Name", cat("s", k)))),
                )
                for i in (2, 1)
            ],
        ),
    )
    page("security_groups", listed("SecurityGroups", obj(GroupId=lit("sg-b"), VpcId=vpc), obj(GroupId=lit("sg-a"), VpcId=vpc)))
    acls = [
        obj(NetworkAclId=cat(f"acl-{x}-", k), VpcId=vpc, Associations=F.array(obj(SubnetId=sub(1)), obj(SubnetId=F.when(k < 0, sub(1)))))
        for x in ("a", "b")
    ]
    page("network_acls", listed("NetworkAcls", *acls))
    page(
        "internet_gateways",
        listed("InternetGateways", obj(InternetGatewayId=cat("igw-", k), Attachments=F.when(n < 15, F.array(obj(VpcId=vpc))))),
    )
    page("vpn_connections", listed("VpnConnections", obj(VpnConnectionId=cat("vpn-", k), VpcId=F.when(n < 5, vpc))))
    page(
        "vpc_endpoints",
        listed(
            "VpcEndpoints",
            obj(VpcEndpointId=cat("ep-2-", k), VpcId=vpc, SubnetIds=F.array(sub(1), sub(2))),
            obj(VpcEndpointId=cat("ep-1-", k), VpcId=vpc, SubnetIds=F.array(sub(1))),
        ),
    )
    # Accounts and regions repeat every 75 keys, so a network and the one 75 keys on can peer.
    page(
        "vpc_peerings",
        listed(
            "VpcPeeringConnections",
            obj(
                VpcPeeringConnectionId=cat("pcx-", k), RequesterVpcInfo=obj(VpcId=vpc),
                AccepterVpcInfo=obj(VpcId=cat("vpc-", k + 75)),
            ),
        ),
    )
    page(
        "route_tables",
        listed("RouteTables", obj(RouteTableId=cat("rt-", k), VpcId=vpc, Associations=F.array(obj(SubnetId=sub(2))))),
    )
    page(
        "network_interfaces",
        listed(
            "NetworkInterfaces",
            obj(NetworkInterfaceId=lit("eni-1"), SubnetId=sub(1), Groups=F.array(obj(GroupId=lit("sg-b")), obj(GroupId=lit("sg-a")))),
            obj(NetworkInterfaceId=lit("eni-2"), SubnetId=sub(1), Groups=F.array(obj(GroupId=lit("sg-b")))),
        ),
    )
    return land


@check(
    "res_vpcs",
    f"""SELECT 'vpc-' || c_custkey AS vpc_id, CASE WHEN c_nationkey < 20 THEN c_name ELSE 'N/A' END AS vpc_name,
      '10.' || c_nationkey || '.0.0/16' AS cidr_block, 'available' AS state,
      'sn-' || c_custkey || '-1,sn-' || c_custkey || '-2' AS subnets, 'sg-a,sg-b' AS security_groups,
      'acl-a-' || c_custkey || ',acl-b-' || c_custkey AS network_acls,
      CASE WHEN c_nationkey < 15 THEN 'igw-' || c_custkey ELSE '' END AS internet_gateways,
      CASE WHEN c_nationkey < 5 THEN 'vpn-' || c_custkey ELSE '' END AS vpn_connections,
      'ep-1-' || c_custkey || ',ep-2-' || c_custkey AS vpc_endpoints, 'pcx-' || c_custkey AS vpc_peerings,
      CASE WHEN c_nationkey < 20 THEN '[{{"Key":"Name","Value":"' || c_name || '"}}]' ELSE '[]' END AS tags,
      CASE WHEN c_nationkey % 2 = 0 THEN 'az0' ELSE 'az1,az2' END AS availability_zones, 'rt-' || c_custkey AS route_rules, {env('c_custkey')}
    FROM customer""",
)
def res_vpcs(spark: SparkSession, sf: str) -> DataFrame:
    return network("vpc", spark, sf).flat()


@check(
    "res_subnets",
    f"""SELECT 'sn-' || c_custkey || '-' || i AS subnet_id, 'vpc-' || c_custkey AS vpc_id,
      CASE WHEN c_nationkey < 20 THEN c_name ELSE 'N/A' END AS vpc_name, '10.' || i || '.' || c_nationkey || '.0/24' AS cidr_block,
      'az' || (c_nationkey % 2 * i) AS availability_zone, 'available' AS state,
      CASE i WHEN 1 THEN 'sg-a,sg-b' ELSE '' END AS security_groups, CASE i WHEN 1 THEN 'acl-b-' || c_custkey ELSE '' END AS acls,
      CASE WHEN c_nationkey < 15 THEN 'igw-' || c_custkey ELSE '' END AS internet_gateways,
      CASE WHEN c_nationkey < 5 THEN 'vpn-' || c_custkey ELSE '' END AS vpn_connections,
      CASE i WHEN 1 THEN 'ep-1-' || c_custkey || ',' ELSE '' END || 'ep-2-' || c_custkey AS vpc_endpoints,
      CASE WHEN c_custkey < 75 THEN 'pcx-' || c_custkey ELSE
        least('pcx-' || c_custkey, 'pcx-' || (c_custkey - 75)) || ',' || greatest('pcx-' || c_custkey, 'pcx-' || (c_custkey - 75)) END AS vpc_peerings,
      CASE i WHEN 2 THEN 'rt-' || c_custkey ELSE '' END AS route_tables,
      CASE WHEN c_nationkey < 10 THEN 's' || c_custkey ELSE 'N/A' END AS subnet_name, {env('c_custkey')}
    FROM customer, (VALUES (1), (2)) v(i)""",
)
def res_subnets(spark: SparkSession, sf: str) -> DataFrame:
    return network("subnets", spark, sf).flat()


@check(
    "res_route53",
    f"""SELECT 'Z' || c_custkey || '_' || name || '_' || type AS record_id, name AS domain_name, type AS record_type, v AS record_value,
      ttl, 'zone' || c_custkey || '.' AS hosted_zone, {env_no_region('c_custkey')}
    FROM customer, LATERAL (VALUES ('w.' || c_mktsegment, 'A', '1.1.1.1, 2.2.2.' || c_nationkey, '300'),
      ('alias', 'CNAME', 'lb-' || c_nationkey, 'N/A'), ('none', 'TXT', 'N/A', 'N/A')) r(name, type, v, ttl)""",
)
def res_route53(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    never = k < 0

    def record(name: Column, kind: str, ttl: bool, values: Column | None, alias: Column | None) -> Column:
        listed = values if values is not None else F.array(lit(""))
        rows = F.transform(listed, lambda v: F.struct(v.alias("Value")))
        return obj(
            Name=name, Type=lit(kind), TTL=F.when(~never if ttl else never, F.lit(300)),
            ResourceRecords=F.when(~never if values is not None else never, rows),
            AliasTarget=F.when(~never if alias is not None else never, obj(DNSName=alias if alias is not None else lit(""))),
        )

    records = F.array(
        record(cat("w.", F.col("c_mktsegment")), "A", True, F.array(lit("1.1.1.1"), cat("2.2.2.", n)), None),
        record(lit("alias"), "CNAME", False, None, cat("lb-", n)),
        record(lit("none"), "TXT", False, None, None),
    )
    land = Landing("route53", table(spark, sf, "customer", spread=True), "c_custkey")
    land.page("zones", obj(HostedZones=F.array(obj(Id=cat("/hostedzone/Z", k), Name=cat("zone", k, ".")))))
    return land.page("records", obj(HostedZoneId=cat("Z", k), ResourceRecordSets=records)).flat()


@check(
    "res_cloudfront",
    f"""SELECT 'E' || c_custkey AS distribution_id, CASE WHEN c_nationkey < 10 THEN c_name ELSE 'N/A' END AS distribution_name,
      'd' || c_custkey || '.cdn.net' AS domain_name, CASE WHEN c_nationkey < 10 THEN 'Deployed' ELSE 'InProgress' END AS status,
      CASE WHEN c_nationkey < 10 THEN '[{{"id":"o1","domain":"b' || c_custkey || '.s3.amazonaws.com","type":"S3"}},{{"id":"o2","domain":"x.org","type":"Custom"}}]'
        ELSE '[]' END AS origins,
      CASE WHEN c_nationkey < 10 THEN '{{"target_origin":"o1","viewer_protocol":"https-only"}}' ELSE '{{"target_origin":"","viewer_protocol":""}}' END AS default_cache_behavior,
      CASE WHEN c_nationkey < 10 THEN 'Default + 2 custom behaviors' ELSE 'Default only' END AS cache_behaviors,
      CASE WHEN c_nationkey < 10 THEN c_mktsegment ELSE '' END AS comment,
      CASE WHEN c_nationkey < 10 THEN 'PriceClass_100' ELSE 'PriceClass_All' END AS price_class, c_nationkey < 10 AS enabled,
      'N/A' AS web_acl, CASE WHEN c_nationkey < 10 THEN '2024-01-02T03:04:05' ELSE '' END AS last_modified, {env('c_custkey')}
    FROM customer WHERE c_custkey % 3 = 0""",
)
def res_cloudfront(spark: SparkSession, sf: str) -> DataFrame:
    """Listed in every region, read from one; distributions of high nations have no details."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    cid, domain = cat("E", k), cat("d", k, ".cdn.net")
    config = obj(
        Origins=obj(Items=F.array(obj(Id=lit("o1"), DomainName=cat("b", k, ".s3.amazonaws.com")), obj(Id=lit("o2"), DomainName=lit("x.org")))),
        DefaultCacheBehavior=obj(TargetOriginId=lit("o1"), ViewerProtocolPolicy=lit("https-only")),
        CacheBehaviors=obj(Items=F.array(obj(PathPattern=lit("/a")), obj(PathPattern=lit("/b")))),
        Comment=F.col("c_mktsegment"), PriceClass=lit("PriceClass_100"), Enabled=F.lit(True),
    )
    full = obj(
        Id=cid, DomainName=domain, Status=lit("Deployed"), LastModifiedTime=lit("2024-01-02T03:04:05"), DistributionConfig=config
    )
    land = Landing("cloudfront", table(spark, sf, "customer", spread=True), "c_custkey")
    summary = obj(Id=cid, DomainName=domain, Status=lit("InProgress"))
    land.page("distributions", obj(DistributionList=obj(Items=F.array(summary))))
    detail = obj(Distribution=full, Tags=obj(Items=F.array(tag("Name", F.col("c_name")))))
    return land.page("details", detail, land.base.where(n < 10)).flat()


@check(
    "res_apigateway",
    f"""SELECT 'rest-' || o_orderkey AS api_id, CASE WHEN o_orderstatus = 'F' THEN 'N/A' ELSE o_orderpriority END AS name,
      'N/A' AS description, 'REST' AS protocol, CASE WHEN o_orderstatus = 'O' THEN 'EDGE' ELSE 'REGIONAL' END AS endpoint_type,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS created_date, {env('o_orderkey')} FROM orders
    UNION ALL
    SELECT 'http-' || o_orderkey, 'h' || o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'N/A' ELSE o_orderstatus END,
      CASE WHEN o_orderstatus = 'O' THEN 'WEBSOCKET' ELSE 'HTTP' END, 'https://' || o_orderkey,
      CASE WHEN o_orderstatus = 'F' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') END, {env('o_orderkey')} FROM orders""",
)
def res_apigateway(spark: SparkSession, sf: str) -> DataFrame:
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    created = F.date_format("o_orderdate", ISO)
    rest = obj(
        id=cat("rest-", k), name=F.when(st == "F", lit("")).otherwise(F.col("o_orderpriority")),
        endpointConfiguration=F.when(st == "O", obj(types=F.array(lit("EDGE"), lit("X")))), createdDate=cat(created, "Z"),
    )
    http = obj(
        ApiId=cat("http-", k), Name=cat("h", F.col("o_custkey")), Description=F.when(st == "F", lit("")).otherwise(st),
        ProtocolType=F.when(st == "O", lit("WEBSOCKET")).when(st == "F", lit("")), ApiEndpoint=cat("https://", k),
        CreatedDate=F.when(st != "F", cat(created, "+00:00")),
    )
    land = Landing("apigateway", table(spark, sf, "orders", spread=True), "o_orderkey")
    return land.page("rest_apis", obj(items=F.array(rest))).page("apis", obj(Items=F.array(http))).flat()


@check(
    "res_transfer_family",
    f"""SELECT 's-' || s_suppkey AS server_id, CASE WHEN s_acctbal > 7000 THEN 'EFS' ELSE 'S3' END AS domain,
      CASE WHEN s_acctbal > 7000 THEN 'VPC: vpc-' || s_nationkey || ', Subnets: 2' WHEN s_acctbal > 4000 THEN 'VPC Endpoint: N/A'
        WHEN s_acctbal > 1000 THEN 'Public' ELSE 'N/A' END AS endpoint,
      CASE WHEN s_acctbal > 4000 THEN 'ONLINE' ELSE 'UNKNOWN' END AS state, {env('s_suppkey')} FROM supplier""",
)
def res_transfer_family(spark: SparkSession, sf: str) -> DataFrame:
    k, bal = F.col("s_suppkey"), F.col("s_acctbal")
    sid = cat("s-", k)
    server = obj(
        ServerId=sid, Domain=F.when(bal > 7000, lit("EFS")), State=F.when(bal > 4000, lit("ONLINE")),
        EndpointType=F.when(bal > 7000, lit("VPC")).when(bal > 4000, lit("VPC_ENDPOINT")),
        EndpointDetails=F.when(bal > 7000, obj(VpcId=cat("vpc-", F.col("s_nationkey")), SubnetIds=F.array(lit("a"), lit("b")))),
    )
    land = Landing("transfer", table(spark, sf, "supplier"), "s_suppkey").page("servers", obj(Servers=F.array(obj(ServerId=sid))))
    return land.page("details", obj(Server=server), land.base.where(bal > 1000)).flat()


# ---------------------------------------------------------------- data services


@check(
    "res_rds",
    f"""SELECT c_name AS db_instance_id, CASE WHEN c_nationkey < 5 THEN 'N/A' ELSE 'db' || c_custkey END AS db_name, 'postgres' AS engine_type,
      'N/A' AS engine_version, CASE WHEN c_nationkey < 5 THEN 'N/A' ELSE CAST(100 + c_nationkey AS VARCHAR) END AS storage_size,
      c_mktsegment AS instance_type, 'available' AS status, CASE WHEN c_nationkey < 5 THEN 'N/A' ELSE 'h' || c_custkey END AS endpoint,
      CASE WHEN c_nationkey < 5 THEN 'N/A' ELSE '5432' END AS port, CASE WHEN c_nationkey < 10 THEN 'N/A' ELSE 'vpc-' || c_custkey END AS vpc,
      c_nationkey > 20 AS has_replica, {env('c_custkey')} FROM customer""",
)
def res_rds(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    db = obj(
        DBInstanceIdentifier=F.col("c_name"), DBName=F.when(n >= 5, cat("db", k)), Engine=lit("postgres"),
        AllocatedStorage=F.when(n >= 5, n + 100), DBInstanceClass=F.col("c_mktsegment"), DBInstanceStatus=lit("available"),
        Endpoint=F.when(n >= 5, obj(Address=cat("h", k), Port=F.lit(5432))),
        DBSubnetGroup=F.when(n >= 8, obj(DBSubnetGroupName=cat("g", k))),
        ReadReplicaDBInstanceIdentifiers=F.when(n > 20, F.array(lit("r"))).when(n > 15, F.expr("cast(array() as array<string>)")),
    )
    land = Landing("rds", table(spark, sf, "customer", spread=True), "c_custkey").page("instances", obj(DBInstances=F.array(db)))
    groups = obj(DBSubnetGroups=F.array(obj(DBSubnetGroupName=cat("g", k), VpcId=cat("vpc-", k))))
    return land.page("subnet_groups", groups, land.base.where(n >= 10)).flat()


@check(
    "res_redshift",
    f"""SELECT s_name AS database_id, CASE WHEN s_acctbal > 0 THEN 'app' || s_nationkey ELSE 'N/A' END AS app_id, 'dw' AS database_name,
      'N/A' AS node_type, CAST(CASE WHEN s_acctbal > 5000 THEN 4 ELSE 1 END AS BIGINT) AS node_count, '1.0' AS engine_version,
      CASE WHEN s_acctbal > 5000 THEN CAST(s_nationkey * 1000 AS VARCHAR) ELSE '0' END AS storage_size, 'available' AS status,
      CASE WHEN s_acctbal > 5000 THEN 'e' || s_suppkey ELSE 'N/A' END AS endpoint,
      CAST(CASE WHEN s_acctbal > 5000 THEN 5439 ELSE 0 END AS BIGINT) AS port, 'N/A' AS replication, {env('s_suppkey')} FROM supplier""",
)
def res_redshift(spark: SparkSession, sf: str) -> DataFrame:
    k, rich = F.col("s_suppkey"), F.col("s_acctbal") > 5000
    cluster = obj(
        ClusterIdentifier=F.col("s_name"), DBName=lit("dw"), NumberOfNodes=F.when(rich, F.lit(4)), ClusterVersion=lit("1.0"),
        TotalStorageCapacityInMegaBytes=F.when(rich, F.col("s_nationkey") * 1000), ClusterStatus=lit("available"),
        Endpoint=F.when(rich, obj(Address=cat("e", k), Port=F.lit(5439))),
        Tags=F.when(F.col("s_acctbal") > 0, F.array(tag("AppId", lit("old")), tag("AppId", cat("app", F.col("s_nationkey"))))),
    )
    return Landing("redshift", table(spark, sf, "supplier"), "s_suppkey").page("clusters", obj(Clusters=F.array(cluster))).flat()


@check(
    "res_s3",
    f"""WITH p AS (SELECT *, CASE WHEN p_size > 45 THEN 0 ELSE p_size * 1024 + p_size * 1024 * 1024 END AS bytes FROM part)
    SELECT 'b-' || p_partkey AS bucket_name, CASE WHEN p_size > 25 THEN p_name ELSE 'b-' || p_partkey END AS bucket_name_display,
      CASE WHEN p_size > 40 THEN 'eu-west-3' ELSE 'us-east-1' END AS region, 'Active' AS status,
      CASE WHEN p_size > 25 THEN p_brand ELSE 'N/A' END AS owner,
      CASE WHEN p_size > 40 THEN 'Lambda,SNS' WHEN p_size > 25 THEN 'SNS' ELSE 'None' END AS integrations,
      CASE WHEN p_size > 40 THEN 'Private' WHEN p_size > 25 THEN 'Public' ELSE 'Unknown' END AS network_config,
      CASE WHEN p_size > 25 THEN 'Enabled' ELSE 'Disabled' END AS backup_recovery,
      CASE WHEN p_size > 40 THEN 'Enabled' ELSE 'Disabled' END AS encryption,
      CASE WHEN p_size > 25 THEN 'Enabled' ELSE 'Disabled' END AS versioning,
      CASE WHEN bytes = 0 THEN '0 B' ELSE CAST(CAST(round_even(bytes / 1048576.0::DOUBLE, 2) AS DECIMAL(18, 2)) AS VARCHAR) || ' MB' END AS capacity,
      'a' || (p_partkey % 25) AS account_id, 'acct ' || (p_partkey % 25) AS account_name FROM p""",
)
def res_s3(spark: SparkSession, sf: str) -> DataFrame:
    """Settings by size of the part; capacity from two storage classes, stale and foreign datapoints left out."""
    k, size = F.col("p_partkey"), F.col("p_size")
    name, some = cat("b-", k), F.array(obj(Id=lit("1")))
    detail = obj(
        Bucket=name, TagSet=F.when(size > 25, F.array(tag("Owner", F.col("p_brand")), tag("Name", F.col("p_name")))),
        VersioningStatus=F.when(size > 25, lit("Enabled")), LocationConstraint=F.when(size > 40, lit("eu-west-3")),
        PublicAccessBlockConfiguration=F.when(size > 25, obj(BlockPublicAcls=size > 40)),
        NotificationConfiguration=obj(
            LambdaConfigurations=F.when(size > 40, some), QueueConfigurations=F.when(size < 0, some),
            TopicConfigurations=F.when(size > 25, some),
        ),
        ReplicationConfiguration=F.when(size > 25, obj(Role=lit("r"))),
        ServerSideEncryptionConfiguration=F.when(size > 40, obj(Rules=F.array(lit("r")))),
    )
    land = Landing("s3", table(spark, sf, "part", spread=True), "p_partkey").page("buckets", obj(Buckets=F.array(obj(Name=name))))
    land.page("details", detail)
    points = F.array(
        *[
            obj(kind=lit(kind), at=lit(at), n=n)
            for kind, at, n in (
                ("StandardStorage", "2024-01-10 00:00:00", size * 7),
                ("StandardStorage", "2024-01-14 00:00:00", size * 1024),
                ("GlacierStorage", "2024-01-14 00:00:00", size * 1024 * 1024),
                ("ReducedRedundancyStorage", "2024-01-01 00:00:00", size * 5),
                ("OtherStorage", "2024-01-14 00:00:00", size * 3),
            )
        ]
    )
    rows = land.base.where(size <= 45).withColumn("p", F.explode(points))
    point = obj(
        Bucket=name, StorageType=F.col("p.kind"), Timestamp=mixed_zones(F.col("p.at").cast("timestamp_ntz"), F.col("p_partkey")), Maximum=F.col("p.n").cast("double")
    )
    return land.page("metrics", point, rows).flat()


@check(
    "res_glue",
    f"""SELECT p_name || ' ' || p_partkey AS job_name, CASE WHEN p_size > 40 THEN 'Streaming' WHEN p_size > 25 THEN 'Python Shell' ELSE 'ETL' END AS type,
      CASE WHEN p_size > 40 THEN '2024-01-02 01:04:05 UTC' WHEN p_size > 25 THEN '2024-01-02 03:04:05' ELSE 'N/A' END AS domain,
      CASE WHEN p_size > 40 THEN 'Visual' WHEN p_size > 30 THEN 'Notebook' WHEN p_size > 20 THEN 'Script' WHEN p_size > 10 THEN 'Script'
        ELSE 'Visual' END AS created_by, CASE WHEN p_size > 25 THEN '4.0' ELSE 'N/A' END AS glue_version, {env('p_partkey')} FROM part""",
)
def res_glue(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    job = obj(
        Name=cat(F.col("p_name"), " ", F.col("p_partkey")),
        Command=obj(
            Name=F.when(size > 40, lit("gluestreaming")).when(size > 25, lit("pythonshell")),
            ScriptLocation=F.when(size > 30, lit("s3://b/n.ipynb")).when(size > 20, lit("s3://b/n.py")),
        ),
        CodeGenConfigurationNodes=F.when(size > 40, F.create_map(lit("node"), lit("1"))),
        DefaultArguments=F.when(size > 10, F.create_map(lit("--enable-glue-datacatalog"), lit("true"))),
        CreatedOn=F.when(size > 40, lit("2024-01-02T03:04:05+02:00")).when(size > 25, lit("2024-01-02T03:04:05")),
        GlueVersion=F.when(size > 25, lit("4.0")),
    )
    return Landing("glue", table(spark, sf, "part", spread=True), "p_partkey").page("jobs", obj(Jobs=F.array(job))).flat()


def execution(detail_id: Column) -> Column:
    kind, uid = F.col("event_type"), F.col("user_id")
    return obj(
        QueryExecutionId=detail_id,
        Query=F.when(kind == "click", cat("select a from t", uid, " where b")).when(kind == "signup", cat("show tables ", uid)),
        QueryExecutionContext=F.when(kind != "view", obj(Database=cat("db", uid))),
        Statistics=F.when(kind != "view", obj(TotalExecutionTimeInMillis=F.floor(F.col("value")))),
        Status=obj(State=lit("SUCCEEDED"), SubmissionDateTime=mixed_zones(F.col("ts"), F.col("event_id"))),
        WorkGroup=F.when(kind == "purchase", lit("wg")),
    )


_Q = """CASE event_type WHEN 'view' THEN 'N/A' ELSE 'db' || user_id END"""


@check(
    "res_athena",
    f"""SELECT 'query' || event_id AS query_id, 'Query-' || left('query' || event_id, 8) AS query_name, {_Q} AS domain,
      CASE event_type WHEN 'click' THEN 'select a from t' || user_id || ' where b' WHEN 'signup' THEN 'show tables ' || user_id ELSE 'N/A' END AS description,
      {_Q} AS database_name, CASE event_type WHEN 'click' THEN 'T' || user_id ELSE 'N/A' END AS tables_used,
      CASE event_type WHEN 'view' THEN 0.0::DOUBLE ELSE floor(value) / 1000.0::DOUBLE END AS execution_duration, 'On-demand' AS execution_frequency,
      CASE event_type WHEN 'purchase' THEN 'wg' ELSE 'primary' END AS owner, {env('event_id')} FROM events
    QUALIFY row_number() OVER (PARTITION BY event_id % 25, event_id % 3 ORDER BY ts DESC, query_id) <= 50""",
)
def res_athena(spark: SparkSession, sf: str) -> DataFrame:
    doc = obj(QueryExecution=execution(cat("query", F.col("event_id"))))
    return Landing("athena", table(spark, sf, "events", spread=True), "event_id", newest_queries=50).page("executions", doc).flat()


@check(
    "res_tax",
    f"""WITH q AS (SELECT *, CASE WHEN event_type = 'error' THEN 'N/A' ELSE {_Q} END AS db FROM events)
    SELECT 'query' || event_id AS query_id, 'Query-' || left('query' || event_id, 8) AS query_name, db AS domain,
      CASE event_type WHEN 'click' THEN 'select a from t' || user_id || ' where b' WHEN 'signup' THEN 'show tables ' || user_id
        WHEN 'error' THEN 'N/A' ELSE '' END AS description,
      db AS database_name, CASE event_type WHEN 'click' THEN 'T' || user_id ELSE 'N/A' END AS tables_used,
      CASE WHEN event_type IN ('view', 'error') THEN 0.0::DOUBLE ELSE floor(value) / 1000.0::DOUBLE END AS execution_duration,
      'On-demand' AS execution_frequency,
      CASE event_type WHEN 'purchase' THEN 'wg' WHEN 'error' THEN 'N/A' ELSE 'primary' END AS owner, {env('event_id')} FROM q
    QUALIFY row_number() OVER (PARTITION BY event_id % 25, event_id % 3 ORDER BY ts DESC, query_id) <= 50""",
)
def res_tax(spark: SparkSession, sf: str) -> DataFrame:
    """Listed ids with details; failed lookups (errors) keep the defaults."""
    qid = cat("query", F.col("event_id"))
    land = Landing("tax", table(spark, sf, "events", spread=True), "event_id", newest_queries=50)
    at = mixed_zones(F.col("ts"), F.col("event_id"))
    land.page("listed", obj(QueryExecutions=F.array(obj(QueryExecutionId=qid, SubmissionDateTime=at))))
    return land.page("executions", obj(QueryExecution=execution(qid)), land.base.where(F.col("event_type") != "error")).flat()


# ---------------------------------------------------------------- delivery and configuration


@check(
    "res_cloudformation",
    f"""SELECT 'st-' || o_orderkey AS stack_name, CASE WHEN o_orderpriority = '5-LOW' THEN 'N/A' ELSE 'S_' || o_orderstatus END AS stack_status,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS creation_time, CASE WHEN o_orderstatus = 'O' THEN 'N/A' ELSE o_orderpriority END AS description,
      CASE WHEN o_orderstatus = 'O' THEN 'CAP_A, CAP_B' ELSE 'N/A' END AS capabilities, {env('o_orderkey')} FROM orders
    WHERE o_orderpriority <> '1-URGENT'""",
)
def res_cloudformation(spark: SparkSession, sf: str) -> DataFrame:
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    stack = obj(
        StackName=cat("st-", F.col("o_orderkey")),
        StackStatus=F.when(pr == "1-URGENT", lit("DELETE_COMPLETE")).when(pr != "5-LOW", cat("S_", st)),
        CreationTime=mixed_zones(F.col("o_orderdate"), F.col("o_orderkey")),
        Description=F.when(st == "O", lit("")).otherwise(pr),
        Capabilities=F.when(st == "O", F.array(lit("CAP_A"), lit("CAP_B"))).when(st == "F", F.expr("cast(array() as array<string>)")),
    )
    return Landing("cloudformation", table(spark, sf, "orders", spread=True), "o_orderkey").page("stacks", obj(Stacks=F.array(stack))).flat()


@check(
    "res_cloudtrail_trails",
    f"""SELECT s_name AS trail_name, CASE WHEN s_acctbal > 5000 THEN 's3://logs' || s_nationkey || '/pre' WHEN s_acctbal > 0 THEN 's3://logs' || s_nationkey || '/'
        ELSE 'N/A' END AS log_location, CASE WHEN s_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS is_multi_region, 'No' AS is_organization,
      CASE WHEN s_acctbal > 5000 THEN 'No' ELSE 'Yes' END AS include_global_events, {env('s_suppkey')} FROM supplier""",
)
def res_cloudtrail_trails(spark: SparkSession, sf: str) -> DataFrame:
    bal = F.col("s_acctbal")
    trail = obj(
        Name=F.col("s_name"), S3BucketName=F.when(bal > 0, cat("logs", F.col("s_nationkey"))),
        S3KeyPrefix=F.when(bal > 5000, lit("pre")), IsMultiRegionTrail=F.when(bal > 5000, F.lit(True)),
        IsOrganizationTrail=F.when(bal > 5000, F.lit(False)), IncludeGlobalServiceEvents=F.when(bal > 5000, F.lit(False)),
    )
    return Landing("cloudtrail_trails", table(spark, sf, "supplier"), "s_suppkey").page("trails", obj(trailList=F.array(trail))).flat()


@check(
    "res_ssm",
    f"""WITH c AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'N') AS good,
        count(*) FILTER (WHERE l_returnflag <> 'N') AS bad FROM lineitem GROUP BY l_orderkey),
    j AS (SELECT orders.*, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad FROM orders LEFT JOIN c ON l_orderkey = o_orderkey)
    SELECT 'as-' || o_orderkey AS association_id, CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE o_orderpriority END AS association_name, 'doc' AS domain,
      good AS compliant_resources, bad AS non_compliant_resources,
      CASE WHEN good + bad = 0 THEN 0.0::DOUBLE ELSE round_even(good::DOUBLE / (good + bad) * 100.0::DOUBLE, 2) END AS compliance_percentage,
      CAST(floor(bad * 0.3::DOUBLE) AS BIGINT) AS non_compliant_15_days, CAST(floor(bad * 0.4::DOUBLE) AS BIGINT) AS non_compliant_15_90_days,
      bad - CAST(floor(bad * 0.3::DOUBLE) AS BIGINT) - CAST(floor(bad * 0.4::DOUBLE) AS BIGINT) AS non_compliant_90_days, {env('o_orderkey')} FROM j""",
)
def res_ssm(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are associations, their lines the compliance items."""
    assoc = obj(
        AssociationId=cat("as-", F.col("o_orderkey")), DocumentName=lit("doc"),
        Name=F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
    )
    item = obj(
        Id=cat("as-", F.col("l_orderkey")),
        Status=F.when(F.col("l_returnflag") == "N", lit("COMPLIANT")).when(F.col("l_returnflag") == "R", lit("NON_COMPLIANT")),
    )
    land = Landing("ssm", table(spark, sf, "orders", spread=True), "o_orderkey").page("associations", obj(Associations=F.array(assoc)))
    return land.page("compliance", obj(ComplianceItems=F.array(item)), table(spark, sf, "lineitem", spread=True), "l_orderkey").flat()


@check(
    "res_stepfunctions",
    f"""SELECT 'arn:aws:states:r:1:stateMachine:sm' || c_custkey AS stepfunction_arn, 'sm' || c_custkey AS instance_id, c_name AS stepfunction_name,
      CASE WHEN c_nationkey < 10 THEN 'N/A' ELSE c_mktsegment END AS description,
      CAST(CASE WHEN c_nationkey < 5 THEN 1 WHEN c_nationkey < 15 THEN 2 ELSE 1 END AS BIGINT) AS triggers,
      CAST(CASE WHEN c_nationkey < 5 THEN 1 WHEN c_nationkey < 10 THEN 0 WHEN c_nationkey < 20 THEN 3 ELSE 1 END AS BIGINT) AS versions,
      CASE WHEN c_nationkey < 5 THEN 'N/A' ELSE 'role' || c_nationkey END AS roles_permissions, 'ACTIVE' AS status, {env('c_custkey')} FROM customer""",
)
def res_stepfunctions(spark: SparkSession, sf: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    arn = cat("arn:aws:states:r:1:stateMachine:sm", k)
    machine = obj(stateMachineArn=arn, name=F.col("c_name"), definition=F.when(n >= 10, F.col("c_mktsegment")))
    land = Landing("stepfunctions", table(spark, sf, "customer", spread=True), "c_custkey")
    land.page("state_machines", obj(stateMachines=F.array(machine)))
    land.page("details", obj(stateMachineArn=arn, roleArn=cat("arn:aws:iam::1:role/role", n)), land.base.where(n >= 5))
    versions = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(i.cast("string").alias("stateMachineVersionArn")))
    kept = F.when(n < 10, F.slice(versions, 1, 0)).otherwise(versions)
    land.page("versions", obj(stateMachineArn=arn, stateMachineVersions=kept), land.base.where(n < 20))
    names = F.array(*[obj(name=lit(x)) for x in ("cron-1", "cron-2", "", "api-9")])
    return land.page("executions", obj(stateMachineArn=arn, executions=names), land.base.where(n < 15)).flat()


@check(
    "res_delivery",
    f"""SELECT 'pl-' || c_custkey AS pipeline_name, CASE WHEN c_nationkey < 5 THEN 'Unknown' WHEN c_nationkey < 10 THEN 'Never executed'
        WHEN c_nationkey < 20 THEN c_mktsegment ELSE 'Unknown' END AS last_execution_status,
      CASE WHEN c_nationkey < 10 THEN 'N/A' WHEN c_nationkey < 20 THEN 'src:' || left('abcdef012345' || c_custkey, 10) || ', N/A:N/A, b:r' ELSE 'N/A' END AS latest_source_revisions,
      CASE WHEN c_nationkey < 10 OR c_nationkey >= 20 THEN NULL ELSE '2024-01-02 03:04:05.678000' END AS last_execution_started,
      CAST(CASE WHEN c_nationkey < 10 THEN 0 WHEN c_nationkey < 20 THEN 5 ELSE 1 END AS BIGINT) AS recent_executions, {env('c_custkey')} FROM customer""",
)
def res_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """Table codepipeline: the newest of at most five executions, and three of its revisions."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    name, none = cat("pl-", k), F.when(k < 0, lit(""))
    revisions = F.array(
        obj(actionName=lit("src"), revisionId=cat("abcdef012345", k)), obj(actionName=none, revisionId=none),
        obj(actionName=lit("b"), revisionId=lit("r")), obj(actionName=lit("c"), revisionId=lit("dropped")),
    )
    full = obj(status=F.col("c_mktsegment"), startTime=lit("2024-01-02T03:04:05.678+01:00"), sourceRevisions=revisions)
    bare = obj(status=none, startTime=none, sourceRevisions=F.when(k < 0, revisions))
    runs = F.when(n < 10, F.slice(F.array(full), 1, 0)).when(n < 20, F.array(*[full] * 7)).otherwise(F.array(bare))
    land = Landing("codepipeline", table(spark, sf, "customer", spread=True), "c_custkey").page("listed", obj(pipelines=F.array(obj(name=name))))
    return land.page("executions", obj(pipelineName=name, pipelineExecutionSummaries=runs), land.base.where(n >= 5)).flat()


@check(
    "res_codebuild",
    f"""SELECT 'pr-' || p_partkey AS project_name, CASE WHEN p_size > 25 THEN 'GITHUB' ELSE 'N/A' END AS source_provider,
      CASE WHEN p_size > 25 THEN p_brand ELSE 'N/A' END AS repository, 'N/A' AS last_build_status,
      CASE WHEN p_size > 25 THEN p_name ELSE 'N/A' END AS description,
      CASE WHEN p_size > 40 THEN '2024-01-02 03:04:05.000000' WHEN p_size > 25 THEN 'yesterday' ELSE NULL END AS last_modified,
      {env_no_region('p_partkey')} FROM part WHERE p_size > 3""",
)
def res_codebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Listed names with separately landed projects; the smallest parts were listed without a project."""
    size, name = F.col("p_size"), cat("pr-", F.col("p_partkey"))
    project = obj(
        name=name, source=F.when(size > 25, obj(type=lit("GITHUB"), location=F.col("p_brand"))),
        description=F.when(size > 25, F.col("p_name")),
        lastModified=F.when(size > 40, lit("2024-01-02T03:04:05+01:00")).when(size > 25, lit("yesterday")),
    )
    land = Landing("codebuild", table(spark, sf, "part", spread=True), "p_partkey").page("listed", obj(projects=F.array(name)))
    return land.page("projects", obj(projects=F.array(project)), land.base.where(size > 3)).flat()


@check(
    "res_sns",
    f"""SELECT 'arn:aws:sns:r:' || s_nationkey || ':t' || s_suppkey AS topic_arn, 't' || s_suppkey AS topic_name, 'N/A' AS domain,
      't' || s_suppkey AS display_name, 'Standard' AS type, {env_no_region('s_suppkey')} FROM supplier""",
)
def res_sns(spark: SparkSession, sf: str) -> DataFrame:
    topic = obj(TopicArn=cat("arn:aws:sns:r:", F.col("s_nationkey"), ":t", F.col("s_suppkey")))
    return Landing("sns", table(spark, sf, "supplier"), "s_suppkey").page("topics", obj(Topics=F.array(topic))).flat()


@check(
    "res_kms",
    f"""SELECT 'k-' || c_custkey AS key_id, CASE WHEN c_nationkey < 10 THEN 'alias/a' || c_custkey || ', alias/b' ELSE 'N/A' END AS key_name,
      CASE WHEN c_nationkey < 5 THEN 'N/A' ELSE 'Enabled' END AS estado, CASE WHEN c_nationkey < 15 THEN 'Simétrica' ELSE 'Asimétrica' END AS key_type,
      CASE WHEN c_nationkey < 15 THEN 'SYMMETRIC_DEFAULT' ELSE 'RSA_2048' END AS key_spec,
      CASE WHEN c_nationkey < 10 THEN '[{{"TagKey":"seg","TagValue":"' || c_mktsegment || '"}}]' ELSE '[]' END AS tags,
      {env_no_region('c_custkey')} FROM customer WHERE c_nationkey < 20""",
)
def res_kms(spark: SparkSession, sf: str) -> DataFrame:
    """Customer-managed keys; those of the last nations are vendor-managed and left out."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    kid = cat("k-", k)
    meta = obj(
        KeyId=kid, KeyManager=F.when(n < 20, lit("CUSTOMER")).otherwise(lit("AWS")), KeyState=F.when(n >= 5, lit("Enabled")),
        KeySpec=F.when(n >= 15, lit("RSA_2048")),
    )
    land = Landing("kms", table(spark, sf, "customer", spread=True), "c_custkey").page("keys", obj(KeyMetadata=meta))
    few = land.base.where(n < 10)
    land.page("aliases", obj(KeyId=kid, Aliases=F.array(obj(AliasName=cat("alias/a", k)), obj(AliasName=lit("alias/b")))), few)
    return land.page("tags", obj(KeyId=kid, Tags=F.array(obj(TagKey=lit("seg"), TagValue=F.col("c_mktsegment")))), few).flat()
