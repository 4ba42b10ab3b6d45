"""Networks, subnets, DNS records, distributions, APIs, file-transfer servers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.functions.dates import micros_text
from inventrace.functions.text import (
    MISSING,
    count_of,
    join_or,
    or_default,
    or_default_blank,
    tag_value,
)
from inventrace.operators.gather import containing, either_side, gather_all, last_association, lookup, two_hop
from inventrace.sources.landed import items
from inventrace.specs.model import PROVENANCE, Raw, ResourceSpec

TAGS = "array<struct<Key: string, Value: string>>"
SCOPE = ["account_id", "region"]

# Child datasets of a network: name -> (list attribute, id attribute).
_CHILDREN = {
    "subnets": ("Subnets", "SubnetId"),
    "security_groups": ("SecurityGroups", "GroupId"),
    "network_acls": ("NetworkAcls", "NetworkAclId"),
    "vpn_connections": ("VpnConnections", "VpnConnectionId"),
    "vpc_endpoints": ("VpcEndpoints", "VpcEndpointId"),
    "route_tables": ("RouteTables", "RouteTableId"),
}

_RAW = {
    "vpcs": f"Vpcs array<struct<VpcId: string, CidrBlock: string, State: string, Tags: {TAGS}>>",
    "subnets": (
        "Subnets array<struct<SubnetId: string, VpcId: string, CidrBlock: string, AvailabilityZone: string, "
        f"State: string, Tags: {TAGS}>>"
    ),
    "security_groups": "SecurityGroups array<struct<GroupId: string, VpcId: string>>",
    "network_acls": (
        "NetworkAcls array<struct<NetworkAclId: string, VpcId: string, Associations: array<struct<SubnetId: string>>>>"
    ),
    "internet_gateways": (
        "InternetGateways array<struct<InternetGatewayId: string, Attachments: array<struct<VpcId: string>>>>"
    ),
    "vpn_connections": "VpnConnections array<struct<VpnConnectionId: string, VpcId: string>>",
    "vpc_endpoints": (
        "VpcEndpoints array<struct<VpcEndpointId: string, VpcId: string, SubnetIds: array<string>>>"
    ),
    "vpc_peerings": (
        "VpcPeeringConnections array<struct<VpcPeeringConnectionId: string, "
        "RequesterVpcInfo: struct<VpcId: string>, AccepterVpcInfo: struct<VpcId: string>>>"
    ),
    "route_tables": (
        "RouteTables array<struct<RouteTableId: string, VpcId: string, Associations: array<struct<SubnetId: string>>>>"
    ),
    "network_interfaces": (
        "NetworkInterfaces array<struct<NetworkInterfaceId: string, SubnetId: string, Groups: array<struct<GroupId: string>>>>"
    ),
}


def _gateways(raw: Raw) -> DataFrame:
    d = F.col("d")
    links = items(raw["internet_gateways"], "InternetGateways").select(
        *SCOPE, d["InternetGatewayId"].alias("item"), F.explode(d["Attachments"]).alias("a")
    )
    return links.select(*SCOPE, F.col("a.VpcId").alias("vpc_id"), "item")


def flatten_vpcs(raw: Raw) -> DataFrame:
    d = F.col("d")
    base = items(raw["vpcs"], "Vpcs").select(
        *SCOPE, "account_name", d["VpcId"].alias("vpc_id"), d.alias("d")
    )
    children = {
        name: (items(raw[name], path).select(*SCOPE, d["VpcId"].alias("vpc_id"), d[item].alias("item")), "item")
        for name, (path, item) in _CHILDREN.items()
    }
    children["route_rules"] = children.pop("route_tables")
    children["internet_gateways"] = (_gateways(raw), "item")
    peerings = items(raw["vpc_peerings"], "VpcPeeringConnections")
    children["vpc_peerings"] = (
        peerings.select(
            *SCOPE, d["RequesterVpcInfo"]["VpcId"].alias("vpc_id"), d["VpcPeeringConnectionId"].alias("item")
        ),
        "item",
    )
    children["availability_zones"] = (
        items(raw["subnets"], "Subnets").select(
            *SCOPE, d["VpcId"].alias("vpc_id"), d["AvailabilityZone"].alias("item")
        ),
        "item",
    )
    joined = gather_all(base, [*SCOPE, "vpc_id"], children)
    return joined.select(
        "vpc_id",
        tag_value(d["Tags"], "Name").alias("vpc_name"),
        d["CidrBlock"].alias("cidr_block"),
        d["State"].alias("state"),
        "region",
        "subnets", "security_groups", "network_acls", "internet_gateways", "vpn_connections",
        "vpc_endpoints", "vpc_peerings",
        F.coalesce(d["Tags"], F.expr(f"cast(array() as {TAGS})")).alias("tags"),
        "availability_zones", "route_rules",
        *PROVENANCE,
    )


_VPC_LISTS = (
    "subnets", "security_groups", "network_acls", "internet_gateways", "vpc_endpoints", "vpc_peerings", "route_rules",
)

VPCS = ResourceSpec(
    table="vpcs",
    service="vpc",
    service_type="VPC",
    columns=(
        "vpc_id string, vpc_name string, cidr_block string, state string, region string, subnets array<string>, "
        "security_groups array<string>, network_acls array<string>, internet_gateways array<string>, "
        "vpn_connections array<string>, vpc_endpoints array<string>, vpc_peerings array<string>, "
        f"tags {TAGS}, availability_zones array<string>, route_rules array<string>, account_name string, "
        "account_id string"
    ),
    key=("vpc_id", "account_id"),
    resource_id="vpc_id",
    comparators={c: "array" for c in _VPC_LISTS},
    raw={k: v for k, v in _RAW.items() if k != "network_interfaces"},
    flatten=flatten_vpcs,
)


def flatten_subnets(raw: Raw) -> DataFrame:
    d = F.col("d")
    base = items(raw["subnets"], "Subnets").select(
        *SCOPE, "account_name", d["SubnetId"].alias("subnet_id"), d["VpcId"].alias("vpc_id"), d.alias("d")
    )
    vpc_key, subnet_key = [*SCOPE, "vpc_id"], [*SCOPE, "subnet_id"]

    names = items(raw["vpcs"], "Vpcs").select(
        *SCOPE, d["VpcId"].alias("vpc_id"), tag_value(d["Tags"], "Name").alias("vpc_name")
    )
    vpns = items(raw["vpn_connections"], "VpnConnections").select(
        *SCOPE, d["VpcId"].alias("vpc_id"), d["VpnConnectionId"].alias("item")
    )

    def links(name: str, path: str, item: str) -> DataFrame:
        exploded = items(raw[name], path).select(*SCOPE, d[item].alias("item"), F.explode(d["Associations"]).alias("a"))
        linked = exploded.select(*SCOPE, F.col("a.SubnetId").alias("subnet_id"), "item")
        return linked.where(F.coalesce("subnet_id", F.lit("")) != "")

    endpoints = items(raw["vpc_endpoints"], "VpcEndpoints").select(
        *SCOPE, d["VpcEndpointId"].alias("item"), d["SubnetIds"].alias("members")
    )
    peerings = items(raw["vpc_peerings"], "VpcPeeringConnections").select(
        *SCOPE,
        d["VpcPeeringConnectionId"].alias("item"),
        d["RequesterVpcInfo"]["VpcId"].alias("requester"),
        d["AccepterVpcInfo"]["VpcId"].alias("accepter"),
    )
    interfaces = items(raw["network_interfaces"], "NetworkInterfaces").select(
        *SCOPE, d["SubnetId"].alias("subnet_id"), F.transform(d["Groups"], lambda g: g["GroupId"]).alias("groups")
    )

    df = lookup(base, names, vpc_key, "vpc_name", F.lit(MISSING))
    df = last_association(df, _gateways(raw), vpc_key, "item", "internet_gateways")
    df = last_association(df, vpns, vpc_key, "item", "vpn_connections")
    df = either_side(df, peerings, SCOPE, "vpc_id", ("requester", "accepter"), "item", "_peerings")
    df = last_association(df, links("network_acls", "NetworkAcls", "NetworkAclId"), subnet_key, "item", "acls")
    df = last_association(df, links("route_tables", "RouteTables", "RouteTableId"), subnet_key, "item", "route_tables")
    df = containing(df, endpoints, SCOPE, "subnet_id", "members", "item", "_endpoints")
    df = two_hop(df, interfaces, subnet_key, "groups", "_groups")
    return df.select(
        "subnet_id", "vpc_id", "vpc_name",
        d["CidrBlock"].alias("cidr_block"),
        d["AvailabilityZone"].alias("availability_zone"),
        d["State"].alias("state"),
        F.array_join("_groups", ",").alias("security_groups"),
        "acls", "internet_gateways", "vpn_connections",
        F.array_join("_endpoints", ",").alias("vpc_endpoints"),
        F.array_join("_peerings", ",").alias("vpc_peerings"),
        "route_tables",
        tag_value(d["Tags"], "Name").alias("subnet_name"),
        "region",
        *PROVENANCE,
    )


SUBNETS = ResourceSpec(
    table="subnets",
    service="subnets",
    service_type="SUBNET",
    columns=(
        "subnet_id string, vpc_id string, vpc_name string, cidr_block string, availability_zone string, "
        "state string, security_groups string, acls string, internet_gateways string, vpn_connections string, "
        "vpc_endpoints string, vpc_peerings string, route_tables string, subnet_name string, region string, "
        "account_name string, account_id string"
    ),
    key=("subnet_id", "account_id"),
    resource_id="subnet_id",
    comparators={"security_groups": "comma", "vpc_endpoints": "comma", "vpc_peerings": "comma"},
    compact_names=True,
    # The stored column of the endpoints has a doubled letter; history and field rules know it so.
    history_names={"vpc_endpoints": "vpceendpoints"},
    raw={k: v for k, v in _RAW.items() if k != "security_groups"},
    flatten=flatten_subnets,
)


def flatten_route53(raw: Raw) -> DataFrame:
    d, z = F.col("d"), F.col("z")
    zones = items(raw["zones"], "HostedZones").select(
        *SCOPE, F.replace(d["Id"], F.lit("/hostedzone/"), F.lit("")).alias("_zone"), or_default(d["Name"]).alias("z")
    )
    records = items(raw["records"], "").select(
        "account_id", "account_name", "region",
        F.replace(d["HostedZoneId"], F.lit("/hostedzone/"), F.lit("")).alias("_zone"),
        F.explode(d["ResourceRecordSets"]).alias("d"),
    )
    joined = records.join(zones, [*SCOPE, "_zone"])
    name, kind = or_default(d["Name"]), or_default(d["Type"])
    values = F.transform(d["ResourceRecords"], lambda r: or_default(r["Value"], ""))
    alias = F.when(d["AliasTarget"].isNotNull(), F.array(or_default(d["AliasTarget"]["DNSName"], "")))
    return joined.select(
        F.concat_ws("_", F.col("_zone"), name, kind).alias("record_id"),
        name.alias("domain_name"),
        kind.alias("record_type"),
        join_or(F.when(d["ResourceRecords"].isNotNull(), values).otherwise(alias)).alias("record_value"),
        or_default(d["TTL"].cast("string")).alias("ttl"),
        z.alias("hosted_zone"),
        *PROVENANCE,
    )


ROUTE53 = ResourceSpec(
    table="route53",
    service="route53",
    service_type="ROUTE53",
    columns=(
        "record_id string, domain_name string, record_type string, record_value string, ttl string, "
        "hosted_zone string, account_name string, account_id string"
    ),
    key=("record_id", "account_id"),
    conflict_key=("record_id",),
    resource_id="record_id",
    uncompared=("account_name",),
    fixed_region="us-east-1",
    raw={
        "zones": "HostedZones array<struct<Id: string, Name: string>>",
        "records": (
            "HostedZoneId string, ResourceRecordSets array<struct<Name: string, Type: string, TTL: bigint, "
            "ResourceRecords: array<struct<Value: string>>, AliasTarget: struct<DNSName: string>>>"
        ),
    },
    flatten=flatten_route53,
)


def origin_type(domain: Column) -> Column:
    bucket = F.contains(domain, F.lit(".s3.")) | F.contains(domain, F.lit(".s3-"))
    return F.when(bucket | F.endswith(domain, F.lit(".s3.amazonaws.com")), F.lit("S3")).otherwise(F.lit("Custom"))


def behaviors_text(n: Column) -> Column:
    custom = F.concat(F.lit("Default + "), n.cast("string"), F.lit(" custom behaviors"))
    return F.when(n > 0, custom).otherwise(F.lit("Default only"))


def flatten_cloudfront(raw: Raw) -> DataFrame:
    """The service is global: one region lists it. A distribution without details uses its summary."""
    d, x = F.col("d"), F.col("x")
    listed = raw["distributions"].where(F.col("region") == "us-east-1")
    base = listed.select(
        "account_id", "account_name", "region", F.explode("doc.DistributionList.Items").alias("d")
    ).withColumn("_id", d["Id"])
    details = items(raw["details"], "").select(
        *SCOPE, d["Distribution"]["Id"].alias("_id"), d["Distribution"].alias("_detail"), d["Tags"]["Items"].alias("_tags")
    )
    joined = base.join(details, [*SCOPE, "_id"], "left").withColumn("x", F.coalesce("_detail", "d"))
    cfg = x["DistributionConfig"]

    def origin(o: Column) -> Column:
        domain = or_default(o["DomainName"], "")
        return F.struct(or_default(o["Id"], "").alias("id"), domain.alias("domain"), origin_type(domain).alias("type"))

    origins = F.coalesce(
        F.transform(cfg["Origins"]["Items"], origin),
        F.expr("cast(array() as array<struct<id: string, domain: string, type: string>>)"),
    )
    behavior = cfg["DefaultCacheBehavior"]
    return joined.select(
        F.col("_id").alias("distribution_id"),
        tag_value(F.col("_tags"), "Name").alias("distribution_name"),
        x["DomainName"].alias("domain_name"),
        x["Status"].alias("status"),
        "region",
        F.to_json(origins).alias("origins"),
        F.to_json(
            F.struct(
                or_default(behavior["TargetOriginId"], "").alias("target_origin"),
                or_default(behavior["ViewerProtocolPolicy"], "").alias("viewer_protocol"),
            )
        ).alias("default_cache_behavior"),
        behaviors_text(count_of(cfg["CacheBehaviors"]["Items"])).alias("cache_behaviors"),
        or_default(cfg["Comment"], "").alias("comment"),
        or_default(cfg["PriceClass"], "PriceClass_All").alias("price_class"),
        or_default(cfg["Enabled"], False).alias("enabled"),
        or_default(cfg["WebACLId"]).alias("web_acl"),
        or_default(x["LastModifiedTime"], "").alias("last_modified"),
        *PROVENANCE,
    )


_DISTRIBUTION = (
    "Id: string, DomainName: string, Status: string, LastModifiedTime: string, DistributionConfig: struct<"
    "Origins: struct<Items: array<struct<Id: string, DomainName: string>>>, DefaultCacheBehavior: "
    "struct<TargetOriginId: string, ViewerProtocolPolicy: string>, CacheBehaviors: struct<Items: "
    "array<struct<PathPattern: string>>>, Comment: string, PriceClass: string, Enabled: boolean, WebACLId: string>"
)

CLOUDFRONT = ResourceSpec(
    table="cloudfront",
    service="cloudfront",
    service_type="CLOUDFRONT",
    columns=(
        "distribution_id string, distribution_name string, domain_name string, status string, region string, "
        "origins string, default_cache_behavior string, cache_behaviors string, comment string, price_class string, "
        "enabled boolean, web_acl string, last_modified string, account_name string, account_id string"
    ),
    key=("distribution_id", "account_id", "account_name"),
    resource_id="distribution_id",
    comparators={"origins": "objects", "default_cache_behavior": "object"},
    compact_names=True,
    raw={
        "distributions": f"DistributionList struct<Items: array<struct<{_DISTRIBUTION}>>>",
        "details": f"Distribution struct<{_DISTRIBUTION}>, Tags struct<Items: {TAGS}>",
    },
    flatten=flatten_cloudfront,
)


def flatten_apigateway(raw: Raw) -> DataFrame:
    """REST (v1) and HTTP/WebSocket (v2) APIs in one table."""
    d = F.col("d")
    scope = (
        F.col("region"),
        F.col("account_name"),
        F.col("account_id"),
    )
    rest = items(raw["rest_apis"], "items").select(
        d["id"].alias("api_id"),
        or_default_blank(d["name"]).alias("name"),
        or_default_blank(d["description"]).alias("description"),
        F.lit("REST").alias("protocol"),
        or_default(F.get(d["endpointConfiguration"]["types"], F.lit(0)), "REGIONAL").alias("endpoint_type"),
        micros_text(d["createdDate"]).alias("created_date"),
        *scope,
    )
    http = items(raw["apis"], "Items").select(
        d["ApiId"].alias("api_id"),
        or_default_blank(d["Name"]).alias("name"),
        or_default_blank(d["Description"]).alias("description"),
        or_default_blank(d["ProtocolType"], "HTTP").alias("protocol"),
        or_default_blank(d["ApiEndpoint"], "REGIONAL").alias("endpoint_type"),
        micros_text(d["CreatedDate"]).alias("created_date"),
        *scope,
    )
    return rest.unionByName(http)


APIGATEWAY = ResourceSpec(
    table="apigateway",
    service="apigateway",
    service_type="API-GATEWAY",
    columns=(
        "api_id string, name string, description string, protocol string, endpoint_type string, "
        "created_date string, region string, account_name string, account_id string"
    ),
    key=("api_id", "account_id"),
    resource_id="api_id",
    raw={
        "rest_apis": (
            "items array<struct<id: string, name: string, description: string, endpointConfiguration: "
            "struct<types: array<string>>, createdDate: string>>"
        ),
        "apis": (
            "Items array<struct<ApiId: string, Name: string, Description: string, ProtocolType: string, "
            "ApiEndpoint: string, CreatedDate: string>>"
        ),
    },
    flatten=flatten_apigateway,
)


def endpoint_text(kind: Column, vpc_id: Column, subnets: Column, endpoint_id: Column) -> Column:
    return (
        F.when(
            kind == "VPC",
            F.concat(F.lit("VPC: "), or_default(vpc_id), F.lit(", Subnets: "), count_of(subnets).cast("string")),
        )
        .when(kind == "VPC_ENDPOINT", F.concat(F.lit("VPC Endpoint: "), or_default(endpoint_id)))
        .otherwise(F.lit("Public"))
    )


def flatten_transfer(raw: Raw) -> DataFrame:
    d, s = F.col("d"), F.col("s")
    base = items(raw["servers"], "Servers").withColumn("_id", d["ServerId"])
    details = items(raw["details"], "").select(*SCOPE, d["Server"]["ServerId"].alias("_id"), d["Server"].alias("s"))
    joined = base.join(details, [*SCOPE, "_id"], "left")
    ed = s["EndpointDetails"]
    endpoint = endpoint_text(s["EndpointType"], ed["VpcId"], ed["SubnetIds"], ed["VpcEndpointId"])
    return joined.select(
        F.col("_id").alias("server_id"),
        or_default(s["Domain"], "S3").alias("domain"),
        F.when(s.isNotNull(), endpoint).otherwise(F.lit(MISSING)).alias("endpoint"),
        or_default(s["State"], "UNKNOWN").alias("state"),
        F.col("region"),
        F.col("account_name"),
        F.col("account_id"),
    )


TRANSFER = ResourceSpec(
    table="transfer_family",
    service="transfer",
    service_type="TRANSFER-FAMILY",
    columns=(
        "server_id string, domain string, endpoint string, state string, region string, account_name string, "
        "account_id string"
    ),
    key=("server_id", "account_id"),
    resource_id="server_id",
    raw={
        "servers": "Servers array<struct<ServerId: string>>",
        "details": (
            "Server struct<ServerId: string, Domain: string, State: string, EndpointType: string, EndpointDetails: "
            "struct<VpcId: string, SubnetIds: array<string>, VpcEndpointId: string>>"
        ),
    },
    flatten=flatten_transfer,
)

SPECS = [VPCS, SUBNETS, ROUTE53, CLOUDFRONT, APIGATEWAY, TRANSFER]
