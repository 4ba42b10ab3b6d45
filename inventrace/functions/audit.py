"""Column expressions over one parsed audit event.

``detail`` is the event parsed once with :data:`DETAIL`; the request and response stay JSON text so
that their key order survives, and are read once more as VARIANT for the many single-field lookups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from inventrace.functions.dates import parse_naive
from inventrace.functions.jsontext import json_to_literal
from inventrace.functions.text import first_non_blank, last_chars, last_segment
from inventrace.specs.audit_values import (
    NAMED_RESOURCE_SOURCES,
    NOT_RESOURCE_KEYS,
    REQUEST_FIELDS,
    RESOURCE_ID_PREFIXES,
    RESOURCE_TYPES,
    RESPONSE_FIELDS,
)

DETAIL = (
    "eventID string, eventTime string, eventName string, eventSource string, awsRegion string, "
    "userIdentity struct<userName: string, arn: string, principalId: string, type: string>, "
    "requestParameters string, responseElements string, _corrupt string"
)
UNKNOWN = "unknown"


def parse_detail(text: Column) -> Column:
    """Event JSON -> struct; ``_corrupt`` is set for malformed or non-object text."""
    return F.from_json(text, DETAIL, {"columnNameOfCorruptRecord": "_corrupt"})


def object_text(text: Column) -> Column:
    """The text when it is a JSON object, else null."""
    return F.when(F.startswith(F.ltrim(text), F.lit("{")), text)


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "string")


def resource_name(source: Column, req_text: Column, req: Column, resp_text: Column, resp: Column) -> Column:
    """Resource id or name by priority: item sets, request fields of the source, response fields, any
    id-like text key in document order; else ``unknown``."""
    sets = []
    for name, item in (("resourcesSet", "resourceId"), ("instancesSet", "instanceId")):
        first = F.try_variant_get(req, f"$.{name}.items[0]", "variant")
        sets.append(F.when(first.isNotNull(), F.coalesce(field(first, item), F.lit(UNKNOWN))))
    by_source = F.lit(None).cast("string")
    for src, names in REQUEST_FIELDS.items():
        by_source = F.when(source == src, first_non_blank(*[field(req, n) for n in names])).otherwise(by_source)
    in_response = first_non_blank(*[field(resp, n) for n in RESPONSE_FIELDS])
    return F.coalesce(*sets, by_source, in_response, any_id_key(req_text, req, resp_text, resp), F.lit(UNKNOWN))


def any_id_key(req_text: Column, req: Column, resp_text: Column, resp: Column) -> Column:
    """First non-empty text value whose key looks like an id, request keys before response keys.

    A key present in both takes the response's value but keeps the request's place.
    """
    no_keys = F.expr("cast(array() as array<string>)")
    resp_keys = F.coalesce(F.json_object_keys(resp_text), no_keys)
    keys = F.array_distinct(F.concat(F.coalesce(F.json_object_keys(req_text), no_keys), resp_keys))

    def id_like(key: Column) -> Column:
        low = F.lower(key)
        ends = F.endswith(low, F.lit("id")) | F.endswith(low, F.lit("name")) | F.contains(low, F.lit("identifier"))
        return ends & ~key.isin(NOT_RESOURCE_KEYS)

    wanted = F.filter(keys, id_like)
    req_map = F.from_json(req_text, "map<string,variant>")
    resp_map = F.from_json(resp_text, "map<string,variant>")

    def text_value(key: Column) -> Column:
        value = F.when(F.array_contains(resp_keys, key), F.try_element_at(resp_map, key)).otherwise(
            F.try_element_at(req_map, key)
        )
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))

    values = F.transform(wanted, text_value)
    return F.get(F.filter(values, lambda x: x.isNotNull() & (x != "")), F.lit(0))


def user_name(identity: Column) -> Column:
    """userName, else last part of the arn, else of the principal id, else the type."""
    name = F.coalesce(
        first_non_blank(
            identity["userName"], last_segment(identity["arn"], "/"), last_segment(identity["principalId"], ":")
        ),
        identity["type"],
        F.lit(UNKNOWN),
    )
    short = last_chars(name, 50)
    return F.when(short.isin("", UNKNOWN), F.lit("system")).otherwise(short)


def resource_type(source: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in RESOURCE_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, source), F.lit("UNKNOWN"))


def valid_resource(name: Column, source: Column) -> Column:
    prefixed = reduce(lambda a, b: a | b, [F.startswith(name, F.lit(p)) for p in RESOURCE_ID_PREFIXES])
    named = name.isNotNull() & ~name.isin("", UNKNOWN)
    return F.coalesce(named & (prefixed | source.isin(NAMED_RESOURCE_SOURCES)), F.lit(False))


def event_time(text: Column) -> Column:
    return parse_naive(text)


def _pairs(items: Column) -> Column:
    """``[{key, value}]`` JSON text -> "k=v, k=v"; null when there is none."""
    rows = F.from_json(items, "array<struct<key: string, value: string>>")
    empty = F.lit("")
    texts = F.transform(rows, lambda t: F.concat(F.coalesce(t["key"], empty), F.lit("="), F.coalesce(t["value"], empty)))
    return F.nullif(F.array_join(texts, ", "), empty)


def _assigned(req: Column, names: list[str]) -> Column:
    """"name=value" of the request keys that are present; null when none is."""

    def one(name: str) -> Column:
        v = F.try_variant_get(req, f"$.{name}", "variant")
        text = F.try_variant_get(v, "$", "string")
        kind = F.schema_of_variant(v)
        shown = (
            F.when(kind == "STRING", text)
            .when(kind == "BOOLEAN", F.initcap(text))
            .when(kind == "VOID", F.lit("None"))
            .when(F.startswith(kind, F.lit("OBJECT")), json_to_literal(text))
            .otherwise(text)
        )
        return F.when(v.isNotNull(), F.concat(F.lit(f"{name}="), shown))

    return F.nullif(F.concat_ws(", ", *[one(n) for n in names]), F.lit(""))


def change_summary(event_name: Column, req_text: Column, req: Column) -> Column:
    """JSON summary of what an event did: by event group, then special cases, then its lower-case name.

    Empty values are left out. A request that is missing or no object counts as empty.
    """
    action = F.lower(event_name)

    def val(name: str) -> Column:
        return F.nullif(field(req, name), F.lit(""))

    def js(**parts: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()]))

    def sub(path: str) -> Column:
        return F.get_json_object(req_text, f"$.{path}")

    instance_ids = F.from_json(sub("instancesSet.items"), "array<struct<instanceId: string>>")
    instances = F.nullif(F.array_join(F.transform(instance_ids, lambda i: i["instanceId"]), ", "), F.lit(""))
    tags = _pairs(sub("tagSet.items"))
    bucket_tags = _pairs(sub("tagging.tagSet"))
    versioning = sub("versioningConfiguration")
    images = F.from_json(sub("imageIds"), "array<string>")
    update_keys = F.json_object_keys(sub("update"))
    public_ip = F.try_variant_get(req, "$.mapPublicIpOnLaunch", "variant")
    attributes = _assigned(req, ["instanceType", "userData", "disableApiTermination"])
    dns = _assigned(req, ["enableDnsHostnames", "enableDnsSupport"])

    def named(*names: str) -> Column:
        return event_name.isin(*names)

    summary = (
        F.when(named("CreateTags", "DeleteTags") & tags.isNotNull(), js(tags=tags))
        .when(
            named("StartInstances", "StopInstances", "RebootInstances", "TerminateInstances"),
            js(instances=instances, action=F.replace(action, F.lit("instances"), F.lit(""))),
        )
        .when(
            named("AttachVolume", "DetachVolume"), js(action=action, volume=val("volumeId"), instance=val("instanceId"))
        )
        .when(
            named("AttachInternetGateway", "DetachInternetGateway"),
            js(action=action, gateway=val("internetGatewayId"), vpc=val("vpcId")),
        )
        .when(named("CreateSubnet", "DeleteSubnet"), js(action=action, cidr=val("cidrBlock"), vpc=val("vpcId")))
        .when(named("CreateVpc", "DeleteVpc"), js(action=action, cidr=val("cidrBlock")))
        .when(named("CreateRouteTable", "DeleteRouteTable"), js(action=action, vpc=val("vpcId")))
        .when(
            named("CreateRoute", "DeleteRoute"),
            js(action=action, destination=val("destinationCidrBlock"), gateway=val("gatewayId")),
        )
        .when(
            named("RebootDBInstance", "StartDBInstance", "StopDBInstance"),
            js(action=F.replace(action, F.lit("dbinstance"), F.lit("")), instance=val("dBInstanceIdentifier")),
        )
        .when(named("CreateBucket", "DeleteBucket"), js(action=action, bucket=val("bucketName")))
        .when(named("CreateAlias", "DeleteAlias"), js(action=action, alias=val("aliasName"), key=val("targetKeyId")))
        .when(named("ModifyInstanceAttribute") & attributes.isNotNull(), js(attributes=attributes))
        .when(
            named("ModifySubnetAttribute") & public_ip.isNotNull(),
            js(public_ip=F.substr(_assigned(req, ["mapPublicIpOnLaunch"]), F.lit(len("mapPublicIpOnLaunch=") + 1))),
        )
        .when(named("ModifyVpcAttribute") & dns.isNotNull(), js(attributes=dns))
        .when(named("PutBucketTagging") & bucket_tags.isNotNull(), js(tags=bucket_tags))
        .when(
            named("PutBucketEncryption"), js(action=F.lit("enable_encryption"), encryption=F.lit("enabled"))
        )
        .when(
            named("PutBucketVersioning") & ~F.coalesce(versioning, F.lit("{}")).isin("{}", "", "null"),
            js(versioning=F.coalesce(F.lower(F.get_json_object(versioning, "$.status")), F.lit(""))),
        )
        .when(named("BatchDeleteImage") & (F.size(images) > 0), js(deleted_images=F.size(images).cast("string")))
        .when(
            named("UpdateClusterConfig") & (F.size(update_keys) > 0),
            js(action=F.lit("update_config"), fields=F.array_join(update_keys, ", ")),
        )
    )
    return F.coalesce(summary, js(action=action))
