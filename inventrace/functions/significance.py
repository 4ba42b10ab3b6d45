"""Which cell changes are worth a history row.

Every rule says "these two texts mean the same" and any one of them makes the change
insignificant, so the rules are independent of each other. Cheap rules come first: ``|`` stops at
the first true operand, and JSON is parsed only for texts that start like JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inventrace.functions.dates import micros_between, parse_naive
from inventrace.functions.jsontext import canonical_json, json_list, json_map, list_items
from inventrace.functions.text import strip

# Field names, tag keys and keywords the significance rules are defined over.
IGNORED_FIELDS = [
    "last_updated", "created_at", "modified_at", "updated_at",
    "map-migrated", "migration-id", "aws-migration-project-id",
    "requestid", "eventid", "principalid", "sessioncontext",
    "creation_date", "account", "accountname", "accountid",
    "region", "record_value", "domain", "created_date", "last_execution_started",
]
AUTOMATIC_TAGS = [
    "aws:cloudformation:logical-id",
    "aws:cloudformation:stack-id",
    "aws:cloudformation:stack-name",
]
LIST_FIELDS = [
    "subnets", "security_groups", "network_acls", "internet_gateways",
    "vpc_endpoints", "vpc_peerings", "route_rules", "availability_zones",
    "securitygroups", "storagevolumes", "vpceendpoints", "routetables", "tags",
]
NUMERIC_FIELDS = ["execution_duration", "compliance_percentage"]
DATE_KEYWORDS = [
    "time", "date", "created", "modified", "updated", "started", "ended", "finished",
    "completed", "executed", "run", "launch", "domain", "build",
]


def blank_or_same(old: Column, new: Column) -> Column:
    return strip(F.coalesce(old, F.lit(""))) == strip(F.coalesce(new, F.lit("")))


def both_empty(old: Column, new: Column) -> Column:
    """``[]``, ``{}`` and "" stand for each other."""
    spellings = ["[]", "{}", ""]
    return strip(F.coalesce(old, F.lit(""))).isin(spellings) & strip(F.coalesce(new, F.lit(""))).isin(spellings)


def same_boolean(old: Column, new: Column) -> Column:
    o, n = F.lower(strip(old)), F.lower(strip(new))
    return F.coalesce(o.isin("true", "false") & (o == n), F.lit(False))


def ignored_field(field: Column) -> Column:
    return F.lower(field).isin(IGNORED_FIELDS)


def _both_start(old: Column, new: Column, mark: str) -> Column:
    return F.startswith(strip(old), F.lit(mark)) & F.startswith(strip(new), F.lit(mark))


def drop_automatic_tags(tags: Column) -> Column:
    return F.map_filter(tags, lambda k, _: ~k.isin(AUTOMATIC_TAGS))


def _map_items(tags: Column) -> Column:
    return F.array_sort(F.map_entries(drop_automatic_tags(tags)))


def same_user_tags(field: Column, old: Column, new: Column) -> Column:
    """Tag objects equal once the tags set by stack deployment are removed."""
    applies = (F.lower(field) == "tags") & _both_start(old, new, "{")
    return F.coalesce(applies & (_map_items(json_map(old)) == _map_items(json_map(new))), F.lit(False))


def same_json_object(old: Column, new: Column) -> Column:
    return F.coalesce(_both_start(old, new, "{") & (canonical_json(old) == canonical_json(new)), F.lit(False))


def same_json_set(old: Column, new: Column) -> Column:
    """JSON arrays equal as sets."""

    def as_set(col: Column) -> Column:
        return F.array_sort(F.array_distinct(F.transform(json_list(col), lambda x: F.coalesce(x, F.lit("None")))))

    return F.coalesce(_both_start(old, new, "[") & (as_set(old) == as_set(new)), F.lit(False))


def same_field_list(field: Column, old: Column, new: Column) -> Column:
    """List-valued fields equal as multisets, whatever their spelling."""
    applies = F.lower(field).isin(LIST_FIELDS)
    return F.coalesce(applies & (list_items(old) == list_items(new)), F.lit(False))


def same_number(field: Column, old: Column, new: Column) -> Column:
    applies = F.lower(field).isin(NUMERIC_FIELDS)
    return F.coalesce(applies & (strip(old).try_cast("double") == strip(new).try_cast("double")), F.lit(False))


def same_second(field: Column, old: Column, new: Column) -> Column:
    """Date fields (by keyword in the name) less than a second apart, offsets dropped."""
    applies = F.regexp_like(F.lower(field), F.lit("|".join(DATE_KEYWORDS)))
    gap = F.abs(micros_between(parse_naive(old), parse_naive(new)))
    return F.coalesce(applies & (gap < 1_000_000), F.lit(False))


def is_significant(field: Column, old: Column, new: Column) -> Column:
    """Field name and the old and new text of a cell (null = no value) -> non-null boolean."""
    return ~(
        blank_or_same(old, new)
        | both_empty(old, new)
        | ignored_field(field)
        | same_boolean(old, new)
        | same_number(field, old, new)
        | same_second(field, old, new)
        | same_json_object(old, new)
        | same_user_tags(field, old, new)
        | same_json_set(old, new)
        | same_field_list(field, old, new)
    )
