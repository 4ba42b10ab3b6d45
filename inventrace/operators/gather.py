"""Relational enrichment of resources by their neighbours, all as equi joins.

No side is force-broadcast: lookups grow with the inventory, so Spark's runtime size check decides.
A gathered id list is one cell of the output row, so it fits the lists cloud quotas bound (subnets
of a network, groups of an interface); ``collect_set`` builds it from per-task partial sets and
repeated ids never travel. For relations without such a bound use the pair forms, which keep one row
per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_IDS = "cast(array() as array<string>)"


def lookup(df: DataFrame, dim: DataFrame, key: list[str], value: str, default: Column) -> DataFrame:
    """N:1 lookup with a default; a repeated dimension key takes its greatest value."""
    one = dim.groupBy(*key).agg(F.max(value).alias(value))
    return df.join(one, key, "left").withColumn(value, F.coalesce(F.col(value), default))


def gather(df: DataFrame, child: DataFrame, key: list[str], item: str, into: str) -> DataFrame:
    """1:N gather: sorted distinct child ids per key, an empty list where there are none."""
    lists = child.groupBy(*key).agg(F.array_sort(F.collect_set(item)).alias(into))
    return df.join(lists, key, "left").withColumn(into, F.coalesce(F.col(into), F.expr(NO_IDS)))


def gather_all(df: DataFrame, key: list[str], children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Several 1:N gathers over one key with a single grouping and a single join."""
    tagged = None
    for into, (child, item) in children.items():
        part = child.select(*key, F.lit(into).alias("_kind"), F.col(item).cast("string").alias("_item"))
        tagged = part if tagged is None else tagged.unionByName(part)
    lists = tagged.groupBy(*key).agg(
        *[F.array_sort(F.collect_set(F.when(F.col("_kind") == k, F.col("_item")))).alias(k) for k in children]
    )
    joined = df.join(lists, key, "left")
    return joined.withColumns({k: F.coalesce(F.col(k), F.expr(NO_IDS)) for k in children})


def last_association(df: DataFrame, links: DataFrame, key: list[str], item: str, into: str, order: str | None = None) -> DataFrame:
    """key -> id map in which the last link wins; "" where there is none.

    Landed pages carry no order between them, so "last" is by ``order`` (the id itself by default).
    """
    by = F.struct(F.col(order), F.col(item)) if order else F.col(item)
    last = links.where(F.coalesce(F.col(item).cast("string"), F.lit("")) != "").groupBy(*key).agg(
        F.max_by(F.col(item), by).alias(into)
    )
    return df.join(last, key, "left").withColumn(into, F.coalesce(F.col(into), F.lit("")))


def member_pairs(holders: DataFrame, scope: list[str], key: str, members: str, item: str) -> DataFrame:
    """(key, item) pairs of holders whose member array contains the key; one row per pair, no lists."""
    return holders.select(*scope, F.explode(members).alias(key), item).distinct()


def end_pairs(edges: DataFrame, scope: list[str], key: str, sides: tuple[str, str], item: str) -> DataFrame:
    """(key, item) pairs of edges that touch the key on either end, instead of an OR join."""
    return edges.select(*scope, F.explode(F.array_distinct(F.array(*sides))).alias(key), item).distinct()


def containing(df: DataFrame, holders: DataFrame, scope: list[str], key: str, members: str, item: str, into: str) -> DataFrame:
    """Ids of the holders whose member array contains the key."""
    return gather(df, member_pairs(holders, scope, key, members, item), [*scope, key], item, into)


def either_side(df: DataFrame, edges: DataFrame, scope: list[str], key: str, sides: tuple[str, str], item: str, into: str) -> DataFrame:
    """Ids of the edges that touch the key on either end."""
    return gather(df, end_pairs(edges, scope, key, sides, item), [*scope, key], item, into)


def two_hop(df: DataFrame, middle: DataFrame, key: list[str], members: str, into: str) -> DataFrame:
    """Distinct members of the middle rows that belong to the key."""
    return gather(df, middle.select(*key, F.explode(members).alias("_member")), key, "_member", into)
