"""Aggregations the flatten specs and reports need. All combine before their shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inventrace.functions.text import first_items, first_segment


def compliance(items: DataFrame, key: list[str], status: str = "Status") -> DataFrame:
    """Compliant and other counts per key, share in percent, and the 30/40/rest ageing split."""
    ok = F.col(status).eqNullSafe(F.lit("COMPLIANT"))
    counted = items.groupBy(*key).agg(
        F.count_if(ok).alias("compliant_resources"), F.count_if(~ok).alias("non_compliant_resources")
    )
    return counted.withColumns(ageing(F.col("compliant_resources"), F.col("non_compliant_resources")))


def ageing(good: Column, bad: Column) -> dict[str, Column]:
    total = good + bad
    recent = F.floor(bad * F.lit(0.3)).cast("long")
    middle = F.floor(bad * F.lit(0.4)).cast("long")
    share = F.when(total > 0, F.bround(good.cast("double") / total * F.lit(100.0), 2)).otherwise(F.lit(0.0))
    return {
        "compliance_percentage": share,
        "non_compliant_15_days": recent,
        "non_compliant_15_90_days": middle,
        "non_compliant_90_days": bad - recent - middle,
    }


def latest_total(points: DataFrame, key: list[str], kind: str, ts: str, value: str, since: Column, into: str) -> DataFrame:
    """Latest datapoint of each kind since ``since`` (whole bytes), summed per key."""
    rank = F.struct(F.col(ts), F.col(value))
    latest = points.where(F.col(ts) >= since).groupBy(*key, kind).agg(F.max(rank)[value].alias("_v"))
    return latest.groupBy(*key).agg(F.sum(F.floor("_v").cast("long")).alias(into))


def distinct_prefixes(names: Column, first: int | None = None, sep: str = "-") -> Column:
    """Distinct prefixes before ``sep`` among all names, or the ``first`` ones (blank names skipped), at least 1."""
    taken = F.filter(first_items(names, first), lambda x: x.isNotNull() & (x != ""))
    prefixes = F.array_distinct(F.transform(taken, lambda x: first_segment(x, sep)))
    return F.greatest(F.lit(1), F.coalesce(F.size(prefixes), F.lit(0))).cast("long")


def newest(df: DataFrame, group: list[str], by: list[Column], n: int) -> DataFrame:
    """The n newest rows per group. Spark keeps only n rows per group and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*by))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
