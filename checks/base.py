"""Registered queries: each pairs a Spark query over the given tables with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


Query = Callable[[SparkSession, str], DataFrame]

#: One run time for all queries, inside the month the events cover.
RUN_TIME = "2024-01-15 12:00:00"

#: Read schemas, so that no query spends a job on reading file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = list(SCHEMAS)


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its checking SQL."""

    def add(fn: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"duplicate query {name}")
        CHECKS[name] = Check(fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; ``spread`` deals its rows to all shuffle partitions for expensive row-wise work (a given file is one split)."""
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if spread else df


def run_ts() -> Column:
    return F.lit(RUN_TIME).cast("timestamp_ntz")


def text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def joined(col: Column | str, sep: str = ",") -> Column:
    """Sorted array as text, for output."""
    return F.array_join(F.array_sort(col), sep)
