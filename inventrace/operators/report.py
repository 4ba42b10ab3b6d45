"""Run reports: counters per service, status lines, coverage grid, unreachable accounts, funnel."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of the status line.
INSERTED_WORD, UPDATED_WORD, NOTHING = "nuevos", "actualizados", "0 cambios"


def status_text(inserted: Column, updated: Column) -> Column:
    new = F.when(inserted > 0, F.concat(inserted.cast("string"), F.lit(f" {INSERTED_WORD}")))
    upd = F.when(updated > 0, F.concat(updated.cast("string"), F.lit(f" {UPDATED_WORD}")))
    return F.coalesce(F.nullif(F.concat_ws(", ", new, upd), F.lit("")), F.lit(NOTHING))


def run_summary(metrics: DataFrame) -> DataFrame:
    """Counters summed per service, with the status line. Other counters (rejected, total ...) are summed as well."""
    counts = [c for c in metrics.columns if c != "service"]
    total = metrics.groupBy("service").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    status = status_text(F.col("inserted"), F.col("updated"))
    return total.withColumns(
        {"status": status, "message": F.concat(F.upper("service"), F.lit(": "), status)}
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def work_grid(accounts: DataFrame, regions: DataFrame) -> DataFrame:
    """Every account in every region. The configured regions (a few dozen) travel as one list."""
    listed = regions.select(F.array_sort(F.collect_set("region"))).scalar()
    return accounts.withColumn("region", F.explode(listed))


def coverage(grid: DataFrame, results: DataFrame) -> DataFrame:
    """Work grid with the rows collected for each pair; pairs without results show 0."""
    counted = results.groupBy("account_id", "region").agg(F.count(F.lit(1)).alias("rows"))
    return grid.join(counted, ["account_id", "region"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def errors_by_account(errors: DataFrame) -> DataFrame:
    """Errors per account as a sorted list of ``region: error``. One row per grid pair at most."""
    line = F.concat(F.col("region"), F.lit(": "), F.col("error"))
    return errors.groupBy("account_id").agg(F.array_sort(F.collect_list(line)).alias("errors"))


def unreachable(errors: DataFrame) -> DataFrame:
    return errors.agg(F.count_distinct("account_id").alias("unreachable_accounts"))


def ingest_funnel(marked: DataFrame, group: list[str]) -> DataFrame:
    """Totals per poll scope from a frame with boolean ``important`` and ``inserted`` columns."""
    return marked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("important")).alias("important"),
        F.count_if(F.col("inserted")).alias("inserted"),
    )
