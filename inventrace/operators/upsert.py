"""Snapshot against stored state: column-level diff, merged state, history rows, counters.

One full outer join on the match key carries everything. Both sides shuffle once, on the key; the
comparison, the change list and the merged row are projections of the joined row, so state, history
and counters cannot disagree.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inventrace.functions.canon import py_text
from inventrace.functions.compare import COMPARATORS
from inventrace.functions.significance import is_significant
from inventrace.functions.text import last_segment
from inventrace.specs.audit_values import SYSTEM_FUNCTIONS
from inventrace.specs.model import ResourceSpec

#: Columns of the compared frame next to the state columns.
CONTROL = ["_action", "_copies", "_changes"]


def last_per_key(df: DataFrame, key: list[str], order: list[str], copies: str | None = None) -> DataFrame:
    """One row per key: the greatest by ``order``, remaining columns as tie-break.

    The row travels once, as the struct that is compared, and is combined before the shuffle, so a key with many copies is
    reduced where it is read. Maps are compared as their entries.
    """
    types = dict(df.dtypes)
    rest = [c for c in df.columns if c not in key]
    maps = [c for c in rest if types[c].startswith("map")]
    ranked = [*order, *[c for c in rest if c not in order and c not in maps], *maps]
    fields = [F.map_entries(c).alias(c) if c in maps else F.col(c) for c in ranked]
    aggs = [F.max(F.struct(*fields)).alias("_row")] if fields else []
    if copies:
        aggs.append(F.count(F.lit(1)).alias(copies))
    picked = df.groupBy(*key).agg(*aggs) if aggs else df.select(*key).distinct()
    whole = [F.map_from_entries(F.col(f"_row.{c}")).alias(c) if c in maps else F.col(f"_row.{c}").alias(c) for c in rest]
    return picked.select(*key, *whole, *([copies] if copies else []))


def compare(
    spec: ResourceSpec, snapshot: DataFrame, state: DataFrame, run_ts: Column, state_is_unique: bool = True, added: Collection[str] = ()
) -> DataFrame:
    """Full outer comparison. Output: the new state row, ``last_updated`` and the control columns.

    ``_action`` is ``insert``, ``update`` (a compared column differs), ``touch`` (matched and equal)
    or ``carry`` (stored only; there are no deletes). ``_copies`` counts the snapshot rows behind the
    row and ``_changes`` lists differing cells as (field_name, old_value, new_value) texts. Columns that are ``added`` since the state
    was written have no old value: they are filled in and never count as a change.
    """
    key = list(spec.key)
    names = spec.column_names
    snap = last_per_key(snapshot.select(*names), key, [c for c in ("account_id", "region") if c in names], "_copies")
    old_state = state.select(*names, "last_updated")
    if not state_is_unique:
        old_state = last_per_key(old_state, key, ["last_updated"])

    new = snap.select(*[F.col(c).alias(f"n_{c}") for c in names], F.col("_copies"))
    old = old_state.select(*[F.col(c).alias(f"o_{c}") for c in [*names, "last_updated"]])
    on = [F.col(f"n_{k}") == F.col(f"o_{k}") for k in key]
    joined = new.join(old, on, "full_outer")

    has_new = F.col("_copies").isNotNull()
    has_old = F.col(f"o_{key[0]}").isNotNull()
    matched = has_new & has_old
    new_types = {f.name: f.dataType for f in snapshot.schema.fields}
    old_types = {f.name: f.dataType for f in state.schema.fields}

    def differs(c: str) -> Column:
        if c in added:
            return F.lit(False)
        same = COMPARATORS[spec.comparators.get(c, "text")]
        return matched & ~same(F.col(f"o_{c}"), F.col(f"n_{c}"), old_types[c], new_types[c])

    flagged = joined.withColumns({f"d_{c}": differs(c) for c in spec.compared})
    any_change = F.lit(False)
    for c in spec.compared:
        any_change = any_change | F.col(f"d_{c}")
    action = (
        F.when(~has_old, F.lit("insert"))
        .when(~has_new, F.lit("carry"))
        .when(any_change, F.lit("update"))
        .otherwise(F.lit("touch"))
    )

    def merged(c: str) -> Column:
        take_new = has_new if c in added else ~has_old | F.col(f"d_{c}") if c in spec.compared else ~has_old
        return F.when(take_new, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c)

    cells = [
        F.when(
            F.col(f"d_{c}"),
            F.struct(
                F.lit(spec.history_field(c)).alias("field_name"),
                py_text(F.col(f"o_{c}"), old_types[c]).alias("old_value"),
                py_text(F.col(f"n_{c}"), new_types[c]).alias("new_value"),
            ),
        )
        for c in spec.compared
    ]
    changes = F.array_compact(F.array(*cells)) if cells else F.expr(
        "cast(array() as array<struct<field_name:string,old_value:string,new_value:string>>)"
    )
    out = flagged.select(
        *[merged(c) for c in names],
        F.when(has_new, run_ts).otherwise(F.col("o_last_updated")).alias("last_updated"),
        action.alias("_action"),
        F.coalesce(F.col("_copies"), F.lit(0)).alias("_copies"),
        changes.alias("_changes"),
    )
    return ignore_conflicts(out, list(spec.conflict_key)) if spec.conflict_key else out


def ignore_conflicts(compared: DataFrame, conflict: list[str]) -> DataFrame:
    """Drop inserts whose conflict key is stored already, or is inserted by an earlier account.

    The kept row takes over the snapshot counts of the ignored ones, so ``processed`` stays complete.
    """
    is_insert = F.col("_action") == "insert"
    order = Window.partitionBy(*conflict).orderBy(is_insert, "account_id")
    ranked = compared.withColumns({"_first": F.row_number().over(order) == 1, "_insert": is_insert})
    ignored = F.col("_insert") & ~F.col("_first")
    extra = F.sum(F.when(ignored, F.col("_copies")).otherwise(F.lit(0))).over(Window.partitionBy(*conflict))
    counted = F.col("_copies") + F.when(F.col("_first"), extra).otherwise(F.lit(0))
    kept = ranked.withColumns({"_copies": counted, "_ignored": ignored}).where(~F.col("_ignored"))
    return kept.select(*compared.columns)


def new_state(spec: ResourceSpec, compared: DataFrame) -> DataFrame:
    return compared.select(*spec.column_names, "last_updated")


def changed_cells(spec: ResourceSpec, compared: DataFrame) -> DataFrame:
    """Wide to long: one row per differing cell, null values still null."""
    region = F.lit(spec.fixed_region) if spec.fixed_region else F.col("region")
    exploded = compared.where(F.size("_changes") > 0).select(
        F.lit(spec.service_type).alias("service_type"),
        F.col(spec.resource_id).cast("string").alias("resource_id"),
        F.col("account_id"),
        region.alias("region"),
        F.explode("_changes").alias("c"),
    )
    return exploded.select("service_type", "resource_id", "c.*", "account_id", "region")


def significant(cells: DataFrame) -> DataFrame:
    """Drop cells whose texts mean the same and cells of vendor-installed functions."""
    vendor = (F.upper("service_type") == "LAMBDA") & last_segment(F.col("resource_id"), ":").isin(SYSTEM_FUNCTIONS)
    return cells.where(~vendor & is_significant(F.col("field_name"), F.col("old_value"), F.col("new_value")))


def history_rows(attributed: DataFrame) -> DataFrame:
    """Final history layout; a missing value is written as the text ``None``."""
    return attributed.select(
        "service_type",
        "resource_id",
        "field_name",
        F.coalesce("old_value", F.lit("None")).alias("old_value"),
        F.coalesce("new_value", F.lit("None")).alias("new_value"),
        "changed_by",
        "account_id",
        "region",
    )


def counters(spec: ResourceSpec, compared: DataFrame) -> DataFrame:
    """processed / inserted / updated (a compared cell differs) / matched (stored row existed)."""
    act = F.col("_action")
    return compared.groupBy(F.lit(spec.service).alias("service")).agg(
        F.sum("_copies").alias("processed"),
        F.count_if(act == "insert").alias("inserted"),
        F.count_if(act == "update").alias("updated"),
        F.count_if(act.isin("update", "touch")).alias("matched"),
    )


def unseen(incoming: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Insert-or-ignore: one incoming row per key that the target does not hold.

    ``key`` is the conflict target alone, so rows that differ elsewhere (another account) are skipped.
    """
    order = [c for c in ("account_id", "region") if c in incoming.columns and c not in key]
    rest = [c for c in incoming.columns if c not in key]
    first = incoming.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("_row"))
    return first.select(*key, "_row.*").join(target.select(*key), key, "left_anti").select(*incoming.columns)


def any_changed(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any (old, new) text pair differs, as one existence test."""
    none = F.lit("None")
    return F.exists(
        F.array(*[F.coalesce(o.cast("string"), none) != F.coalesce(n.cast("string"), none) for o, n in pairs]),
        lambda x: x,
    )
