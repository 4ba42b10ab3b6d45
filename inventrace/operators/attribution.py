"""Who made the change: audit events nearest in time, field-related events, or the latest event.

No operator here forms all (change, event) pairs of a resource. With one anchor for the whole run
(the default) the nearest event is an aggregate of the events alone. With an anchor per change, the
probes and events of a resource are cut into short time slices: each slice is scanned in time order
once, and slices only exchange their first and last event. A resource that owns a large part of the
log is therefore spread over its slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inventrace.functions.dates import epoch_micros
from inventrace.session import fixed_rows
from inventrace.specs.audit_values import field_events

WINDOW_SECONDS = 86_400
#: Repeated moments collapse and time is in microseconds, so that a slice never holds more than ten million rows, and a resource has 8640 a day.
SLICE_SECONDS = 10
UNKNOWN = "unknown"


def field_map(spark: SparkSession, extra: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(service_type, field_name, event_name): which events can explain a field. Fixed size."""
    rows = field_events() + list(extra or [])
    return fixed_rows(spark, rows, "service_type, field_name, event_name")


def _event_columns(events: DataFrame) -> DataFrame:
    """The few columns attribution reads, with the type in upper case."""
    return events.select(
        F.upper("resource_type").alias("resource_type"),
        "resource_name",
        "event_name",
        "event_time",
        F.col("event_id").cast("string").alias("event_id"),
        "user_name",
    )


def _nearest_to_literal(events: DataFrame, key: list[str], anchor: Column, window_s: int) -> DataFrame:
    """Per key, the event nearest to one fixed time; ``_rank`` orders candidates across keys."""
    gap = F.abs(epoch_micros(F.col("event_time")) - epoch_micros(anchor))
    span = F.expr(f"INTERVAL {window_s} SECONDS")
    inside = events.where((F.col("event_time") > anchor - span) & (F.col("event_time") < anchor + span))
    rank = F.struct(gap.alias("gap"), F.col("event_time"), F.col("event_id"))
    return inside.groupBy(*key).agg(
        F.min(F.struct(rank.alias("rank"), F.col("user_name"))).alias("_best")
    )


def nearest_event(
    probes: DataFrame,
    events: DataFrame,
    key: list[str],
    anchor: str,
    window_s: int = WINDOW_SECONDS,
    slice_s: int = SLICE_SECONDS,
) -> DataFrame:
    """Two-sided as-of join: for each distinct (key, anchor) the nearest event strictly inside the window.

    ``events`` needs the key, ``event_time``, ``event_id`` and ``user_name``. Returns key, anchor and
    ``_best`` (rank{gap, at, event_id}, user_name) for the probes that have one. Equal gaps go
    to the earlier event, then to the smaller id.
    """
    span = slice_s * 1_000_000
    none = "cast(null as struct<at: bigint, event_id: string, user_name: string>)"
    at = epoch_micros(F.col("event_time"))
    moments = events.select(
        *key,
        at.alias("_t"),
        F.struct(at.alias("at"), F.col("event_id").cast("string").alias("event_id"), "user_name").alias("_ev"),
        F.lit(None).cast("timestamp_ntz").alias(anchor),
    ).unionByName(
        probes.where(F.col(anchor).isNotNull()).select(
            *key, epoch_micros(F.col(anchor)).alias("_t"), F.expr(none).alias("_ev"), anchor
        )
    )
    # One row per key and moment: repeated events and repeated probes collapse before they are shuffled.
    rows = (
        moments.withColumn("_slice", F.call_function("div", F.col("_t"), F.lit(span)))
        .groupBy(*key, "_slice", "_t")
        .agg(F.min("_ev").alias("_ev"), F.max(anchor).alias(anchor))
    )

    # Within a slice: the events before and after. LAG/LEAD IGNORE NULLS stay linear.
    keys = ", ".join(f"`{k}`" for k in key)
    inside = f"PARTITION BY {keys}, _slice ORDER BY _t"
    here = rows.select(
        "*",
        F.expr(f"lag(_ev) IGNORE NULLS OVER ({inside})").alias("_prev"),
        F.expr(f"lead(_ev) IGNORE NULLS OVER ({inside})").alias("_next"),
    ).where(F.col(anchor).isNotNull())

    # Across slices: only their first and last events travel.
    slices = rows.groupBy(*key, "_slice").agg(
        F.min("_ev").alias("_first"), F.max("_ev").alias("_last"), F.count(anchor).alias("_probes")
    )
    across = f"PARTITION BY {keys} ORDER BY _slice"
    borders = slices.select(
        *key,
        "_slice",
        "_probes",
        F.expr(f"lag(_last) IGNORE NULLS OVER ({across})").alias("_before"),
        F.expr(f"lead(_first) IGNORE NULLS OVER ({across})").alias("_after"),
    ).where((F.col("_probes") > 0) & (F.col("_before").isNotNull() | F.col("_after").isNotNull()))

    both = here.join(borders.drop("_probes"), [*key, "_slice"], "left")
    limit = F.lit(window_s * 1_000_000)

    def ranked(ev: Column) -> Column:
        gap = F.abs(ev["at"] - F.col("_t"))
        rank = F.struct(gap.alias("gap"), ev["at"].alias("at"), ev["event_id"].alias("event_id"))
        return F.when(gap < limit, F.struct(rank.alias("rank"), ev["user_name"].alias("user_name")))

    best = F.least(
        ranked(F.col("_ev")),
        ranked(F.coalesce(F.col("_prev"), F.col("_before"))),
        ranked(F.coalesce(F.col("_next"), F.col("_after"))),
    )
    return both.select(*key, anchor, best.alias("_best")).where(F.col("_best").isNotNull())


def attribute(
    cells: DataFrame,
    events: DataFrame,
    mapping: DataFrame,
    anchor: Column | str,
    window_s: int = WINDOW_SECONDS,
    latest_first: bool = False,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Add ``changed_by`` to changed cells.

    Order of evidence: with ``latest_first`` the latest event of the field; then the nearest event of
    the same resource type and name; then the nearest event of that name whose event name can explain
    the field; then ``unknown``. ``latest`` holds the latest events by type, name and event name (see :mod:`inventrace.sources.latest`);
    without it they are looked for in ``events``. ``anchor`` is one timestamp for all cells, or the name of a
    TIMESTAMP_NTZ column of ``cells``.
    """
    ev = _event_columns(events)
    cells = cells.withColumns(
        {
            "_type": F.upper("service_type"),
            "_field": F.lower("field_name"),
        }
    )
    dims = F.broadcast(
        mapping.select(
            F.upper("service_type").alias("_type"), F.lower("field_name").alias("_field"), "event_name"
        )
    )
    if isinstance(anchor, str):
        found, key = _by_column(cells, ev, dims, anchor, window_s), ["resource_id", anchor]
    else:
        found, key = _by_literal(ev, dims, anchor, window_s), ["resource_id"]
    # One row per resource (and anchor): its entries are as many as there are types and mapped fields, so one join brings all evidence.
    listed = found.groupBy(*key).agg(F.collect_list("_entry").alias("_entries"))
    out = cells.join(listed, key, "left")
    out = out.withColumns({"_direct": _best_entry(F.lit(None).cast("string")), "_related": _best_entry(F.col("_field"))})
    evidence = [F.col("_direct"), F.col("_related"), F.lit(UNKNOWN)]
    if latest_first:
        if latest is None:
            latest = ev
        else:  # the changed resources are few: the table is cut down to theirs before anything is grouped
            named = cells.select(F.col("_type").alias("resource_type"), F.col("resource_id").alias("resource_name")).distinct()
            latest = latest.join(named, ["resource_type", "resource_name"], "left_semi")
        by_field, any_event = latest_event(latest, dims)
        mapped = dims.select("_type", "_field").distinct().withColumn("_mapped", F.lit(True))
        out = (
            out.join(by_field, ["_type", "_field", "resource_id"], "left")
            .join(any_event, ["_type", "resource_id"], "left")
            .join(F.broadcast(mapped), ["_type", "_field"], "left")
        )
        evidence = [F.when(F.col("_mapped"), F.col("_latest_field")).otherwise(F.col("_latest_any")), *evidence]
    return out.select(*[c for c in cells.columns if c not in ("_type", "_field")], F.coalesce(*evidence).alias("changed_by"))


def _best_entry(field: Column) -> Column:
    """User of the best entry of the cell's type that stands for ``field`` (null: for the resource itself)."""
    own = F.filter("_entries", lambda e: e["type"].eqNullSafe(F.col("_type")) & e["field"].eqNullSafe(field))
    return F.array_min(F.transform(own, lambda e: e["best"]))["user_name"]


def _entry(type_: Column, field: Column) -> Column:
    return F.struct(type_.alias("type"), field.alias("field"), F.col("_best").alias("best"))


def _by_literal(ev: DataFrame, dims: DataFrame, anchor: Column, window_s: int) -> DataFrame:
    """(resource_id, _entry): one pass over the events inside the window, reduced to type, name and event first.

    An event stands for the resource itself under its type, and for all fields that its name explains.
    """
    grain = _nearest_to_literal(ev, ["resource_type", "resource_name", "event_name"], anchor, window_s)
    explained = grain.join(dims, "event_name", "left")
    entries = F.array(_entry(F.col("resource_type"), F.lit(None).cast("string")), F.when(F.col("_type").isNotNull(), _entry(F.col("_type"), F.col("_field"))))
    return explained.select(F.col("resource_name").alias("resource_id"), F.explode(F.array_distinct(F.array_compact(entries))).alias("_entry"))


def _by_column(cells: DataFrame, ev: DataFrame, dims: DataFrame, anchor: str, window_s: int) -> DataFrame:
    """(resource_id, anchor, _entry): the nearest events of every kind that some cell asks for, in one as-of join.

    A kind is a resource type or an event name; an event is of its type's kind and, if it can explain a field, of its name's.
    """
    typed, named = F.concat(F.lit("T:"), F.col("resource_type")), F.concat(F.lit("E:"), F.col("event_name"))
    explains = F.broadcast(dims.select("event_name", F.lit(True).alias("_explains")).distinct())
    kinds = F.explode(F.array_compact(F.array(typed, F.when(F.col("_explains"), named)))).alias("_kind")
    events = ev.join(explains, "event_name", "left").select(F.col("resource_name").alias("resource_id"), kinds, "event_time", "event_id", "user_name")
    asked = cells.select("_type", "_field", "resource_id", anchor).join(dims, ["_type", "_field"], "left")
    probes = asked.select("resource_id", anchor, F.explode(F.array_compact(F.array(F.concat(F.lit("T:"), F.col("_type")), named))).alias("_kind"))
    found = nearest_event(probes, events, ["resource_id", "_kind"], anchor, window_s)
    found = found.join(dims.select(named.alias("_kind"), "_type", "_field"), "_kind", "left")
    own = F.when(F.startswith("_kind", F.lit("T:")), F.substring("_kind", 3, 10_000))
    return found.select("resource_id", anchor, _entry(F.coalesce(own, F.col("_type")), F.when(own.isNull(), F.col("_field"))).alias("_entry"))


def latest_event(ev: DataFrame, dims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest event per resource, for the events of a field and for any event; no time bound."""
    by_time = F.struct("event_time", "event_id")
    grain = ev.groupBy(
        F.col("resource_type").alias("_type"), F.col("resource_name").alias("resource_id"), "event_name"
    ).agg(F.max(F.struct(by_time.alias("rank"), F.col("user_name"))).alias("_last"))
    by_field = (
        grain.join(dims, ["_type", "event_name"])
        .groupBy("_type", "_field", "resource_id")
        .agg(F.max("_last")["user_name"].alias("_latest_field"))
    )
    any_event = grain.groupBy("_type", "resource_id").agg(F.max("_last")["user_name"].alias("_latest_any"))
    return by_field, any_event

