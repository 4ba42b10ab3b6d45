"""Mixing sources to target weights by a time-varying curriculum. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inventrace.llm.common import WORD, stored

#: No source is taken more often than this.
MAX_REPEATS = 3
#: Hex digits of a document's order key that name its block: a source is added up in up to 16^3 blocks, so that no
#: task has to walk a whole source.
BLOCK_DIGITS = 3

SEGMENTS = "array<struct<t0: double, w0: double, slope: double, before: double>>"


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """A constant schedule: sources by code point, null last, get the weights in turn."""
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    knot = lambda t: F.struct(F.lit(t).alias("t"), weight.alias("weight"))
    return sources.select("source", F.array(knot(0.0), knot(1.0)).alias("knots"))


def _integrated(knots: Column) -> tuple[Column, Column]:
    """(segments of the piecewise linear schedule with the integral before each, whole integral).

    Knots are sorted by time. Two at one time are a step: the weight jumps there, and no segment lies between them.
    """
    pairs = F.transform(F.slice(knots, 2, F.size(knots)), lambda b, i: F.struct(F.element_at(knots, i + 1).alias("a"), b.alias("b")))
    pairs = F.transform(
        F.filter(pairs, lambda p: p.b.t > p.a.t),
        lambda p: F.struct(
            p.a.t.alias("t0"),
            p.a.weight.alias("w0"),
            ((p.b.weight - p.a.weight) / (p.b.t - p.a.t)).alias("slope"),
            ((p.b.t - p.a.t) * (p.b.weight + p.a.weight) / 2).alias("area"),
        ),
    )
    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast(SEGMENTS).alias("segments"))
    folded = F.aggregate(
        pairs,
        start,
        lambda acc, p: F.struct(
            (acc.sum + p.area).alias("sum"),
            F.concat(acc.segments, F.array(F.struct(p.t0.alias("t0"), p.w0.alias("w0"), p.slope.alias("slope"), acc.sum.alias("before")))).cast(SEGMENTS).alias("segments"),
        ),
    )
    return folded.segments, folded.sum


def targets(sources: DataFrame, schedule: DataFrame, share: float = 1.0, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, weight, segments) for sources with their sizes.

    ``share`` of all sizes is dealt out in proportion to the integrals of the weights; a target stops at
    ``max_repeats`` times its source's size and the excess goes to the others by weight. Ordered by cap over weight,
    the level that holds for everyone is the highest that any source would see with all before it capped. A source
    without a schedule has weight 0. The windows run over one aggregated row per source.
    """
    segments, area = _integrated(F.col("knots"))
    planned = schedule.select(F.col("source").alias("s"), segments.alias("segments"), area.alias("weight"))
    rows = sources.join(planned, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "segments", F.coalesce("weight", F.lit(0.0)).alias("weight"), (F.lit(float(max_repeats)) * F.col("source_size")).alias("cap")
    )
    rows = rows.withColumn("turn", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf"))))
    everyone = Window.partitionBy()
    before = Window.orderBy("turn", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(share)) * F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", F.when((F.col("weight") > 0) & (weights > 0), left / weights))
    level = F.coalesce(F.max("level").over(everyone), F.lit(0.0))
    target = F.when(F.col("weight") > 0, F.least(F.col("cap"), level * F.col("weight"))).otherwise(F.lit(0.0))
    return rows.select("source", "source_size", target.alias("target"), "weight", "segments")


def position(demand: Column, target: Column, weight: Column, segments: Column) -> Column:
    """The time at which a source's cumulative demand reaches ``demand``: the inverse of its integrated schedule."""
    area = demand / target * weight
    at = F.element_at(F.filter(segments, lambda s: s.before <= area), -1)
    rest = F.greatest(area - at.before, F.lit(0.0))
    root = F.sqrt(F.greatest(at.w0 * at.w0 + 2 * at.slope * rest, F.lit(0.0)))
    return at.t0 + F.when(at.w0 + root > 0, 2 * rest / (at.w0 + root)).otherwise(F.lit(0.0))


def plan(
    docs: DataFrame,
    schedule: DataFrame | None = None,
    size: Column | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    share: float = 1.0,
    max_repeats: int = MAX_REPEATS,
    cut_last: bool = True,
) -> DataFrame:
    """One row per document: doc (all its columns), size, source_size, target, copies (copy, words, position).

    Inside a source, documents stand in the order of md5(doc_id): an arbitrary order that reruns repeat. Copy e of a
    document covers e x source_size + [start, start + size) of its source's demand and is taken up to the target. With
    ``cut_last`` the document at the end gives only the words that are missing, so a source's taken words are its target
    rounded; without it that copy is taken whole if at least half of it is wanted. Null texts and texts without words have
    size 0 and no copies. A null source is a source. Repeated rows are documents of their own (ties of doc_id go by size).
    Columns of ``docs`` stay inside ``doc``, so their names cannot clash.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source_col).cast("string").alias("source"),
        (words(F.col(text_col)) if size is None else size).alias("size"),
        key.alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("name"),
    ).withColumn("block", F.substring("key", 1, BLOCK_DIGITS))
    blocks = stored(rows.groupBy("source", "block").agg(F.sum("size").alias("block_size")), "blocks")
    sources = blocks.groupBy("source").agg(F.sum("block_size").alias("source_size"))
    wanted = targets(sources, cycled_weights(sources) if schedule is None else schedule, share, max_repeats)
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("offset", F.coalesce(F.sum("block_size").over(earlier), F.lit(0))).alias("p").join(wanted.alias("w"), F.col("p.source").eqNullSafe(F.col("w.source")))
    name = F.coalesce(F.concat(F.lit("="), F.col("p.source")), F.lit(""))
    placed = placed.select(name.alias("s"), F.col("block").alias("b"), "offset", "source_size", "target", "weight", "segments")
    inside = Window.partitionBy("name", "block").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(placed, (F.col("name") == F.col("s")) & (F.col("block") == F.col("b")))
    goal = F.round("target").cast("long")
    start = F.col("offset") + F.col("before")

    def copy(e: Column) -> Column:
        at = e.cast("long") * F.col("source_size") + start
        taken = F.greatest(F.least(F.col("size"), goal - at), F.lit(0))
        if not cut_last:
            taken = F.when(2 * (goal - at) >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        return F.struct(e.cast("int").alias("copy"), taken.cast("long").alias("words"), position(at.cast("double"), F.col("target"), F.col("weight"), F.col("segments")).alias("position"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), copy), lambda c: c.words > 0)
    return rows.select("doc", "size", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(F.array().cast("array<struct<copy: int, words: bigint, position: double>>")).alias("copies"))


def mix(planned: DataFrame) -> DataFrame:
    """The taken copies in training order: doc, copy, words, position, range-sorted by position."""
    rows = planned.select("doc", F.inline("copies"))
    n = int(planned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, "position", "copy").sortWithinPartitions("position", "copy")
