"""Line dedup: runs of lines that occur earlier are found by winnowed line hashes and deleted. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import WORD, stored

#: Lines per window. Every run of this many lines has the smallest hash of its window as a fingerprint.
WINDOW_LINES = 3
#: A run of fewer lines counts if it has this many words; its longest line is its fingerprint.
MIN_WORDS = 50

def _lines(text: Column) -> Column:
    """Lines with a word: number, two independent hashes, words."""
    return F.filter(
        F.transform(
            F.split(text, "\n", -1),
            lambda line, i: F.struct(i.alias("pos"), F.xxhash64(line).alias("h"), F.xxhash64(F.lit(7), line).alias("g"), F.regexp_count(line, F.lit(WORD)).alias("words")),
        ),
        lambda x: x.words > 0,
    )


def _lowest(lines: Column, window: int) -> Column:
    """For each window of lines the place of its smallest hash, the first of equal ones."""

    def at(start: Column) -> Column:
        hashes = F.transform(F.slice(lines, start + 1, window), lambda x: x.h)
        return start + F.array_position(hashes, F.array_min(hashes)).cast("int") - 1

    starts = F.when(F.size(lines) >= window, F.sequence(F.lit(0), F.size(lines) - window)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, at)


def _prints(lines: Column, lowest: Column, window: int, min_words: int) -> Column:
    """The lines that are selected as fingerprints: i, line, left and right (up to ``window - 1`` neighbours, nearest first), views.

    A line is selected by the windows whose minimum it is, by being long, and by a neighbour with which it is long together, if it has more of the
    words. Every occurrence of a run that counts selects the same line of it. A view says by which rule, and what the lines that
    decided it are: (kind, key).
    """
    r = window - 1

    def view(cond: Column, kind: int, key: Column) -> Column:
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), key.alias("key")))

    def at(x: Column, i: Column) -> Column:
        windows = [
            view(F.get(lowest, i - o) == i, o, F.xxhash64(F.transform(F.slice(lines, F.greatest(i - o, F.lit(0)) + 1, window), lambda z: z.h)))
            for o in range(window)
        ]
        before, after = F.get(lines, i - 1), F.get(lines, i + 1)
        short = (x.words < min_words) & F.lit(window > 2)
        with_next = short & (after.words < min_words) & (x.words + after.words >= min_words) & (x.words >= after.words)
        with_last = short & (before.words < min_words) & (x.words + before.words >= min_words) & (x.words > before.words)
        views = [*windows, view(x.words >= min_words, -1, F.lit(0).cast("long")), view(with_next, -2, after.h), view(with_last, -3, before.h)]
        left = F.reverse(F.slice(lines, F.greatest(i - r, F.lit(0)) + 1, F.least(i, F.lit(r))))
        return F.struct(i.alias("i"), x.alias("line"), left.alias("left"), F.slice(lines, i + 2, r).alias("right"), F.array_compact(F.array(*views)).alias("views"))

    return F.filter(F.transform(lines, at), lambda p: F.size(p.views) > 0)


def _alike(a: Column, b: Column) -> Column:
    """How many lines from the start two lists of lines have in common."""
    same = F.zip_with(a, b, lambda x, y: x.h.eqNullSafe(y.h) & x.g.eqNullSafe(y.g))
    stop = F.array_position(same, F.lit(False)).cast("int")
    return F.when(stop > 0, stop - 1).otherwise(F.size(same))


def _covered(run: Column, apart: Column, window: int, min_words: int) -> Column:
    """The numbers of a run's lines that go: all of a run that counts by its lines, else those of long lines and pairs.

    ``apart`` is how many lines later than its earlier occurrence the run stands in the same document, large in another.
    """
    long_ = F.transform(F.filter(run, lambda x: x.words >= min_words), lambda x: x.pos)

    def pair(x: Column, j: Column) -> Column:
        y = F.get(run, j + 1)
        fits = (x.words < min_words) & (y.words < min_words) & (x.words + y.words >= min_words) & (apart >= 2) & F.lit(window > 2)
        return F.when(fits, F.array(x.pos, y.pos)).otherwise(F.array().cast("array<int>"))

    return F.when((F.size(run) >= window) & (apart >= window), F.transform(run, lambda x: x.pos)).otherwise(F.concat(long_, F.flatten(F.transform(run, pair))))


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, mark of the text, lines): the numbers of the lines to delete from each document that has any.

    Only fingerprints are shuffled, and of those only the ones whose line is repeated with their neighbours. Each joins the first one that was selected
    by the same lines; from there the match is extended line by line, both ways.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("body"), _lines(text).alias("lines"))
    rows = rows.withColumn("lowest", _lowest(F.col("lines"), window))
    prints = stored(rows.select("id", "body", F.inline(_prints(F.col("lines"), F.col("lowest"), window, min_words))).withColumn("mark", F.col("line.h")), "prints")
    place = F.xxhash64("id", "body", "i")
    again = prints.groupBy("mark").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("mark")
    views = stored(prints.join(again, "mark", "left_semi").withColumn("view", F.explode("views")).select("mark", "view.kind", "view.key", "id", "body", "i", "line", "left", "right"), "views")
    here, context = F.struct("id", "body", "i"), F.struct("line", "left", "right")
    first = views.groupBy("mark", "kind", "key").agg(F.min_by(context, here).alias("there"), F.min(here).alias("first"), F.max(here).alias("last"))
    first = first.filter("first < last").select(F.col("mark").alias("m"), F.col("kind").alias("n"), F.col("key").alias("k"), "there", "first")
    met = views.join(first, (F.col("mark") == F.col("m")) & (F.col("kind") == F.col("n")) & (F.col("key") == F.col("k"))).filter(here > F.col("first"))
    met = met.filter(F.col("line.g").eqNullSafe(F.col("there.line.g")))
    own = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("body") == F.col("first.body"))
    before, after = _alike(F.col("left"), F.col("there.left")), _alike(F.col("right"), F.col("there.right"))
    run = F.concat(F.reverse(F.slice("left", F.lit(1), before)), F.array("line"), F.slice("right", F.lit(1), after))
    apart = F.when(own, F.col("i") - F.col("first.i")).otherwise(F.lit(2**31 - 1))
    later = met.select("id", "body", run.alias("run"), apart.alias("apart"))
    gone = later.select("id", "body", F.explode(_covered(F.col("run"), F.col("apart"), window, min_words)).alias("line"))
    return gone.groupBy("id", "body").agg(F.collect_set("line").alias("lines"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs cut from the text, and n_lines and removed_lines in the struct ``line_dedup`` (a column of
    that name is replaced).

    A run counts if it has ``window`` lines or ``min_words`` words; lines without a word are passed over and stay. Order is
    (doc_id, hash of the text, line), null ids first. A line goes if it lies in a run that also occurs earlier, in another
    document or, without overlap, in its own; runs are judged on the input. Lines are compared by 128 bits of their hashes. Each match
    reaches up to ``window - 1`` lines from its fingerprint both ways; what overlaps joins up to the full
    length. The first occurrence of every line stays. Rows that repeat id and text are one document and
    get the same cuts. Null texts stay null.
    """
    gone = repeated_lines(docs, id_col, text_col, window, min_words).withColumnsRenamed({"id": "i", "body": "b"})
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("body"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("i")) & (F.col("body") == F.col("b")), "left")
    split = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("lines"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    about = F.struct(
        F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("removed_lines"),
    )
    new = {text_col: F.when(F.col("lines").isNull(), F.col("text")).otherwise(kept)}
    names = [c for c in docs.columns if c != "line_dedup"]
    return joined.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in names], about.alias("line_dedup"))
