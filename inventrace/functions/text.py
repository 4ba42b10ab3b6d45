"""Small column helpers shared by the flatten specs: defaults, tags, segments, joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def or_default(col: Column, fill: str | int | bool = MISSING) -> Column:
    """Absent attribute -> default."""
    return F.coalesce(col, F.lit(fill))


def or_default_blank(col: Column, fill: str = MISSING) -> Column:
    """Absent or empty attribute -> default."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(fill))


def first_non_blank(*cols: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def clip(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def last_chars(col: Column, n: int) -> Column:
    return F.when(F.length(col) > n, F.right(col, F.lit(n))).otherwise(col)


def last_segment(col: Column, sep: str) -> Column:
    return F.substring_index(col, sep, -1)


def first_segment(col: Column, sep: str) -> Column:
    return F.substring_index(col, sep, 1)


def tag_value(tags: Column, key: str, fill: str = MISSING, names: tuple[str, str] = ("Key", "Value")) -> Column:
    """Value of the first tag called ``key`` in an ``array<struct<Key,Value>>``."""
    k, v = names
    return or_default(F.get(F.filter(tags, lambda t: t[k] == key), F.lit(0))[v], fill)


def tag_value_last(tags: Column, key: str, fill: str = MISSING, names: tuple[str, str] = ("Key", "Value")) -> Column:
    """Same, but a repeated key keeps its last value, as when the tags are loaded into a map."""
    k, v = names
    return or_default(F.try_element_at(F.filter(tags, lambda t: t[k] == key), F.lit(-1))[v], fill)


def ids(items: Column, field: str) -> Column:
    """``array<struct>`` -> array of one attribute; an absent list is empty."""
    return F.coalesce(F.transform(items, lambda x: x[field]), F.array().cast("array<string>"))


def count_of(items: Column) -> Column:
    """Length of an array or map; absent is 0."""
    return F.greatest(F.coalesce(F.size(items), F.lit(0)), F.lit(0)).cast("long")


def first_items(items: Column, n: int | None) -> Column:
    """The first n items of a list, all without a limit."""
    return items if n is None else F.slice(items, 1, n)


def join_or(items: Column, fill: str = MISSING, sep: str = ", ", first: int | None = None) -> Column:
    """Join a list (or its first n items) to text; an absent or empty list gives ``fill``."""
    taken = first_items(items, first)
    return F.when(count_of(items) > 0, F.array_join(taken, sep)).otherwise(F.lit(fill))


def flags(*pairs: tuple[str, Column]) -> Column:
    """Labels whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for label, cond in pairs]))


def label_when(cond: Column, *parts: Column | str) -> Column:
    """Concatenated label when the condition holds, else null."""
    return F.when(cond, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def human_bytes(n: Column) -> Column:
    """Byte count as text with two decimals and a unit from B to TB (powers of 1024).

    Hundredths are counted in whole numbers and ties go to the even digit, so 848000 is "828.12 KB".
    """
    out = F.when(n == 0, F.lit("0 B"))
    for unit, power in (("TB", 4), ("GB", 3), ("MB", 2), ("KB", 1)):
        size = F.lit(1024**power).cast("long")
        cents = F.call_function("div", n * 100, size)
        rest = (n * 100 % size) * 2
        up = (rest > size) | ((rest == size) & (cents % 2 == 1))
        cents = cents + F.when(up, F.lit(1)).otherwise(F.lit(0))
        shown = F.concat(
            F.call_function("div", cents, F.lit(100)).cast("string"),
            F.lit("."),
            F.lpad((cents % 100).cast("string"), 2, "0"),
            F.lit(f" {unit}"),
        )
        out = out.when(n >= size, shown)
    return out.otherwise(F.concat(n.cast("string"), F.lit(" B")))


def first_table(query: Column) -> Column:
    """Upper-cased first token after the first FROM; "N/A" when there is none."""
    tail = F.get(F.split(F.upper(query), "FROM"), F.lit(1))
    return F.coalesce(F.nullif(F.get(F.split(strip(tail), r"\s+"), F.lit(0)), F.lit("")), F.lit(MISSING))
