"""Cell comparators: is the stored value equal to the incoming one?

Each takes the old and new column with their types and returns a non-null boolean column.
They decide whether a row counts as updated; :mod:`inventrace.functions.significance` decides
separately whether the change is worth a history row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inventrace.functions.canon import element_text, py_text
from inventrace.functions.text import strip

Comparator = Callable[[Column, Column, T.DataType, T.DataType], Column]


def _empty() -> Column:
    return F.array().cast("array<string>")


def _none(text: Column) -> Column:
    return F.coalesce(text, F.lit("None"))


def same_text(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """Equal when both print alike; null prints as ``None``."""
    if old_type == new_type and isinstance(old_type, (T.IntegralType, T.TimestampNTZType, T.BooleanType)):
        return old.eqNullSafe(new)
    return _none(py_text(old, old_type)) == _none(py_text(new, new_type))


def _items(col: Column, dtype: T.DataType) -> Column:
    """List column as array of texts; comma text is split; null or "" is empty."""
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.transform(col, element_text(dtype.elementType)), _empty())
    text = py_text(col, dtype)
    return F.when(F.coalesce(text, F.lit("")) == "", _empty()).otherwise(F.split(text, ","))


def _sorted_trimmed(items: Column) -> Column:
    return F.array_sort(F.transform(items, strip))


def same_list(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """List against list or comma text, order-insensitive, items trimmed; other types as text."""
    if isinstance(new_type, T.ArrayType) and isinstance(old_type, (T.ArrayType, T.StringType)):
        return _sorted_trimmed(_items(old, old_type)) == _sorted_trimmed(_items(new, new_type))
    return same_text(old, new, old_type, new_type)


def same_list_untrimmed(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """As :func:`same_list` without trimming the items."""
    if isinstance(new_type, T.ArrayType):
        return F.array_sort(_items(old, old_type)) == F.array_sort(_items(new, new_type))
    return same_text(old, new, old_type, new_type)


def _any_items(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        items = _items(col, dtype)
    elif isinstance(dtype, T.StringType):
        t = strip(F.coalesce(col, F.lit("")))
        inner = F.split(F.substr(t, F.lit(2), F.length(t) - 2), ",")
        is_list = F.startswith(t, F.lit("[")) & F.endswith(t, F.lit("]"))
        is_braced = F.startswith(t, F.lit("{")) & F.endswith(t, F.lit("}"))
        parsed = F.from_json(t, "array<string>", {"allowSingleQuotes": "false"})
        items = (
            F.when(t.isin("", "[]", "{}"), _empty())
            .when(is_list, F.coalesce(parsed, inner))
            .when(is_braced, inner)
            .otherwise(F.split(t, ","))
        )
    else:
        text = py_text(col, dtype)
        blank = col.isNull() | text.isin("{}", "False", "0", "0.0")
        items = F.when(blank, _empty()).otherwise(F.array(text))
    return F.array_sort(F.filter(F.transform(items, strip), lambda x: x != ""))


def same_any_list(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """Everything read as a list (JSON array, ``{a,b}``, comma text, scalar), blanks dropped."""
    return _any_items(old, old_type) == _any_items(new, new_type)


def same_array(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """Order-insensitive arrays; an old value that is no array counts as empty."""
    old_items = _items(old, old_type) if isinstance(old_type, T.ArrayType) else _empty()
    return F.array_sort(old_items) == F.array_sort(_items(new, new_type))


def same_comma(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """Comma text, order-insensitive, when the new text has a comma; else as text."""
    as_lists = F.array_sort(_items(old, old_type)) == F.array_sort(F.split(new, ","))
    return F.when(F.contains(F.coalesce(new, F.lit("")), F.lit(",")), as_lists).otherwise(
        same_text(old, new, old_type, new_type)
    )


def same_comma_trimmed(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """Comma text, order-insensitive, items trimmed and blanks dropped; a null side compares as text."""

    def items(col: Column) -> Column:
        return F.array_sort(F.filter(F.transform(F.split(col, ","), strip), lambda x: x != ""))

    return F.when(old.isNotNull() & new.isNotNull(), items(old) == items(new)).otherwise(
        same_text(old, new, old_type, new_type)
    )


def _same_document(old: Column, new: Column, empty: str) -> Column:
    def canonical(col: Column) -> Column:
        text = F.when(F.coalesce(col, F.lit("")).isin("", "N/A"), F.lit(empty)).otherwise(col)
        return F.to_json(F.try_parse_json(text))

    same = canonical(old) == canonical(new)
    return F.coalesce(same, _none(old) == _none(new))


def same_objects(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """JSON array of objects: key order does not matter, list order does."""
    return _same_document(old, new, "[]")


def same_object(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    """JSON object: key order does not matter."""
    return _same_document(old, new, "{}")


def same_set(old: Column, new: Column) -> Column:
    """Arrays equal as sets."""
    return F.array_sort(F.array_distinct(old)).eqNullSafe(F.array_sort(F.array_distinct(new)))


COMPARATORS: dict[str, Comparator] = {
    "text": same_text,
    "list": same_list,
    "list_untrimmed": same_list_untrimmed,
    "any_list": same_any_list,
    "array": same_array,
    "comma": same_comma,
    "comma_trimmed": same_comma_trimmed,
    "objects": same_objects,
    "object": same_object,
}
