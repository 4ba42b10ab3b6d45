"""One text form per type, so that cells of any type can be compared and kept in history.

The text follows what ``str()`` prints in Python: ``None``, ``True``, ``1.0``, ``['a', 'b']``,
``{'k': 'v'}``. History rows written by earlier inventory loaders use the same form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quote(text: Column) -> Column:
    has_single = F.contains(text, F.lit("'"))
    has_double = F.contains(text, F.lit('"'))
    return (
        F.when(has_single & ~has_double, F.concat(F.lit('"'), text, F.lit('"')))
        .when(has_single, F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'")))
        .otherwise(F.concat(F.lit("'"), text, F.lit("'")))
    )


def _double_text(col: Column) -> Column:
    """Plain decimal notation where CAST(double AS STRING) would print an exponent."""
    short = col.cast("string")
    digits = F.call_function("format_number", col, F.lit("0.0###############"))
    return F.when(F.contains(short, F.lit("E")) & (F.abs(col) < 1e16) & (F.abs(col) >= 1e-4), digits).otherwise(short)


def _inner(col: Column, dtype: T.DataType) -> Column:
    """Text of a value nested in a list, map or object: strings are quoted."""
    text = py_text(col, dtype)
    if isinstance(dtype, T.StringType):
        text = _quote(col)
    return F.coalesce(text, F.lit("None"))


def py_text(col: Column, dtype: T.DataType) -> Column:
    """Canonical text of a typed column. SQL null stays null."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _double_text(col)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        whole = F.date_trunc("second", col) == col
        return F.when(whole, F.date_format(col, "yyyy-MM-dd HH:mm:ss")).otherwise(
            F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        )
    if isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda x: _inner(x, dtype.elementType))
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    if isinstance(dtype, T.MapType):
        items = F.transform(
            F.map_entries(col),
            lambda e: F.concat(_inner(e["key"], dtype.keyType), F.lit(": "), _inner(e["value"], dtype.valueType)),
        )
        return F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
    if isinstance(dtype, T.StructType):
        items = [F.concat(F.lit(f"'{f.name}': "), _inner(col[f.name], f.dataType)) for f in dtype.fields]
        return F.when(col.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *items), F.lit("}")))
    return col.cast("string")


def element_text(dtype: T.DataType):
    """Text of one list element (a bare string is not quoted)."""
    return lambda x: F.coalesce(py_text(x, dtype), F.lit("None"))
