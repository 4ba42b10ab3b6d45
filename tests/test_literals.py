"""Literal and date texts, against Python's own readers."""

from __future__ import annotations

import ast
import json
import random
from datetime import datetime

import pytest
from dateutil import parser
from pyspark.sql import functions as F

from inventrace.functions import dates, jsontext, significance


def listed(value):
    """A literal as a JSON document: tuples as lists, sets as sorted lists."""
    if isinstance(value, dict):
        return {str(k): listed(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [listed(v) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted((listed(v) for v in value), key=json.dumps)
    return value


def some_value(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 5)
    if kind == 0:
        return rng.choice([True, False, None])
    if kind == 1:
        return rng.randint(-50, 10**9)
    if kind == 2:
        return rng.choice([0.5, -2.25, 1e-3])
    if kind < 5:
        return "".join(rng.choice("ab'\" \\,:{}[]()\n\té漢x") for _ in range(rng.randint(0, 8)))
    if kind == 5:
        return [some_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    if kind == 6:
        return tuple(some_value(rng, depth + 1) for _ in range(rng.choice([0, 2, 3])))
    if kind == 7:
        return {f"s{rng.randint(0, 5)}" for _ in range(rng.randint(1, 3))}
    return {f"k{i}'\"": some_value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def canonical(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", jsontext.canonical_json(F.col("t")).alias("c")).collect()
    return [r.c for r in sorted(rows, key=lambda r: r.i)]


def test_nested_literals_are_read_as_python_reads_them(spark):
    rng = random.Random(4)
    values = [v for v in (some_value(rng) for _ in range(600)) if isinstance(v, (dict, list, tuple, set))]
    texts = [str(v) for v in values]
    for text, got in zip(texts, canonical(spark, texts)):
        assert got is not None and json.loads(got) == listed(ast.literal_eval(text)), text


TEXTS = [
    "{'a': [1, (2, 3,),],}",
    r"{'a\x41\u00e9': 'it\'s', 5: 1, True: 2}",
    "{'b', 'a', 'b'}",
    "[]",
    "{}",
    "()",
    "{'a': {'b': {1, 2}}}",
    r"['\\x41', 'c\td', 'tab	here', '\a', '\q']",
    "[[[[1]], []], {'': ''}]",
]


@pytest.mark.filterwarnings("ignore::SyntaxWarning")
@pytest.mark.filterwarnings("ignore::DeprecationWarning")
def test_escapes_and_brackets(spark):
    for text, got in zip(TEXTS, canonical(spark, TEXTS)):
        assert got is not None and json.loads(got) == json.loads(json.dumps(listed(ast.literal_eval(text))).replace('"True"', '"true"')), text


def test_other_texts_are_no_documents(spark):
    texts = ["plain", "{'a': 1", "{'a' 'b'}", "[1, 2))", "{a: 1}", "[1,,2]", "b'x'", "{'a':}", "f(1)", "{'x': 'y}", "", "(1) (2)", "{1: 2: 3}"]
    assert canonical(spark, texts) == [None] * len(texts)


def test_spelling_is_no_change(spark):
    pairs = [
        ("{'a': ('x', {'b': None})}", '{"a":["x",{"b":null}]}', False),
        ("{'a': {'it\\'s', 'b'}}", "{'a': {'b', \"it's\"}}", False),
        ("{'a': ('x', {'b': None})}", '{"a":["x",{"b":false}]}', True),
    ]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, o string, n string, want boolean")
    got = rows.select("want", significance.is_significant(F.lit("policy"), F.col("o"), F.col("n")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


FORMS = [
    "Mon, 15 Jan 2024 10:05:06 GMT", "Monday, 15 January 2024 10:05", "15 Jan 2024", "15-Jan-2024 22:05:06", "January 15, 2024 10:05 PM", "Jan 5, 2024, 12:05 AM",
    "01/15/2024", "1/5/2024 9:05:06 PM", "15/01/2024 10:05:06", "2024/01/15 10:05:06.25", "2024/1/5", "Mon Jan 15 10:05:06 2024", "Mon Jan 15 10:05:06 UTC 2024",
    "20240115T100506", "20240115T100506Z", "20240115", "2024-01-15T10:05:06Z", "2024-01-15 10:05:06.123456+02:00", "2024-01-15", "2024-1-5 7:05", "15 Jan 2024 10:05:06 +0100", "Sept 5, 2024 10:00",
]


def test_dates_are_read_as_dateutil_reads_them(spark):
    rows = spark.createDataFrame([(f,) for f in FORMS], "t string").select("t", dates.parse_naive(F.col("t")).alias("d")).collect()
    for r in rows:
        assert r.d == parser.parse(r.t, default=datetime(2024, 1, 1)).replace(tzinfo=None), r.t
    none = spark.createDataFrame([("hello",), ("",), ("12",), ("32 Jan 2024",), ("Foo 5, 2024",), ("13/13/2024",), (None,)], "t string")
    assert [r.d for r in none.select(dates.parse_naive(F.col("t")).alias("d")).collect()] == [None] * 7
