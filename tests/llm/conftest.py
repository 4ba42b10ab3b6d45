"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, extra columns with clashing names."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, doc string, `key` long, `fp` string, `lines` long, `block` string, id long, body string, size string"
LONG = "x" * 200_000
PROSE = [
    "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions of amber",
    "a second text about rivers and mountains that nobody else in this small corpus has written yet",
]


def row(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), "r", "d", 1, "f", 2, "b", 3, "y", "s")


ROWS = [
    row(1, PROSE[0]),
    row(2, PROSE[0].upper()),
    row(3, PROSE[1], "b"),
    row(3, PROSE[1], "b"),  # a repeated row
    row(3, "another text with the same id", None),
    row(4, None, None, None),
    row(None, "a text without an id, but with some words", "a"),
    row(None, None, "b"),
    row(5, ""),
    row(6, " \t\n\v\f\r "),
    row(7, LONG, "c"),
    row(8, ("word " * 30_000), "c"),
    row(9, "\n".join(PROSE + PROSE), "a"),
    row(10, "ünïcode — ßtraße 漢字 😀 ́ İ Σ <turn> \\ </turn>", "é"),
    row(11, "a\x1cb\x85c d", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)
