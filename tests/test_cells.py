"""Truth tables of comparators, significance rules, canonical text and small scalars."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inventrace.functions import compare, dates, jsontext, significance
from inventrace.functions import text as tx
from inventrace.functions.canon import py_text
from inventrace.specs.audit_values import EVENT_NAMES, EVENT_SOURCES, field_events, kept_event_names

S, A = T.StringType(), T.ArrayType(T.StringType())


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def lit(v):
    if isinstance(v, list):
        return F.array(*[F.lit(x) for x in v]) if v else F.expr("cast(array() as array<string>)")
    return F.lit(v).cast("string") if v is None else F.lit(v)


CASES = [
    ("text", None, S, "None", S, True),
    ("text", "True", S, "true", S, False),
    ("text", "a", S, "a ", S, False),
    ("list", "a, b", S, ["b", "a"], A, True),
    ("list", None, S, [], A, True),
    ("list", ["a", "a"], A, ["a"], A, False),
    ("list_untrimmed", "a, b", S, ["b", "a"], A, False),
    ("list_untrimmed", "a,b", S, ["b", "a"], A, True),
    ("any_list", '["a", "b"]', S, "{b, a}", S, True),
    ("any_list", "[]", S, [], A, True),
    ("any_list", "", S, "{}", S, True),
    ("any_list", "a,,b", S, ["b", "a"], A, True),
    ("any_list", "a", S, "b", S, False),
    ("array", "a,b", S, ["a", "b"], A, False),
    ("array", None, A, [], A, True),
    ("array", ["b", "a"], A, ["a", "b"], A, True),
    ("comma", "b,a", S, "a,b", S, True),
    ("comma", "b, a", S, "a,b", S, False),
    ("comma", None, S, "a,b", S, False),
    ("comma", None, S, "None", S, True),
    ("comma_trimmed", "CAP_B, CAP_A", S, "CAP_A,CAP_B,", S, True),
    ("comma_trimmed", None, S, "None", S, True),
    ("objects", '[{"a":1,"b":2}]', S, '[{"b":2,"a":1}]', S, True),
    ("objects", '[{"a":1},{"a":2}]', S, '[{"a":2},{"a":1}]', S, False),
    ("objects", None, S, "[]", S, True),
    ("object", "N/A", S, "{}", S, True),
    ("object", "{broken", S, "{broken", S, True),
    ("object", "{broken", S, "{}", S, False),
]


@pytest.mark.parametrize("name,old,old_type,new,new_type,same", CASES)
def test_comparators(spark, name, old, old_type, new, new_type, same):
    fn = compare.COMPARATORS[name]
    old_col = F.lit(None).cast("array<string>") if old is None and old_type == A else lit(old)
    assert one(spark, fn(old_col, lit(new), old_type, new_type))[0] is same
    if old_type == new_type and name != "comma":
        assert one(spark, fn(lit(new), old_col, new_type, old_type))[0] is same


SIGNIFICANT = [
    ("state", None, "", False),
    ("state", " a", "a ", False),
    ("state", "a", "b", True),
    ("state", "[]", "{}", False),
    ("state", "", "[]", False),
    ("state", None, "{}", False),
    ("enabled", "False", "false", False),
    ("enabled", "False", "true", True),
    ("Region", "a", "b", False),
    ("account_name", "a", "b", True),
    ("accountname", "a", "b", False),
    ("tags", '{"aws:cloudformation:stack-id":"1","a":"b"}', "{'a': 'b'}", False),
    ("tags", '{"a":"b"}', '{"a":"c"}', True),
    ("config", '{"a":1,"b":[1,2]}', '{"b":[1,2],"a":1.0}', False),
    ("config", '{"a":1,"b":[1,2]}', '{"b":[2,1],"a":1}', True),
    ("config", "{'a': True, 'b': None}", '{"b": null, "a": true}', False),
    ("config", "{'x', 'y'}", "{'y', 'x'}", False),
    ("triggers", '["a","b","b"]', '["b","a"]', False),
    ("triggers", '["a"]', '["b"]', True),
    # Lists of fields outside the list rule stay order-sensitive when they are not JSON.
    ("vpn_connections", "['a', 'b']", "['b', 'a']", True),
    ("subnets", "['a', 'b']", "['b', 'a']", False),
    ("subnets", "{a, b}", "b,a", False),
    ("subnets", "a,a,b", "a,b", True),
    ("securitygroups", '["{\\"k\\": 1, \\"j\\": 2}"]', '["{\\"j\\": 2, \\"k\\": 1}"]', False),
    ("execution_duration", "1.50", "1.5", False),
    ("duration", "1.50", "1.5", True),
    ("compliance_percentage", "1.5", "1.6", True),
    ("last_modified", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00.999", False),
    ("last_modified", "2024-01-01T00:00:00Z", "2024-01-01 00:00:01", True),
    ("last_modified", "2024-01-01T00:00:00+05:00", "2024-01-01 00:00:00", False),
    ("state", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00", True),
    ("runtime", "python3.12", "python3.13", True),
]


@pytest.mark.parametrize("field,old,new,expected", SIGNIFICANT)
def test_significance(spark, field, old, new, expected):
    assert one(spark, significance.is_significant(F.lit(field), lit(old), lit(new)))[0] is expected
    assert one(spark, significance.is_significant(F.lit(field), lit(new), lit(old)))[0] is expected


def test_canonical_text(spark):
    row = spark.sql(
        """SELECT true AS b, 1.0D AS d, 12345678.25D AS e, 0.00012D AS tiny, array('a', "it's") AS l,
           map('k', 'v') AS m, array(named_struct('Key', 'a', 'Value', cast(null as string))) AS t,
           timestamp_ntz'2024-01-01 00:00:00' AS ts, timestamp_ntz'2024-01-01 00:00:00.5' AS ts2, cast(null as int) AS n"""
    )
    got = row.select(*[py_text(F.col(f.name), f.dataType).alias(f.name) for f in row.schema.fields]).first().asDict()
    assert got == {
        "b": "True", "d": "1.0", "e": "12345678.25", "tiny": "0.00012", "l": "['a', \"it's\"]", "m": "{'k': 'v'}",
        "t": "[{'Key': 'a', 'Value': None}]", "ts": "2024-01-01 00:00:00", "ts2": "2024-01-01 00:00:00.500000", "n": None,
    }


@pytest.mark.parametrize(
    "n,text",
    [
        (0, "0 B"), (1023, "1023 B"), (1024, "1.00 KB"), (848000, "828.12 KB"), (272000, "265.62 KB"),
        (1048571, "1024.00 KB"), (5 * 1024**3, "5.00 GB"), (3 * 1024**4 + 1024**3, "3.00 TB"),
    ],
)
def test_human_bytes(spark, n, text):
    assert f"{n / 1024:.2f} KB" == text or n < 1024 or n >= 1024**2
    assert one(spark, tx.human_bytes(F.lit(n).cast("long")))[0] == text


def test_dates(spark):
    row = one(
        spark,
        dates.micros_text(F.lit("2024-01-02T03:04:05Z")),
        dates.micros_text(F.lit("x")),
        dates.micros_text(F.lit("")),
        dates.utc_text(F.lit("2024-01-02T03:04:05+02:00")),
        dates.utc_text(F.lit("2024-01-02 03:04:05.9")),
    )
    assert list(row) == ["2024-01-02 03:04:05.000000", "x", None, "2024-01-02 01:04:05 UTC", "2024-01-02 03:04:05"]


def test_literal_forms(spark):
    row = one(
        spark,
        jsontext.canonical_json(F.lit("{'b': [True, None], 'a': 'x'}")),
        jsontext.canonical_json(F.lit("{'b', 'a', 'b'}")),
        jsontext.canonical_json(F.lit("plain")),
    )
    assert list(row) == ['{"a":"x","b":[true,null]}', '["a","b"]', None]


def test_first_table(spark):
    queries = ["select 1 from a.b where x", "SELECT 1", "select x from", "select *\nfrom\tt"]
    row = one(spark, *[tx.first_table(F.lit(q)) for q in queries])
    assert list(row) == ["A.B", "N/A", "N/A", "T"]


def test_fixed_values():
    assert len(EVENT_NAMES) == len(set(EVENT_NAMES))
    assert len(EVENT_SOURCES) == 19
    kept = set(kept_event_names())
    assert {e for _, _, e in field_events()} <= kept and set(EVENT_NAMES) <= kept
