"""Comparators, significance rules, and scalar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import check, table, text
from inventrace.functions import compare, dates, jsontext, significance
from inventrace.functions import text as tx
from inventrace.operators.rollup import distinct_prefixes
from inventrace.specs import compute, data, network
from inventrace.specs.compute import policy_triggers, security_summary

S, AS = T.StringType(), T.ArrayType(T.StringType())


def lit(v: str) -> Column:
    return F.lit(v)


def cust(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with three list items; ``odd`` marks the rows whose new list differs."""
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("seg"),
        F.concat(lit("n"), text("c_nationkey")).alias("nat"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("bal"),
        F.col("c_nationkey").alias("key"),
        F.when(F.col("c_nationkey") < 5, F.concat(lit("x"), text("c_nationkey"))).otherwise(F.col("c_name")).alias("alt"),
    )


CUST = """c AS (SELECT c_custkey AS id, c_mktsegment AS seg, 'n' || c_nationkey AS nat, c_name AS name, c_acctbal AS bal,
  c_nationkey AS key, CASE WHEN c_nationkey < 5 THEN 'x' || c_nationkey ELSE c_name END AS alt FROM customer)"""

# ---------------------------------------------------------------- comparators


@check(
    "cmp_strict",
    f"""WITH {CUST} SELECT id,
      (CASE WHEN key < 8 THEN 'None' ELSE name END) = coalesce(CASE WHEN key < 12 THEN NULL ELSE alt END, 'None') AS same_text,
      bal = floor(bal) AS same_number, true AS same_flag FROM c""",
)
def cmp_strict(spark: SparkSession, sf: str) -> DataFrame:
    c = cust(spark, sf)
    old = F.when(F.col("key") < 8, lit("None")).otherwise(F.col("name"))
    new = F.when(F.col("key") >= 12, F.col("alt"))
    flag = F.col("key") > 3
    return c.select(
        "id",
        compare.same_text(old, new, S, S).alias("same_text"),
        compare.same_text(F.col("bal"), F.floor("bal"), T.DoubleType(), T.DoubleType()).alias("same_number_raw"),
        compare.same_text(F.col("bal"), F.floor("bal").cast("double"), T.DoubleType(), T.DoubleType()).alias("same_number"),
        compare.same_text(flag, F.initcap(text(flag)), T.BooleanType(), S).alias("same_flag"),
    ).drop("same_number_raw")


@check(
    "cmp_list_trim",
    f"""WITH {CUST} SELECT id,
      list_sort([seg, nat, name]) = list_sort([alt, seg, nat]) AS same_text, list_sort([seg, nat]) = list_sort([nat, seg]) AS same_array
      FROM c""",
)
def cmp_list_trim(spark: SparkSession, sf: str) -> DataFrame:
    c = cust(spark, sf)
    old = F.concat_ws(" , ", "seg", "nat", "name")
    return c.select(
        "id",
        compare.same_list(old, F.array("alt", "seg", "nat"), S, AS).alias("same_text"),
        compare.same_list(F.array("seg", "nat"), F.array(F.concat(lit(" "), "nat"), "seg"), AS, AS).alias("same_array"),
    )


@check(
    "cmp_list_raw",
    f"""WITH {CUST} SELECT id, list_sort([seg, nat, name]) = list_sort([alt, seg, nat]) AS same_tight,
      false AS same_spaced FROM c""",
)
def cmp_list_raw(spark: SparkSession, sf: str) -> DataFrame:
    c = cust(spark, sf)
    new = F.array("alt", "seg", "nat")
    return c.select(
        "id",
        compare.same_list_untrimmed(F.concat_ws(",", "seg", "nat", "name"), new, S, AS).alias("same_tight"),
        compare.same_list_untrimmed(F.concat_ws(", ", "seg", "nat", "name"), new, S, AS).alias("same_spaced"),
    )


@check(
    "cmp_list_any",
    f"""WITH {CUST} SELECT id, list_sort([seg, nat, name]) = list_sort([alt, seg, nat]) AS same_json,
      list_sort([seg, nat, name]) = list_sort([alt, seg, nat]) AS same_braced,
      list_sort([seg, nat, name]) = list_sort([alt, seg, nat]) AS same_comma,
      true AS same_empty, name = alt AS same_scalar FROM c""",
)
def cmp_list_any(spark: SparkSession, sf: str) -> DataFrame:
    c = cust(spark, sf)
    new = F.array("alt", "seg", "nat")
    return c.select(
        "id",
        compare.same_any_list(F.to_json(F.array("seg", "nat", "name")), new, S, AS).alias("same_json"),
        compare.same_any_list(F.concat(lit("{"), F.concat_ws(", ", "seg", "nat", "name"), lit("}")), new, S, AS).alias(
            "same_braced"
        ),
        compare.same_any_list(F.concat_ws(" ,, ", "seg", "nat", "name"), new, S, AS).alias("same_comma"),
        compare.same_any_list(
            F.when(F.col("key") < 9, lit("{}")).otherwise(lit(" ")), F.expr("cast(array() as array<string>)"), S, AS
        ).alias("same_empty"),
        compare.same_any_list(F.col("name"), F.concat(lit(" "), "alt"), S, S).alias("same_scalar"),
    )


@check(
    "cmp_array",
    f"""WITH {CUST} SELECT id, list_sort([seg, nat, name]) = list_sort([nat, alt, seg]) AS same_array,
      false AS same_text FROM c""",
)
def cmp_array(spark: SparkSession, sf: str) -> DataFrame:
    c = cust(spark, sf)
    new = F.array("nat", "alt", "seg")
    return c.select(
        "id",
        compare.same_array(F.array("seg", "nat", "name"), new, AS, AS).alias("same_array"),
        compare.same_array(F.concat_ws(",", "seg", "nat", "name"), new, S, AS).alias("same_text"),
    )


@check(
    "cmp_comma",
    f"""WITH {CUST} SELECT id, list_sort([seg, nat, name]) = list_sort([nat, alt, seg]) AS same_list,
      name = alt AS same_single,
      list_sort([seg, nat, name]) = list_sort([nat, alt, seg]) AS same_caps FROM c""",
)
def cmp_comma(spark: SparkSession, sf: str) -> DataFrame:
    c = cust(spark, sf)
    old, new = F.concat_ws(",", "seg", "nat", "name"), F.concat_ws(",", "nat", "alt", "seg")
    spaced = F.concat_ws(" , ", "nat", "alt", "seg", lit(""))
    return c.select(
        "id",
        compare.same_comma(old, new, S, S).alias("same_list"),
        compare.same_comma(F.col("name"), F.col("alt"), S, S).alias("same_single"),
        compare.same_comma_trimmed(old, spaced, S, S).alias("same_caps"),
    )


@check(
    "cmp_json_object",
    """SELECT event_id, (event_type <> 'error') AS same, (event_type NOT IN ('view', 'error')) AS same_or_text FROM events""",
)
def cmp_json_object(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    old = F.concat(lit('{"type": "t", "k": '), k, lit("}"))
    new = F.concat(lit('{"k":'), k, lit(',"type":"'), F.when(F.col("event_type") == "error", lit("u")).otherwise(lit("t")), lit('"}'))
    broken = F.when(F.col("event_type") == "view", F.concat(lit("{oops"), k)).otherwise(old)
    return ev.select(
        "event_id",
        compare.same_object(old, new, S, S).alias("same"),
        compare.same_object(broken, new, S, S).alias("same_or_text"),
    )


@check(
    "cmp_json_array",
    """SELECT event_id, event_type <> 'error' AS same, false AS same_swapped,
         event_type = 'click' AS same_empty FROM events""",
)
def cmp_json_array(spark: SparkSession, sf: str) -> DataFrame:
    """List order matters, key order inside the objects does not."""
    ev = table(spark, sf, "events")
    k, id_ = F.get_json_object("props", "$.k"), text("event_id")
    first = F.concat(lit('{"id": "'), id_, lit('", "domain": "d'), k, lit('"}'))
    again = F.concat(lit('{"domain":"d'), k, lit('","id":"'), id_, F.when(F.col("event_type") == "error", lit("-")).otherwise(lit("")), lit('"}'))
    other = lit('{"id": "z", "domain": "y"}')

    def array(*parts: Column) -> Column:
        return F.concat(lit("["), F.concat_ws(", ", *parts), lit("]"))

    empty = F.when(F.col("event_type") == "click", lit("N/A")).otherwise(array(first))
    return ev.select(
        "event_id",
        compare.same_objects(array(first, other), array(again, other), S, S).alias("same"),
        compare.same_objects(array(first, other), array(other, again), S, S).alias("same_swapped"),
        compare.same_objects(empty, lit("[]"), S, S).alias("same_empty"),
    )


@check(
    "set_equality",
    f"""WITH {CUST} SELECT id, list_sort(list_distinct([seg, name])) = list_sort(list_distinct([alt, seg, seg])) AS same FROM c""",
)
def set_equality(spark: SparkSession, sf: str) -> DataFrame:
    same = compare.same_set(F.array("seg", "name"), F.array("alt", "seg", "seg"))
    return cust(spark, sf).select("id", same.alias("same"))


# ---------------------------------------------------------------- significance


@check(
    "sig_empty_equiv",
    """SELECT event_id, event_type IN ('view', 'click') AS blank_same,
         event_type IN ('view', 'click', 'error') AS empty_same FROM events""",
)
def sig_empty_equiv(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    old = F.when(kind == "view", F.lit(None).cast("string")).when(kind == "click", text("value")).when(
        kind == "error", lit("[]")
    ).otherwise(lit("q"))
    new = F.when(kind == "view", lit(" ")).when(kind == "click", F.concat(lit("\t"), text("value"), lit(" "))).when(
        kind == "error", lit("{}")
    ).otherwise(lit("[]"))
    same = significance.blank_or_same(old, new)
    return table(spark, sf, "events").select(
        "event_id", same.alias("blank_same"), (same | significance.both_empty(old, new)).alias("empty_same")
    )


@check(
    "sig_bool",
    """SELECT o_orderkey, o_orderstatus IN ('O', 'P') AS same FROM orders""",
)
def sig_bool(spark: SparkSession, sf: str) -> DataFrame:
    st = F.col("o_orderstatus")
    old = F.when(st == "O", lit("True")).when(st == "P", lit("false")).otherwise(lit("True"))
    new = F.when(st == "O", lit("true")).when(st == "P", lit(" FALSE")).otherwise(lit("false"))
    return table(spark, sf, "orders").select("o_orderkey", significance.same_boolean(old, new).alias("same"))


FIELD = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Region' WHEN '2-HIGH' THEN 'account_name'
  WHEN '3-MEDIUM' THEN 'domain' WHEN '4-NOT SPECIFIED' THEN 'AccountName' ELSE 'state' END"""


@check(
    "sig_ignore_fields",
    f"""SELECT o_orderkey, {FIELD} AS field_name FROM orders
        WHERE lower({FIELD}) NOT IN ('region', 'domain', 'accountname')""",
)
def sig_ignore_fields(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("o_orderpriority")
    name = (
        F.when(p == "1-URGENT", lit("Region")).when(p == "2-HIGH", lit("account_name")).when(p == "3-MEDIUM", lit("domain"))
        .when(p == "4-NOT SPECIFIED", lit("AccountName")).otherwise(lit("state"))
    )
    o = table(spark, sf, "orders").withColumn("field_name", name)
    return o.where(~significance.ignored_field(F.col("field_name"))).select("o_orderkey", "field_name")


@check(
    "sig_numeric",
    """SELECT o_orderkey, (floor(o_totalprice) = o_totalprice OR o_orderstatus = 'F') AND o_orderstatus <> 'P' AS same FROM orders""",
)
def sig_numeric(spark: SparkSession, sf: str) -> DataFrame:
    st, price = F.col("o_orderstatus"), F.col("o_totalprice")
    old = F.format_string("%.4f", price)
    new = F.when(st == "F", F.format_string("%.2f", price)).otherwise(text(F.floor(price)))
    field = F.when(st == "P", lit("port")).otherwise(lit("Execution_Duration"))
    return table(spark, sf, "orders").select("o_orderkey", significance.same_number(field, old, new).alias("same"))


@check(
    "sig_timestamp_1s",
    """SELECT event_id, event_type IN ('view', 'click') OR (event_type = 'error' AND epoch_us(ts) % 1000000 < 500000) AS same FROM events""",
)
def sig_timestamp_1s(spark: SparkSession, sf: str) -> DataFrame:
    """Views: offset dropped; clicks: seconds only; errors: half a second to a second away; else another field."""
    kind = F.col("event_type")
    full = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), lit("+05:00"))
    whole = F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd HH:mm:ss")
    later = F.date_format(
        F.date_trunc("second", "ts") + F.expr("INTERVAL '1.5' SECOND") - F.expr("INTERVAL '0.000001' SECOND"),
        "yyyy-MM-dd HH:mm:ss.SSSSSS",
    )
    micro = F.date_format("ts", "SSSSSS").cast("int")
    near = F.when(micro < 500000, full).otherwise(full)
    far = F.when(micro < 500000, whole).otherwise(
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    new = F.when(kind == "view", iso).when(kind == "click", whole).when(kind == "error", far).otherwise(later)
    field = F.when(kind.isin("view", "click", "error"), lit("last_modified")).otherwise(lit("state"))
    return table(spark, sf, "events").select("event_id", significance.same_second(field, near, new).alias("same"))


CELL_SQL = """
cells AS (
  SELECT o_orderkey, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS price FROM orders)
"""


@check(
    "sig_all",
    f"""WITH {CELL_SQL}
    SELECT o_orderkey, CASE st
      WHEN 'O' THEN pr NOT IN ('1-URGENT', '2-HIGH') WHEN 'F' THEN pr NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
      ELSE pr IN ('1-URGENT', '2-HIGH') END AS significant FROM cells""",
)
def sig_all(spark: SparkSession, sf: str) -> DataFrame:
    """All rules together, one kind of cell per status and priority.

    O: list reordered, tags only automatic, else state text. F: region, duration spelling, key order, else text.
    P: list lost an item, tag value changed, else booleans, sub-second times and reordered JSON arrays.
    """
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    a, b = text("o_custkey"), F.format_string("%.2f", F.col("o_totalprice"))

    def case(*rows: tuple[str, str, Column, Column, Column]) -> list[Column]:
        outs = []
        for pick in (2, 3, 4):
            col = F.lit(None).cast("string")
            for row in reversed(rows):
                col = F.when((st == row[0]) & (pr == row[1]), row[pick]).otherwise(col)
            outs.append(col)
        return outs

    auto = lit('{"aws:cloudformation:stack-id": "s", "owner": "')
    rows = [
        ("O", "1-URGENT", lit("SecurityGroups"), F.concat(lit("['"), a, lit("', '"), b, lit("']")), F.concat(b, lit(", "), a)),
        ("O", "2-HIGH", lit("tags"), F.concat(auto, a, lit('"}')), F.concat(lit("{'owner': '"), a, lit("'}"))),
        ("F", "1-URGENT", lit("region"), a, F.concat(a, lit("x"))),
        ("F", "2-HIGH", lit("execution_duration"), F.concat(b, lit("0")), b),
        (
            "F", "3-MEDIUM", lit("config"), F.concat(lit('{"a": 1, "b": "'), a, lit('"}')),
            F.concat(lit("{'b': '"), a, lit("', 'a': 1.0}")),
        ),
        ("P", "1-URGENT", lit("subnets"), F.concat(lit("{"), a, lit(","), b, lit("}")), a),
        ("P", "2-HIGH", lit("tags"), F.concat(auto, a, lit('"}')), F.concat(lit('{"owner": "'), b, lit('"}'))),
        ("P", "3-MEDIUM", lit("enabled"), lit("True"), lit("true")),
        ("P", "4-NOT SPECIFIED", lit("last_modified"), lit("2024-01-01 00:00:00.900000"), lit("2024-01-01T00:00:00Z")),
        ("P", "5-LOW", lit("triggers"), F.concat(lit('["'), a, lit('","'), b, lit('"]')), F.concat(lit('["'), b, lit('", "'), a, lit('"]'))),
    ]
    field, old, new = case(*rows)
    o = table(spark, sf, "orders", spread=True).select(
        "o_orderkey",
        F.coalesce(field, lit("state")).alias("field"),
        F.coalesce(old, a).alias("old"),
        F.coalesce(new, F.concat(a, lit("y"))).alias("new"),
    )
    result = significance.is_significant(F.col("field"), F.col("old"), F.col("new"))
    return o.select("o_orderkey", result.alias("significant"))


@check(
    "sig_tags",
    f"""WITH {CUST} SELECT id, key >= 5 AS same, false AS same_other_field FROM c""",
)
def sig_tags(spark: SparkSession, sf: str) -> DataFrame:
    old = F.concat(lit('{"aws:cloudformation:stack-name": "'), F.col("seg"), lit('", "owner": "'), F.col("name"), lit('"}'))
    new = F.concat(lit("{'owner': '"), F.col("alt"), lit("', 'aws:cloudformation:logical-id': 'L'}"))
    return cust(spark, sf).select(
        "id",
        significance.same_user_tags(lit("Tags"), old, new).alias("same"),
        significance.same_user_tags(lit("labels"), old, new).alias("same_other_field"),
    )


@check(
    "sig_json_object",
    """SELECT event_id, event_type NOT IN ('error', 'view') AS same FROM events""",
)
def sig_json_object(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks: numbers 1 and 1.0; signups: dict literal; purchases: key order; errors: other value; views: no JSON."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    old = F.concat(lit('{"k": '), k, lit(', "on": true, "s": "'), kind, lit('"}'))
    new = (
        F.when(kind == "click", F.concat(lit('{"k": '), k, lit('.0, "s": "click", "on": true}')))
        .when(kind == "signup", F.concat(lit("{'s': 'signup', 'k': "), k, lit(", 'on': True}")))
        .when(kind == "purchase", F.concat(lit('{"s":"purchase","on":true,"k":'), k, lit("}")))
        .when(kind == "error", F.concat(lit('{"s":"error","on":false,"k":'), k, lit("}")))
        .otherwise(F.concat(lit("{view "), k, lit("}")))
    )
    return table(spark, sf, "events").select("event_id", significance.same_json_object(old, new).alias("same"))


@check(
    "sig_json_array_set",
    f"""WITH {CUST} SELECT id, list_sort(list_distinct([seg, name])) = list_sort(list_distinct([alt, seg])) AS same_set,
      list_sort([seg, name, nat]) = list_sort([alt, nat, seg]) AS same_list, false AS same_multiset FROM c""",
)
def sig_json_array_set(spark: SparkSession, sf: str) -> DataFrame:
    c = cust(spark, sf)
    old, new = F.to_json(F.array("seg", "name")), F.to_json(F.array("alt", "seg", "alt"))
    braced = F.concat(lit("{'"), F.concat_ws("', '", "seg", "name", "nat"), lit("'}"))
    comma = F.concat_ws(" ,", "alt", "nat", "seg")
    return c.select(
        "id",
        significance.same_json_set(old, new).alias("same_set"),
        significance.same_field_list(lit("security_groups"), braced, comma).alias("same_list"),
        significance.same_field_list(lit("subnets"), old, new).alias("same_multiset"),
    )


@check(
    "json_or_literal",
    f"""WITH {CUST} SELECT id, CASE WHEN key < 5 THEN '{{"k":' || key || ',"s":"' || seg || '"}}'
        WHEN key < 10 THEN '{{"a":null,"k":true,"s":"' || seg || '"}}'
        WHEN key < 15 THEN '["' || seg || '","zz"]' WHEN key < 20 THEN '{{"a":[1,["' || seg || '"]],"b":{{"c":["x","y"],"it''s":null}}}}'
        ELSE NULL END AS document FROM c""",
)
def json_or_literal(spark: SparkSession, sf: str) -> DataFrame:
    key, seg = F.col("key"), F.col("seg")
    raw = (
        F.when(key < 5, F.concat(lit('{"s": "'), seg, lit('", "k": '), text(key), lit("}")))
        .when(key < 10, F.concat(lit("{'s': '"), seg, lit("', 'k': True, 'a': None}")))
        .when(key < 15, F.concat(lit("{'zz', '"), seg, lit("'}")))
        .when(key < 20, F.concat(lit("{'b': {\"it's\": None, 'c': {'y', 'x'},}, 'a': (1, ['"), seg, lit("'])}")))
        .otherwise(F.concat(lit("plain "), seg))
    )
    return cust(spark, sf).select("id", jsontext.canonical_json(raw).alias("document"))


# ---------------------------------------------------------------- scalars


@check(
    "human_bytes",
    """WITH s AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN n_chars * 0 WHEN doc_id % 5 = 1 THEN n_chars
         WHEN doc_id % 5 = 2 THEN n_chars * 1000 WHEN doc_id % 5 = 3 THEN n_chars * 1000000
         ELSE n_chars * 1000000000 END AS n FROM documents)
    SELECT doc_id, CASE WHEN n = 0 THEN '0 B' WHEN n >= 1099511627776 THEN printf('%.2f TB', n / 1099511627776.0::DOUBLE)
      WHEN n >= 1073741824 THEN printf('%.2f GB', n / 1073741824.0::DOUBLE)
      WHEN n >= 1048576 THEN printf('%.2f MB', n / 1048576.0::DOUBLE)
      WHEN n >= 1024 THEN printf('%.2f KB', n / 1024.0::DOUBLE) ELSE n || ' B' END AS size_text FROM s""",
)
def human_bytes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("doc_id") % 5
    factor = F.when(k == 0, 0).when(k == 1, 1).when(k == 2, 1000).when(k == 3, 1000000).otherwise(1000000000)
    return table(spark, sf, "documents").select(
        "doc_id", tx.human_bytes(F.col("n_chars") * factor.cast("long")).alias("size_text")
    )


@check(
    "ts_normalise",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'not a date' WHEN 'view' THEN NULL
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_text FROM events""",
)
def ts_normalise(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = (
        F.when(kind == "error", lit("not a date")).when(kind == "view", lit(""))
        .when(kind == "click", F.concat(iso, lit("Z"))).when(kind == "signup", F.concat(iso, lit("+02:00")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return table(spark, sf, "events").select("event_id", dates.micros_text(raw).alias("ts_text"))


@check(
    "ts_format_utc",
    """SELECT event_id, CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC'
         WHEN 'signup' THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') || ' UTC'
         WHEN 'error' THEN 'someday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text FROM events""",
)
def ts_format_utc(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = (
        F.when(kind == "click", F.concat(iso, lit("Z"))).when(kind == "signup", F.concat(iso, lit("+02:00")))
        .when(kind == "error", lit("someday")).otherwise(iso)
    )
    return table(spark, sf, "events").select("event_id", dates.utc_text(raw).alias("ts_text"))


@check(
    "truncate_default",
    """SELECT doc_id, left(text, 500) AS description, CASE WHEN lang = 'en' THEN 'N/A' ELSE lang END AS lang_or,
         CASE WHEN source = 'src0' THEN 'N/A' ELSE source END AS source_or, right(text, 50) AS tail FROM documents""",
)
def truncate_default(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    lang = F.when(F.col("lang") != "en", F.col("lang"))
    source = F.when(F.col("source") == "src0", lit("")).otherwise(F.col("source"))
    return d.select(
        "doc_id",
        tx.clip(F.col("text"), 500).alias("description"),
        tx.or_default(lang).alias("lang_or"),
        tx.or_default_blank(source).alias("source_or"),
        tx.last_chars(F.col("text"), 50).alias("tail"),
    )


@check(
    "last_segment",
    """SELECT page_id, string_split(url, '/')[-1] AS last_part, string_split(url, '.')[1] AS first_part,
         left(url, 10) AS prefix FROM pages""",
)
def last_segment(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id",
        tx.last_segment(F.col("url"), "/").alias("last_part"),
        tx.first_segment(F.col("url"), ".").alias("first_part"),
        tx.clip(F.col("url"), 10).alias("prefix"),
    )


@check(
    "first_table_after_from",
    """SELECT n_nationkey, CASE WHEN n_regionkey IN (0, 1) THEN 'DB.' || upper(n_name) ELSE 'N/A' END AS table_name FROM nation""",
)
def first_table_after_from(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("n_regionkey")
    query = (
        F.when(r == 0, F.concat(lit("select a from db."), "n_name", lit(" where x = 1")))
        .when(r == 1, F.concat(lit("SELECT *\nFROM\n  Db."), "n_name", lit("\njoin (select 1 from z)")))
        .when(r == 2, F.concat(lit("show tables in "), "n_name"))
        .otherwise(F.concat(lit("select "), "n_name", lit(" from ")))
    )
    return table(spark, sf, "nation").select("n_nationkey", tx.first_table(query).alias("table_name"))


@check(
    "distinct_prefix_floor",
    """WITH n AS (SELECT o_orderkey, [o_orderpriority, o_orderstatus || '-1', o_orderstatus || '-2', ''] AS names FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN
      greatest(1, len(list_distinct([string_split(x, '-')[1] for x in names if x <> '']))) ELSE 1 END AS triggers FROM n""",
)
def distinct_prefix_floor(spark: SparkSession, sf: str) -> DataFrame:
    st = F.col("o_orderstatus")
    names = F.array(F.col("o_orderpriority"), F.concat(st, lit("-1")), F.concat(st, lit("-2")), lit(""))
    kept = F.when(F.col("o_orderkey") % 2 == 0, names).otherwise(F.array(lit("")))
    return table(spark, sf, "orders").select("o_orderkey", distinct_prefixes(kept, 10).alias("triggers"))


# ---------------------------------------------------------------- tags, flags, labels


def tags(spark: SparkSession, sf: str) -> DataFrame:
    def tag(k: str, v: Column) -> Column:
        return F.struct(lit(k).alias("Key"), v.alias("Value"))

    c = cust(spark, sf)
    listed = F.array(
        tag("Owner", F.col("seg")), tag("Name", F.col("name")), tag("Name", F.col("nat")), tag("AppId", F.col("alt"))
    )
    return c.withColumn("tags", F.when(F.col("key") < 20, listed))


@check(
    "tag_lookup",
    f"""WITH {CUST} SELECT id, CASE WHEN key < 20 THEN name ELSE 'N/A' END AS tag_name, 'N/A' AS tag_missing FROM c""",
)
def tag_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return tags(spark, sf).select(
        "id", tx.tag_value(F.col("tags"), "Name").alias("tag_name"), tx.tag_value(F.col("tags"), "Cost").alias("tag_missing")
    )


@check(
    "tag_map_last_wins",
    f"""WITH {CUST} SELECT id, CASE WHEN key < 20 THEN nat ELSE 'N/A' END AS tag_name,
          CASE WHEN key < 20 THEN alt ELSE 'N/A' END AS app_id FROM c""",
)
def tag_map_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return tags(spark, sf).select(
        "id", tx.tag_value_last(F.col("tags"), "Name").alias("tag_name"), tx.tag_value_last(F.col("tags"), "AppId").alias("app_id")
    )


@check(
    "tag_drop_auto",
    f"""WITH {CUST} SELECT id, 'owner=' || name || ',team=' || seg AS kept, CAST(2 AS BIGINT) AS n FROM c""",
)
def tag_drop_auto(spark: SparkSession, sf: str) -> DataFrame:
    m = F.create_map(
        lit("team"), F.col("seg"), lit("aws:cloudformation:stack-name"), F.col("nat"), lit("owner"), F.col("name"),
        lit("aws:cloudformation:logical-id"), F.col("alt"),
    )
    kept = F.array_sort(F.map_entries(significance.drop_automatic_tags(m)))
    shown = F.array_join(F.transform(kept, lambda e: F.concat(e["key"], lit("="), e["value"])), ",")
    return cust(spark, sf).select("id", shown.alias("kept"), tx.count_of(kept).alias("n"))


@check(
    "presence_flags",
    """SELECT p_partkey, CASE WHEN p_size > 40 AND p_retailprice > 1000 THEN 'Lambda,SNS' WHEN p_size > 40 THEN 'Lambda'
         WHEN p_retailprice > 1000 THEN 'SNS' ELSE 'None' END AS integrations,
         CASE WHEN p_size > 40 THEN 'Enabled' ELSE 'Disabled' END AS replication FROM part""",
)
def presence_flags(spark: SparkSession, sf: str) -> DataFrame:
    big = F.when(F.col("p_size") > 40, F.array("p_name"))
    costly = F.when(F.col("p_retailprice") > 1000, F.array("p_brand"))
    none = F.expr("cast(array() as array<string>)")
    labels = tx.flags(("Lambda", tx.count_of(big) > 0), ("SQS", tx.count_of(none) > 0), ("SNS", tx.count_of(costly) > 0))
    return table(spark, sf, "part").select(
        "p_partkey",
        tx.join_or(labels, "None", ",").alias("integrations"),
        F.when(tx.count_of(big) > 0, lit("Enabled")).otherwise(lit("Disabled")).alias("replication"),
    )


@check(
    "security_summary",
    f"""WITH {CUST} SELECT id, CASE WHEN key < 5 THEN 'Config: ' || seg || ', IAM: ' || nat || ', Security Groups: Configured'
      WHEN key < 10 THEN 'IAM: ' || nat WHEN key < 15 THEN 'Security Groups: Configured' ELSE 'Default' END AS summary FROM c""",
)
def security(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("key")
    config = F.when(key < 5, F.col("seg")).when(key < 20, lit("N/A"))
    profile = F.when(key < 10, F.concat(lit("arn:aws:iam::1:instance-profile/"), "nat"))
    group = F.when((key < 5) | ((key >= 10) & (key < 15)), lit("sg-1"))
    return cust(spark, sf).select("id", security_summary(config, profile, group).alias("summary"))


@check(
    "policy_triggers",
    f"""WITH {CUST} SELECT id, CASE WHEN key < 5 THEN '["s3 → arn:' || name || '","events"]' WHEN key < 10 THEN '["events"]'
      ELSE '["Sin triggers"]' END AS triggers FROM c""",
)
def triggers(spark: SparkSession, sf: str) -> DataFrame:
    """Bucket and schedule statements, a schedule next to a public principal, only public, and no policy at all."""
    key = F.col("key")
    s3 = F.concat(
        lit('{"Principal": {"Service": "s3.amazonaws.com"}, "Condition": {"ArnLike": {"AWS:SourceArn": "arn:'),
        F.col("name"), lit('"}}}'),
    )
    schedule, public = lit('{"Principal": {"Service": "events.amazonaws.com"}}'), lit('{"Principal": "*"}')

    def policy(*parts: Column) -> Column:
        return F.concat(lit('{"Version": "1", "Statement": ['), F.concat_ws(", ", *parts), lit("]}"))

    doc = F.when(key < 5, policy(s3, schedule)).when(key < 10, policy(public, schedule)).when(key < 15, policy(public))
    return cust(spark, sf).select("id", policy_triggers(doc).alias("triggers"))


@check(
    "classify_case",
    """SELECT o_orderkey,
      CASE o_orderstatus WHEN 'O' THEN 'ETL' WHEN 'F' THEN 'Python Shell' ELSE 'Streaming' END AS job_type,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Visual' WHEN '2-HIGH' THEN 'Notebook' WHEN '3-MEDIUM' THEN 'Script'
        WHEN '4-NOT SPECIFIED' THEN 'Script' ELSE 'Visual' END AS created_by,
      CASE o_orderstatus WHEN 'O' THEN 'Extended - Ends Feb 25, 2026' WHEN 'F' THEN 'Standard - Ends N/A' ELSE 'Standard' END AS support,
      CASE WHEN o_orderstatus = 'O' THEN 'S3' ELSE 'Custom' END AS origin,
      CASE o_orderstatus WHEN 'O' THEN 'VPC: v' || o_custkey || ', Subnets: 2' WHEN 'F' THEN 'VPC Endpoint: N/A' ELSE 'Public' END AS endpoint,
      CASE WHEN o_orderstatus = 'O' THEN 'Default + 3 custom behaviors' ELSE 'Default only' END AS behaviors FROM orders""",
)
def classify_case(spark: SparkSession, sf: str) -> DataFrame:
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    command = F.when(st == "O", lit("other")).when(st == "F", lit("pythonshell")).otherwise(lit("gluestreaming"))
    nodes = F.when(pr == "1-URGENT", F.create_map(lit("n"), st))
    script = F.when(pr == "2-HIGH", lit("s3://b/x.ipynb")).when(pr == "3-MEDIUM", lit("s3://b/x.py"))
    catalog = F.when(pr == "4-NOT SPECIFIED", lit("true"))
    version = F.when(st == "O", lit("1.32")).when(st == "F", lit("1.20"))
    domain = F.when(st == "O", lit("b.s3.amazonaws.com")).otherwise(lit("example.com"))
    kind = F.when(st == "O", lit("VPC")).when(st == "F", lit("VPC_ENDPOINT")).otherwise(lit("PUBLIC"))
    vpc = F.concat(lit("v"), text("o_custkey"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        data.job_type(command).alias("job_type"),
        data.job_creator(nodes, script, catalog).alias("created_by"),
        compute.support_text(version, F.when(st == "O", lit("EXTENDED"))).alias("support"),
        network.origin_type(domain).alias("origin"),
        network.endpoint_text(kind, vpc, F.array(st, pr), F.lit(None).cast("string")).alias("endpoint"),
        network.behaviors_text(F.when(st == "O", F.lit(3)).otherwise(F.lit(0))).alias("behaviors"),
    )
