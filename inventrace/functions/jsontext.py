"""JSON held in text columns, with a second reading for Python-literal text.

``canonical_json`` returns text whose equality means "same document": keys sorted, spacing removed,
1 and 1.0 alike (Spark's VARIANT normalises all three). Text that is neither JSON nor a literal gives null, and callers then compare it as plain text.

Literals are read by tokens: dicts, lists, tuples and sets in any nesting, strings in both quotes with their escapes, numbers, ``True``,
``False``, ``None`` and trailing commas. Tuples become arrays, sets arrays of their distinct items in order. A bracketed
scalar counts as a tuple of one; strings side by side, prefixes (``b'..'``) and calls are no documents here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inventrace.functions.text import strip

STRICT = {"allowSingleQuotes": "false"}
#: Strings, brackets and separators, bare words, and any other character (which makes the text no literal).
TOKEN = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[\[\]{}(),:]|[^\s\[\]{}(),:'"]+|\S"""
#: Within a string: escapes, a double quote, and runs of other characters.
ATOM = r"""\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\(?:.|\n)|"|[^\\"]+"""
QUOTED = r"""(?s)^('.*'|".*")$"""
SCALAR = r"^(-?[0-9.eE+-]+|true|false|null)$"
#: What atoms and bare words of a literal are in JSON.
ATOMS = {'"': '\\"', "\\'": "'", "\\\n": "", "\\a": "\\u0007", "\\v": "\\u000b", "\\0": "\\u0000"}
WORDS = {"True": "true", "False": "false", "None": "null"}

#: A literal's text ``p.text`` -> JSON text, with the patterns as fields of ``p``. One frame per open bracket, innermost last: the finished items, the
#: one at work and whether it has keys. The state is null once the text cannot be a literal, and a finished document leaves one frame.
_FRAME = "named_struct('open', {0}, 'items', {1}, 'item', {2}, 'keyed', {3})"
_NEW = _FRAME.format("{0}", "cast(array() as array<string>)", "''", "false")


def _put(items: str, item: str, keyed: str, frame: str = "s.top", under: str = "s.under") -> str:
    return f"concat({under}, array({_FRAME.format(frame + '.open', items, item, keyed)}))"


_STRING = r"""concat('"', array_join(transform(regexp_extract_all(substr(token, 2, length(token) - 2), p.atom, 0), a ->
  CASE WHEN map_contains_key(p.atoms, a) THEN p.atoms[a] WHEN a LIKE r'\\x%' THEN concat(r'\u00', substr(a, 3)) WHEN a RLIKE p.odd THEN concat(chr(92), a)
  ELSE replace(replace(replace(a, chr(10), concat(chr(92), 'n')), chr(9), concat(chr(92), 't')), chr(13), concat(chr(92), 'r')) END), ''), '"')"""
_CLOSED = """CASE WHEN s.top.open = '{' AND (s.top.keyed OR size(s.filled) = 0) THEN concat('{', array_join(s.filled, ','), '}')
  WHEN s.top.open = '{' THEN concat('[', array_join(array_sort(array_distinct(s.filled)), ','), ']') ELSE concat('[', array_join(s.filled, ','), ']') END"""
_STEP = f"""CASE WHEN size(s.stack) = 1 AND s.top.item <> '' THEN null
  WHEN token IN ('{{', '[', '(') THEN concat(s.stack, array({_NEW.format('token')}))
  WHEN token IN ('}}', ']', ')') THEN CASE WHEN size(s.stack) > 1 AND s.top.open = translate(token, '}})]', '{{([') THEN
    {_put('s.outer.items', f'concat(s.outer.item, {_CLOSED})', 's.outer.keyed', 's.outer', 'slice(s.under, 1, size(s.under) - 1)')} END
  WHEN token = ',' THEN CASE WHEN s.top.item <> '' AND size(s.stack) > 1 THEN {_put('concat(s.top.items, array(s.top.item))', "''", 's.top.keyed')} END
  WHEN token = ':' THEN CASE WHEN s.top.open = '{{' AND s.top.item <> '' THEN
    {_put('s.top.items', "concat(CASE WHEN s.top.item RLIKE p.scalar THEN concat(chr(34), s.top.item, chr(34)) ELSE s.top.item END, ':')", 'true')} END
  WHEN token RLIKE p.quoted THEN {_put('s.top.items', f'concat(s.top.item, {_STRING})', 's.top.keyed')}
  ELSE {_put('s.top.items', 'concat(s.top.item, coalesce(p.words[token], token))', 's.top.keyed')} END"""
_VIEW = """transform(array(named_struct('stack', stack, 'top', element_at(stack, -1), 'under', slice(stack, 1, size(stack) - 1))), v ->
  named_struct('stack', v.stack, 'top', v.top, 'under', v.under, 'outer', try_element_at(v.under, -1),
    'filled', CASE WHEN v.top.item <> '' THEN concat(v.top.items, array(v.top.item)) ELSE v.top.items END))[0]"""
_READ = rf"""p -> CASE WHEN p.text RLIKE r'^[\[{{(]' THEN transform(array(
  aggregate(regexp_extract_all(p.text, p.token, 0), array({_NEW.format("''")}), (stack, token) -> transform(array({_VIEW}), s -> {_STEP})[0])),
  f -> CASE WHEN size(f) = 1 THEN f[0].item END)[0] END"""


def literal_to_json(text: Column) -> Column:
    """Python-literal text rewritten as JSON text, null when its brackets do not fit. What stands in it is for a JSON parser to judge."""
    fixed = {"token": TOKEN, "atom": ATOM, "quoted": QUOTED, "scalar": SCALAR, "odd": r'^\\[^\\"bfnrtux]'}
    tables = {"atoms": ATOMS, "words": WORDS}
    maps = [F.create_map(*[F.lit(x) for kv in t.items() for x in kv]).alias(n) for n, t in tables.items()]
    given = F.struct(text.alias("text"), *[F.lit(v).alias(n) for n, v in fixed.items()], *maps)
    return F.element_at(F.call_function("transform", F.array(given), F.expr(_READ)), 1)


def _canonical(text: Column) -> Column:
    return F.to_json(F.try_parse_json(text))


def canonical_json(text: Column) -> Column:
    """Canonical JSON of JSON or Python-literal text, null when it is neither."""
    t = strip(text)
    return F.coalesce(_canonical(t), _canonical(literal_to_json(t)))


def json_map(text: Column) -> Column:
    """JSON object (or dict literal) as ``map<string,string>``; null when it is not one."""
    return F.from_json(canonical_json(text), "map<string,string>")


def json_list(text: Column) -> Column:
    """JSON array as ``array<string>``; nested objects stay JSON text. Null when it is not one."""
    return F.from_json(strip(text), "array<string>", STRICT)


def list_items(text: Column) -> Column:
    """List text in any of its spellings -> sorted array of normalised, non-blank items.

    Spellings: JSON array, list literal, ``{a, b}``, set or dict literal, comma-separated text.
    """
    t = strip(F.coalesce(text, F.lit("")))
    inner = F.substr(t, F.lit(2), F.length(t) - 2)
    is_list = F.startswith(t, F.lit("[")) & F.endswith(t, F.lit("]"))
    is_braced = F.startswith(t, F.lit("{")) & F.endswith(t, F.lit("}"))

    def braced(literal: Column) -> Column:
        """Items of a set; a dict is one item."""
        document = F.coalesce(_canonical(t), _canonical(literal))
        return F.coalesce(F.from_json(literal, "array<string>", STRICT), F.when(document.isNotNull(), F.array(document)), F.split(inner, ","))

    items = (
        F.when(is_list, F.coalesce(json_list(t), F.from_json(literal_to_json(t), "array<string>", STRICT), F.split(t, ",")))
        .when(is_braced, F.element_at(F.transform(F.array(literal_to_json(t)), braced), 1))
        .otherwise(F.split(t, ","))
    )
    return F.array_sort(F.filter(F.transform(items, list_element), lambda x: x != ""))


def list_element(item: Column) -> Column:
    """One list item: objects with sorted keys, everything else trimmed."""
    text = strip(F.coalesce(item, F.lit("None")))
    return F.when(F.startswith(text, F.lit("{")), F.coalesce(_canonical(text), text)).otherwise(text)


def json_to_literal(json_text: Column) -> Column:
    """Compact JSON object text printed the way ``str(dict)`` prints it (shallow objects)."""
    t = F.replace(json_text, F.lit('"'), F.lit("'"))
    t = F.regexp_replace(t, "':", "': ")
    t = F.regexp_replace(t, ",'", ", '")
    for word, repl in (("true", "True"), ("false", "False"), ("null", "None")):
        t = F.regexp_replace(t, rf"(?<=[:\[,] ?){word}(?=[\]\}},])", repl)
    return t
