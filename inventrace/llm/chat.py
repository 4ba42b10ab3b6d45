"""Chat formatting: a small template language is parsed to a tree, folded, and turned into closures that render conversations.

The language: literal text, ``{{ expression }}``, ``{% for m in messages %} ... {% endfor %}`` (with loop.index, loop.first and
loop.last), ``{% if %} / {% elif %} / {% else %} / {% endif %}``, ``{% set name = expression %}``, ``{% generation %} ...
{% endgeneration %}`` around what a model shall learn, and ``{# comments #}``. Expressions have strings, whole numbers, true, false,
none, names, ``a.key``, ``==  !=  <  <=  >  >=  in``, ``+  ~``, ``and  or  not``, parentheses and the filters of ``FILTERS``. It is a
sandbox: there are no calls, no indexing, no access to Python attributes, and ``messages`` can be walked through once only.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that mean something in a formatted conversation; inside texts each gets a backslash, as each backslash does.
CONTROLS = ("<turn>", "<text>", "</turn>")
TEMPLATE = (
    "{% for m in messages %}<turn>{{ m.role | escape }}<text>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "</turn>\n{% endfor %}"
)
#: A conversation's output is cut into parts of about this many characters.
PART_CHARS = 1 << 20

_CONTROL = "|".join(map(re.escape, CONTROLS))
_TO_ESCAPE = re.compile(rf"\\|{_CONTROL}")
_ESCAPED = re.compile(rf"\\(\\|{_CONTROL})")
_MARK = re.compile(rf"\\(?:\\|{_CONTROL})|{_CONTROL}")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template is not of the language."""


# --- tree -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: str


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Show:
    value: Any


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parser ---------------------------------------------------------------------------------------------------------

_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>().|=]))", re.S)
_WORDS = {"true": True, "false": False, "none": None}
_ESCAPES = {"n": "\n", "t": "\t"}
_COMPARE = {"==", "!=", "<", "<=", ">", ">=", "in"}


@dataclass
class _Expression:
    """Recursive descent over one expression's tokens, loosest operator first."""

    tokens: list[tuple[str, str]]
    at: int = 0

    @classmethod
    def read(cls, source: str) -> _Expression:
        tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        return cls(tokens)

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][1] in values and self.tokens[self.at][0] != "str":
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name" or self.tokens[self.at][1] in {*_WORDS, "and", "or", "not", "in"}:
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Any:
        found = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Op("or", (left, self.both()))
        return left

    def both(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Op("and", (left, self.negated()))
        return left

    def negated(self) -> Any:
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.joined()
        while op := self.take(*_COMPARE):
            left = Op(op, (left, self.joined()))
        return left

    def joined(self) -> Any:
        left = self.filtered()
        while op := self.take("+", "~"):
            left = Op(op, (left, self.filtered()))
        return left

    def filtered(self) -> Any:
        value = self.keyed()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Op(f"|{name}", (value,))
        return value

    def keyed(self) -> Any:
        value = self.single()
        while self.take("."):
            value = Key(value, self.name())
        return value

    def single(self) -> Any:
        if self.take("("):
            value = self.either()
            if not self.take(")"):
                raise TemplateError("a ) is missing")
            return value
        if self.at < len(self.tokens):
            kind, text = self.tokens[self.at]
            if kind == "str":
                self.at += 1
                return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
            if kind == "int":
                self.at += 1
                return Const(int(text))
            if kind == "name" and text in _WORDS:
                self.at += 1
                return Const(_WORDS[text])
        return Name(self.name())


@dataclass
class _Parser:
    pieces: list[tuple[str, str]]
    at: int = 0
    walks: int = 0
    closing: str = ""
    inside: list[str] = field(default_factory=list)

    def block(self, *ends: str) -> tuple:
        """Nodes up to one of the tags ``ends``, which is left in ``closing``."""
        nodes: list[Any] = []
        while self.at < len(self.pieces):
            kind, source = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(Show(Const(source)))
                continue
            if kind == "show":
                nodes.append(Show(_Expression.read(source).whole()))
                continue
            word, _, rest = source.strip().partition(" ")
            if word in ends:
                self.closing = source.strip()
                return tuple(nodes)
            nodes.append(self.tag(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes)

    def tag(self, word: str, rest: str) -> Any:
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
            if not m or m[1] in {"loop", "messages"} or self.inside or self.walks:
                raise TemplateError("one loop, over messages, outside of other blocks, is all there can be")
            self.walks += 1
            return For(m[1], self.within("for", "endfor"))
        if word == "if":
            test = _Expression.read(rest).whole()
            self.inside.append("if")
            node = self.branches(test)
            self.inside.pop()
            return node
        if word == "set":
            e = _Expression.read(rest)
            name = e.name()
            if not e.take("="):
                raise TemplateError("set needs a =")
            return Set(name, e.whole())
        if word == "generation" and not rest.strip():
            if "generation" in self.inside:
                raise TemplateError("generation inside generation")
            return Generation(self.within("generation", "endgeneration"))
        raise TemplateError(f"no tag {word!r}")

    def within(self, word: str, end: str) -> tuple:
        self.inside.append(word)
        body = self.block(end)
        self.inside.pop()
        return body

    def branches(self, test: Any) -> If:
        then = self.block("elif", "else", "endif")
        if self.closing == "endif":
            return If(test, then, ())
        if self.closing == "else":
            return If(test, then, self.block("endif"))
        return If(test, then, (self.branches(_Expression.read(self.closing.removeprefix("elif")).whole()),))


def parse(template: str) -> tuple:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _PIECE.finditer(template):
        if m.start() > at:
            pieces.append(("text", template[at : m.start()]))
        if m[1] is not None:
            pieces.append(("show", m[1]))
        elif m[2] is not None:
            pieces.append(("tag", m[2]))
        at = m.end()
    if at < len(template):
        pieces.append(("text", template[at:]))
    return _Parser(pieces).block()


# --- folding --------------------------------------------------------------------------------------------------------


def _text(value: Any) -> str:
    return "" if value is None else ("true" if value else "false") if isinstance(value, bool) else str(value)


_DO: dict[str, Callable[..., Any]] = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda a, b: _text(a) in _text(b),
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "~": lambda a, b: _text(a) + _text(b),
    "not": operator.not_,
    **{f"|{name}": (lambda f: lambda a: f(_text(a)))(f) for name, f in FILTERS.items()},
}


def _folded(node: Any) -> Any:
    """An expression with all that is known beforehand worked out."""
    if isinstance(node, Key):
        return Key(_folded(node.of), node.key)
    if not isinstance(node, Op):
        return node
    args = tuple(map(_folded, node.args))
    if node.op in {"and", "or"} and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
    if node.op in _DO and all(isinstance(a, Const) for a in args):
        return Const(_DO[node.op](*(a.value for a in args)))
    return Op(node.op, args)


def fold(nodes: tuple) -> tuple:
    """The tree with constant expressions worked out, dead branches gone and neighbouring literal text joined."""
    out: list[Any] = []
    for node in nodes:
        new: tuple = (node,)
        if isinstance(node, Show):
            new = (Show(_folded(node.value)),)
        elif isinstance(node, Set):
            new = (Set(node.name, _folded(node.value)),)
        elif isinstance(node, For):
            new = (For(node.name, fold(node.body)),)
        elif isinstance(node, Generation):
            new = (Generation(fold(node.body)),)
        elif isinstance(node, If):
            test = _folded(node.test)
            then, other = fold(node.then), fold(node.other)
            new = (then if test.value else other) if isinstance(test, Const) else (If(test, then, other),)
        for n in new:
            if isinstance(n, Show) and isinstance(n.value, Const):
                n = Show(Const(_text(n.value.value)))
                if out and isinstance(out[-1], Show) and isinstance(out[-1].value, Const):
                    n = Show(Const(out.pop().value.value + n.value.value))
            out.append(n)
    return tuple(out)


# --- closures -------------------------------------------------------------------------------------------------------

Env = dict[str, Any]
Render = Callable[[Env], Iterator[tuple[str, bool]]]


def _value(node: Any) -> Callable[[Env], Any]:
    if isinstance(node, Const):
        return lambda env: node.value
    if isinstance(node, Name):
        return lambda env: env.get(node.name)
    if isinstance(node, Key):
        of = _value(node.of)

        def key(env: Env) -> Any:
            got = of(env)
            return got.get(node.key) if type(got) is dict else None

        return key
    args = [_value(a) for a in node.args]
    if node.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.op == "or":
        return lambda env: args[0](env) or args[1](env)
    do = _DO[node.op]
    if len(args) == 1:
        return lambda env: do(args[0](env))
    return lambda env: do(args[0](env), args[1](env))


def _closure(node: Any, learned: bool) -> Render:
    if isinstance(node, Show):
        value = _value(node.value)

        def show(env: Env) -> Iterator[tuple[str, bool]]:
            yield _text(value(env)), learned

        return show
    if isinstance(node, Set):
        value = _value(node.value)

        def put(env: Env) -> Iterator[tuple[str, bool]]:
            env[node.name] = value(env)
            return iter(())

        return put
    if isinstance(node, If):
        test, then, other = _value(node.test), _sequence(node.then, learned), _sequence(node.other, learned)
        return lambda env: then(env) if test(env) else other(env)
    if isinstance(node, Generation):
        return _sequence(node.body, True)
    body = _sequence(node.body, learned)

    def walk(env: Env) -> Iterator[tuple[str, bool]]:
        rows, index = iter(env["messages"]), 0
        row = next(rows, None)
        while row is not None:
            after = next(rows, None)
            index += 1
            env[node.name], env["loop"] = row, {"index": index, "first": index == 1, "last": after is None}
            yield from body(env)
            row = after

    return walk


def _sequence(nodes: tuple, learned: bool) -> Render:
    parts = [_closure(n, learned) for n in nodes]

    def run(env: Env) -> Iterator[tuple[str, bool]]:
        for part in parts:
            yield from part(env)

    return run


def compile_template(template: str) -> Callable[[Iterator[dict[str, str]]], Iterator[tuple[str, bool]]]:
    """Messages to (text, whether it is learned) pieces, one after the other; messages are read as they are needed."""
    run = _sequence(fold(parse(template)), False)
    return lambda messages: run({"messages": messages})


# --- Spark ----------------------------------------------------------------------------------------------------------

PARTS = "conv_id long, part long, text string, learned array<struct<start: long, end: long>>"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    for batch in batches:
        for at in range(0, len(batch), 1024):
            yield from batch.slice(at, 1024).to_pylist()


def _runs(rows: Iterator[dict[str, Any]], key: str) -> Iterator[tuple[Any, Iterator[dict[str, Any]]]]:
    """Neighbouring rows with one key, as a stream inside the stream."""
    from itertools import groupby

    return groupby(rows, key=lambda r: r[key])


def format_conversations(turns: DataFrame, template: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, text, learned) from rows (conv_id, turn, role, text): the formatted conversations in parts.

    ``learned`` holds the code-point spans of a part that stand inside generation marks. Turns follow by turn, null first; ties
    by role, then text. Null roles and texts count as empty, a null conv_id is a conversation of its own, and repeated rows
    are repeated turns. Rows of a conversation meet in one task, sorted by Spark, and stream through the template: the task holds one
    turn and one part. Other columns of ``turns`` are not read.
    """
    compile_template(template)  # errors belong to the caller

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        ready: list[tuple] = []
        size = 0
        for conv, rows in _runs(_rows(batches), "conv_id"):
            messages = ({"role": r["role"] or "", "text": r["text"] or ""} for r in rows)
            part, texts, spans, at = 0, [], [], 0
            for text, learned in render(messages):
                if learned and text:
                    if spans and spans[-1]["end"] == at:
                        spans[-1]["end"] = at + len(text)
                    else:
                        spans.append({"start": at, "end": at + len(text)})
                texts.append(text)
                at += len(text)
                if at >= part_chars:
                    yield _parts([*ready, (conv, part, "".join(texts), spans)])
                    ready, size, part, texts, spans, at = [], 0, part + 1, [], [], 0
            ready.append((conv, part, "".join(texts), spans))
            size += at
            if size >= part_chars:
                yield _parts(ready)
                ready, size = [], 0
        if ready:
            yield _parts(ready)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, PARTS)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    conv, part, text, learned = zip(*rows, strict=True)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(part, pa.int64()), pa.array(text), pa.array(learned, span)], ["conv_id", "part", "text", "learned"])


def read_turns(texts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation that comes in parts."""
    left = ""
    for more in texts:
        left += more
        done = role_at = text_at = 0
        for m in _MARK.finditer(left):
            if m[0] == "<turn>":
                role_at = m.end()
            elif m[0] == "<text>":
                text_at = m.end()
                role = left[role_at : m.start()]
            elif m[0] == "</turn>":
                yield unescape(role), unescape(left[text_at : m.start()])
                done = m.end()
        left = left[done:]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation what its formatted parts say: turns, learned text and length. Parts may come in any order: they are sorted first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        for conv, rows in _runs(_rows(batches), "conv_id"):
            turns, loss, n_turns, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

            def texts(rows=rows) -> Iterator[str]:
                nonlocal n_loss, n_chars
                for r in rows:
                    n_chars += len(r["text"])
                    for span in r["learned"]:
                        own = unescape(r["text"][span["start"] : span["end"]])
                        n_loss += len(own)
                        loss.update(own.encode())
                    yield r["text"]

            for role, text in read_turns(texts()):
                n_turns += 1
                turns.update(f"{role}\n{text}\n".encode())
            ready.append((conv, n_turns, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars))
            if len(ready) >= 1024:
                yield _digests(ready)
                ready = []
        if ready:
            yield _digests(ready)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, DIGESTS)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
