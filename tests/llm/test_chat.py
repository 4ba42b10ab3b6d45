"""Chat formatting."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from inventrace.llm import chat

NASTY = st.lists(st.sampled_from(["\\", "<", ">", "/", "<turn>", "<text>", "</turn>", "a", "\n", "é", "😀"])).map("".join)


@given(NASTY)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text


@given(st.lists(st.tuples(NASTY, NASTY), max_size=5), st.integers(1, 9))
def test_turns_are_read_from_parts_of_any_size(turns, size):
    render = chat.compile_template(chat.TEMPLATE)
    whole = "".join(t for t, _ in render({"role": r, "text": t} for r, t in turns))
    parts = [whole[i : i + size] for i in range(0, len(whole), size)]
    assert list(chat.read_turns(iter([whole]))) == turns
    assert list(chat.read_turns(iter(_whole_marks(parts)))) == turns


def _whole_marks(parts):
    """Parts joined so that none ends inside a mark; formatted parts end where a template piece ends."""
    held = ""
    for p in parts:
        held += p
        if held.endswith("</turn>\n") and not held.endswith("\\</turn>\n"):
            yield held
            held = ""
    if held:
        yield held


def text(template, *messages):
    return "".join(t for t, _ in chat.compile_template(template)(iter(messages)))


@pytest.mark.parametrize(
    "template,want",
    [
        ("a{# no #}b", "ab"),
        ("{{ 'x' ~ 1 + 2 }}", "x12"),
        ("{{ 1 + 2 }}", "3"),
        ("{% if 1 == 1 and not false %}y{% else %}n{% endif %}", "y"),
        ("{% if none %}a{% elif 'b' in 'abc' %}b{% else %}c{% endif %}", "b"),
        ("{% set a = 'q' | upper %}{{ a }}", "Q"),
        ("{{ ' x ' | trim }}|{{ missing }}|{{ missing.key }}", "x||"),
        ("{{ \"a\\\"b\\n\" }}", 'a"b\n'),
        ("{% for m in messages %}{{ loop.index }}{{ m.role }}{% if not loop.last %},{% endif %}{% endfor %}", "1u,2a"),
        ("{% for m in messages %}{% if loop.first %}[{% endif %}{% endfor %}", "["),
    ],
)
def test_language(template, want):
    assert text(template, {"role": "u", "text": "1"}, {"role": "a", "text": "2"}) == want


@pytest.mark.parametrize(
    "template",
    ["{{ x() }}", "{{ x[0] }}", "{{ m | system }}", "{% for m in other %}{% endfor %}", "{% if 1 %}", "{% else %}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{% import os %}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{{ 'a' 'b' }}", "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}"],
)
def test_what_is_not_of_the_language(template):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(template)


def test_sandbox_sees_only_keys():
    assert text("{% for m in messages %}{{ m.__class__ }}{{ m.text.upper }}{% endfor %}", {"role": "u", "text": "x"}) == ""


def test_constants_are_folded():
    tree = chat.fold(chat.parse("a{{ 'b' ~ 'c' | upper }}{% if 1 < 2 %}d{% else %}{{ x }}{% endif %}{% if 'z' == x %}e{{ 1 + 1 }}{% endif %}"))
    assert tree[0] == chat.Show(chat.Const("abCd"))
    assert tree[1].then == (chat.Show(chat.Const("e2")),) and len(tree) == 2


def test_generation_marks_what_is_learned():
    render = chat.compile_template("a{% generation %}b{{ 'c' }}{% endgeneration %}d")
    assert [(t, g) for t, g in render(iter(()))] == [("a", False), ("bc", True), ("d", False)]


@pytest.mark.parametrize("part_chars", [1, 40, 1 << 20])
def test_conversations_are_read_back(spark, part_chars):
    said = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (2, None, None, None), (2, 0, "assistant", ""), (None, 0, "assistant", "x<turn>"), (3, 0, "assistant", "é😀\n" * 5000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, part_chars=part_chars)).collect()}
    assert set(got) == {-7, 1, 2, 3, None}
    for conv in got:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert tuple(got[conv])[1:5] == (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0


def test_parts_may_come_in_any_order(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"text {c} {t} " * 20) for c in range(7) for t in range(9)]
    parts = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), part_chars=200)
    want = sorted(chat.read_back(parts).collect())
    dealt = spark.createDataFrame(sorted(parts.collect(), key=lambda r: hash((r.part * 7919, r.conv_id)) % 101), parts.schema).repartition(5)
    assert dealt.count() > 20 and sorted(chat.read_back(dealt).collect()) == want
