"""Templates and chat formatting: results by hand, and round trips of random conversations."""

import hashlib
import random

import pytest

from rightsweave.llm import chat
from rightsweave.llm.templates import Const, Output, TemplateError, compile_template, fold, OPERATORS, parse


def text(source, **names):
    return "".join(p for p, _ in compile_template(source)(**names))


@pytest.mark.parametrize("source,names,want", [
    ("a{{ x }}b", {"x": 3}, "a3b"),
    ("{{ x }}", {}, ""),
    ("{{ x.y['z'] | upper }}", {"x": {"y": {"z": "q"}}}, "Q"),
    ("{% for i in x %}{{ loop.index0 }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", {"x": "ab"}, "0a,1b"),
    ("{% if x == 1 %}one{% elif x in 'ab' %}in{% else %}no{% endif %}", {"x": "a"}, "in"),
    ("{% if x == 1 %}one{% elif x == 2 %}two{% endif %}", {"x": 2}, "two"),
    ("{% set y = x ~ '!' %}{{ y + y }}", {"x": "k"}, "k!k!"),
    ("  {%- if true -%}  t  {%- endif -%}  ", {}, "t"),
    ("{# no #}{{ 'a' if x else 'b' }}{{ 'it\\'s\\n' }}", {"x": 0}, "bit's\n"),
    ("{{ ' s ' | trim | length }}{{ 2 < 3 and not false or x }}", {}, "1True"),
])
def test_language(source, names, want):
    assert text(source, **names) == want


@pytest.mark.parametrize("source", ["{{ x( }}", "{% for x %}{% endfor %}", "{% if x %}", "{% import os %}", "{{ x.__class__() }}",
                                    "{{ x|eval }}", "{{ }}", "{{ a b }}"])
def test_what_is_not_the_language_is_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_no_python_attributes():
    assert text("{{ x.__class__ }}{{ x.real }}", x=3) == ""


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' ~ ('c' if 1 < 2 else x) }}{% if false %}{{ x }}{% else %}d{% endif %}"), OPERATORS)
    assert tree == (Output(Const("abc")), Output(Const("d"))) or tree == (Output(Const("abcd")),)


def test_random_conversations_come_back():
    random.seed(3)
    render = compile_template(chat.TEMPLATE, {"escape": chat.escape, "role": chat.escape_role})
    bits = ["#", "##", "### ", " ", ": ", ":", "\\", "</turn>", "</tu", "rn>", "a", "\n", "<", "é", "### Assistant: "]
    for _ in range(5000):
        said = [(random.choice(["assistant", "user", "".join(random.choices(bits, k=3))]),
                 "".join(random.choices(bits, k=random.randint(0, 8)))) for _ in range(random.randint(0, 4))]
        reader, got = chat.Reader(), []
        pieces = list(render(messages=iter([{"role": r, "text": t} for r, t in said])))
        for piece in pieces:
            got += reader.feed(*piece)
        assert got == [(r, t, t if r == "assistant" else "") for r, t in said]
        whole = list(chat.Reader().feed("".join(p for p, _ in pieces), False))
        assert [g[:2] for g in whole] == said


def brute(rows):
    by = {}
    for conv, turn, role, said, *_ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", said is not None, said or ""))
    out = []
    for conv, own in by.items():
        own.sort()
        turns = "".join(f"{r}\n{t}\n" for _, _, _, r, _, t in own)
        loss = "".join(t for _, _, _, r, _, t in own if r == "assistant")
        chars = sum(len("### " + chat.escape_role(r) + ": " + chat.escape(t) + "</turn>\n") for _, _, _, r, _, t in own)
        out.append((conv, len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, piece string, generated string"


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", None), (2, None, None, None),
            (2, 3, "assistant", ""), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, 0, "assistant", "z\\### </turn>" * 3000),
            (4, 0, "a: b", "t"), (4, 1, "c:", ": ### ")] + [(5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(1500)]
    rows = [(*r, "p", "g") for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted((tuple(r) for r in chat.format_conversations(frame).collect()), key=str) == brute(rows)
    pieces = {}
    for r in chat.formatted_turns(frame).orderBy("conv_id", "piece").collect():
        pieces.setdefault(r.conv_id, []).append((r.text, r.generated))
    for conv, n, turns, _, loss, chars in brute(rows):
        digest = chat.Digest()
        for piece in pieces[conv]:
            digest.add(*piece)
        assert digest.row()[0] == n and digest.row()[1] == turns and digest.row()[3] == loss and digest.row()[4] == chars


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
