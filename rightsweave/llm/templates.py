"""A small sandboxed template language, compiled to Python closures.

    text          as it is
    {{ expr }}    the value, as text
    {% for x in expr %} ... {% endfor %}       with loop.index0, loop.first, loop.last
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% set x = expr %}
    {% generation %} ... {% endgeneration %}   marks what it renders as generated
    {# comment #}

Expressions have strings, integers, true, false, none, names, ``a.b`` and
``a['b']`` on mappings, ``+ ~ == != < <= > >= in and or not``, ``x if c else
y``, parentheses and the filters ``upper lower trim length escape``.  A ``-``
inside a tag's brace trims white space on that side.  There are no calls, no
attributes of Python objects and no loops but over given sequences.

The source is parsed to a syntax tree, constant expressions and branches are
folded, and the rest becomes closures that yield (text, generated) pieces one
at a time, so that a sequence of any length can be rendered as a stream.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Piece = tuple[str, bool]
Scope = dict[str, Any]


class TemplateError(ValueError):
    """A template that the language does not allow."""


# ---- syntax tree ----

@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or filter on its arguments."""
    op: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Branch:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# ---- values ----

def _text(value: Any) -> str:
    return "" if value is None else str(value)


def _item(of: Any, key: Any) -> Any:
    return of.get(key) if isinstance(of, Mapping) else None


#: Operators without short circuit, and filters after ``|``.
OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "~": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b, "not": lambda a: not a, "item": _item,
    "|upper": lambda a: _text(a).upper(), "|lower": lambda a: _text(a).lower(), "|trim": lambda a: _text(a).strip(),
    "|length": lambda a: len(a) if a is not None else 0,
}

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|[-+~<>()\[\].|=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}


class _Expression:
    """Recursive-descent parser of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup or 0]))
            at = m.end()
        self.at = 0

    def peek(self, *texts: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in texts

    def take(self, *texts: str) -> bool:
        found = self.peek(*texts)
        self.at += found
        return found

    def expect(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"expected {text!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("expected a name")

    def whole(self) -> Any:
        found = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"left over: {self.tokens[self.at][1]!r}")
        return found

    def choice(self) -> Any:
        value = self.either()
        if self.take("if"):
            test = self.either()
            other = self.choice() if self.take("else") else Const(None)
            return Apply("if", (test, value, other))
        return value

    def either(self) -> Any:
        value = self.both()
        while self.take("or"):
            value = Apply("or", (value, self.both()))
        return value

    def both(self) -> Any:
        value = self.negation()
        while self.take("and"):
            value = Apply("and", (value, self.negation()))
        return value

    def negation(self) -> Any:
        return Apply("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Any:
        value = self.sum()
        while self.peek("==", "!=", "<", "<=", ">", ">=", "in"):
            op = self.tokens[self.at][1]
            self.at += 1
            value = Apply(op, (value, self.sum()))
        return value

    def sum(self) -> Any:
        value = self.filtered()
        while self.peek("+", "~"):
            op = self.tokens[self.at][1]
            self.at += 1
            value = Apply(op, (value, self.filtered()))
        return value

    def filtered(self) -> Any:
        value = self.part()
        while True:
            if self.take("|"):
                value = Apply("|" + self.name(), (value,))
            elif self.take("."):
                value = Item(value, Const(self.name()))
            elif self.take("["):
                value = Item(value, self.choice())
                self.expect("]")
            else:
                return value

    def part(self) -> Any:
        if self.take("("):
            value = self.choice()
            self.expect(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(text))
        if kind == "name":
            return Const(_WORDS[text]) if text in _WORDS else Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []  # (kind, content)
    at, trim = 0, False
    for m in _TAG.finditer(source):
        text = source[at:m.start()]
        before = m[1] or m[4] or m[7]
        text = text.lstrip() if trim else text
        parts.append(("text", text.rstrip() if before else text))
        if m[2] is not None:
            parts.append(("out", m[2]))
        elif m[5] is not None:
            parts.append(("tag", m[5].strip()))
        at, trim = m.end(), bool(m[3] or m[6] or m[8])
    parts.append(("text", source[at:].lstrip() if trim else source[at:]))
    place = [0]

    def block(*ends: str) -> tuple[tuple, str]:
        body: list[Any] = []
        while place[0] < len(parts):
            kind, content = parts[place[0]]
            place[0] += 1
            if kind == "text":
                if content:
                    body.append(Output(Const(content)))
            elif kind == "out":
                body.append(Output(_Expression(content).whole()))
            else:
                word, _, rest = content.partition(" ")
                if word in ends:
                    return tuple(body), content
                body.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(body), ""

    def statement(word: str, rest: str) -> Any:
        if word == "for":
            head = _Expression(rest)
            name = head.name()
            head.expect("in")
            over = head.whole()
            return Loop(name, over, block("endfor")[0])
        if word == "if":
            return branch(rest)
        if word == "set":
            head = _Expression(rest)
            name = head.name()
            head.expect("=")
            return Assign(name, head.whole())
        if word == "generation":
            return Generation(block("endgeneration")[0])
        raise TemplateError(f"unknown tag {word!r}")

    def branch(test: str) -> Branch:
        condition = _Expression(test).whole()
        then, end = block("elif", "else", "endif")
        if end.startswith("elif"):
            return Branch(condition, then, (branch(end[4:]),))
        return Branch(condition, then, block("endif")[0] if end == "else" else ())

    return block()[0]


# ---- constant folding ----

def fold_expression(node: Any, operators: Mapping[str, Callable]) -> Any:
    if isinstance(node, Item):
        return Item(fold_expression(node.of, operators), fold_expression(node.key, operators))
    if not isinstance(node, Apply):
        return node
    args = tuple(fold_expression(a, operators) for a in node.args)
    first = args[0]
    if isinstance(first, Const) and node.op in ("and", "or", "if"):
        if node.op == "if":
            return args[1] if first.value else args[2]
        return args[1] if bool(first.value) == (node.op == "and") else first
    if node.op not in ("and", "or", "if") and all(isinstance(a, Const) for a in args) and node.op in operators:
        return Const(operators[node.op](*(a.value for a in args)))
    return Apply(node.op, args)


def fold(body: tuple, operators: Mapping[str, Callable]) -> tuple:
    """The body with constant expressions, branches and neighbouring texts folded."""
    out: list[Any] = []
    for node in body:
        if isinstance(node, Output):
            value = fold_expression(node.value, operators)
            if isinstance(value, Const):
                text = _text(value.value)
                if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                    text = out.pop().value.value + text
                if text:
                    out.append(Output(Const(text)))
            else:
                out.append(Output(value))
        elif isinstance(node, Assign):
            out.append(Assign(node.name, fold_expression(node.value, operators)))
        elif isinstance(node, Branch):
            test = fold_expression(node.test, operators)
            then, other = fold(node.then, operators), fold(node.other, operators)
            if isinstance(test, Const):
                out.extend(then if test.value else other)
            else:
                out.append(Branch(test, then, other))
        elif isinstance(node, Loop):
            out.append(Loop(node.name, fold_expression(node.over, operators), fold(node.body, operators)))
        else:
            out.append(Generation(fold(node.body, operators)))
    return tuple(out)


# ---- closures ----

def _compile_expression(node: Any, operators: Mapping[str, Callable]) -> Callable[[Scope], Any]:
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Item):
        of, key = (_compile_expression(n, operators) for n in (node.of, node.key))
        return lambda scope: _item(of(scope), key(scope))
    args = [_compile_expression(a, operators) for a in node.args]
    if node.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    if node.op == "if":
        return lambda scope: args[1](scope) if args[0](scope) else args[2](scope)
    if node.op not in operators:
        raise TemplateError(f"unknown filter {node.op[1:]!r}")
    apply = operators[node.op]
    if len(args) == 1:
        return lambda scope: apply(args[0](scope))
    return lambda scope: apply(args[0](scope), args[1](scope))


def _compile(body: tuple, operators: Mapping[str, Callable], marked: bool) -> Callable[[Scope], Iterator[Piece]]:
    steps = [_compile_statement(node, operators, marked) for node in body]

    def run(scope: Scope) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def _compile_statement(node: Any, operators: Mapping[str, Callable], marked: bool) -> Callable[[Scope], Iterable[Piece]]:
    if isinstance(node, Output):
        value = _compile_expression(node.value, operators)
        return lambda scope: ((_text(value(scope)), marked),)
    if isinstance(node, Assign):
        value, name = _compile_expression(node.value, operators), node.name

        def assign(scope: Scope) -> Iterable[Piece]:
            scope[name] = value(scope)
            return ()

        return assign
    if isinstance(node, Branch):
        test = _compile_expression(node.test, operators)
        then, other = _compile(node.then, operators, marked), _compile(node.other, operators, marked)
        return lambda scope: then(scope) if test(scope) else other(scope)
    if isinstance(node, Generation):
        return _compile(node.body, operators, True)
    over, body, name = _compile_expression(node.over, operators), _compile(node.body, operators, marked), node.name

    def loop(scope: Scope) -> Iterator[Piece]:
        items = iter(over(scope) or ())
        missing = object()
        item, index = next(items, missing), 0
        while item is not missing:
            after = next(items, missing)
            yield from body(scope | {name: item, "loop": {"index0": index, "first": not index, "last": after is missing}})
            item, index = after, index + 1

    return loop


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[..., Iterator[Piece]]:
    """A function of the template's names that yields the rendered pieces; ``filters`` adds to the built-in ones."""
    operators = OPERATORS | {f"|{k}": f for k, f in (filters or {}).items()}
    run = _compile(fold(parse(source), operators), operators, False)
    return lambda **names: run(dict(names))
