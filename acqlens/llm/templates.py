"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                      the value's text (null: nothing)
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for x in e %} ... {% endfor %}     with loop.index, loop.first
    {% set name = e %}
    {% generation %} ... {% endgeneration %}   marks what a model is to learn
    {# comment #}

Expressions: strings, whole numbers, true, false, none, names, ``a.b`` and
``a['b']`` on mappings, ``+ ~ == != < <= > >= and or not``, parentheses and
filters ``e | name``.  Names only reach what is passed in, members only keys of
mappings, filters only the given functions: there are no calls, no attributes of
Python objects and no loops but those over what is passed in.

``parse`` gives a syntax tree, ``fold`` evaluates what is constant in it (and
drops branches that cannot be taken and joins texts), ``compile_template`` turns
it into closures that render piece by piece.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any


class TemplateError(ValueError):
    pass


class Mark:
    """What a rendering yields besides text."""

    def __init__(self, name: str):
        self.name = name


BEGIN, END, TURN = Mark("generation begins"), Mark("generation ends"), Mark("a loop's turn is over")


# -- syntax tree ---------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Member:
    of: Any
    key: Any


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    arg: Any


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# -- parsing -------------------------------------------------------------------

_TAG = re.compile(r"\{#.*?#\}|\{\{(?P<out>.*?)\}\}|\{%(?P<do>.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)
                        |(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]=]))""", re.X)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0"}
_WORDS = {"true": True, "false": False, "none": None}
_RESERVED = {"and", "or", "not", "in", *_WORDS}


class _Expression:
    """Recursive descent over one tag's tokens."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while at < len(source.rstrip()):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            kind = m.lastgroup
            text = m[kind]
            if kind == "str":
                text = re.sub(r"\\(.)", lambda x: _ESCAPES.get(x[1], x[1]), text[1:-1], flags=re.S)
            self.tokens.append((kind, text))
            at = m.end()
        self.at = 0

    def peek(self, *texts: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") \
            and self.tokens[self.at][1] in texts

    def take(self, *texts: str) -> bool:
        found = self.peek(*texts)
        self.at += found
        return found

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name" \
                and self.tokens[self.at][1] not in _RESERVED:
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def done(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is too much")

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Op("or", (left, self.both()))
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Op("and", (left, self.negated()))
        return left

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        left = self.joined()
        while self.peek("==", "!=", "<", "<=", ">", ">="):
            self.at += 1
            left = Op(self.tokens[self.at - 1][1], (left, self.joined()))
        return left

    def joined(self):
        left = self.filtered()
        while self.peek("+", "~"):
            self.at += 1
            left = Op(self.tokens[self.at - 1][1], (left, self.filtered()))
        return left

    def filtered(self):
        value = self.member()
        while self.take("|"):
            value = Filter(self.name(), value)
        return value

    def member(self):
        value = self.atom()
        while True:
            if self.take("."):
                value = Member(value, Const(self.name()))
            elif self.take("["):
                value = Member(value, self.either())
                self.need("]")
            else:
                return value

    def atom(self):
        if self.take("("):
            value = self.either()
            self.need(")")
            return value
        if self.at == len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(text)
        if kind == "int":
            return Const(int(text))
        if kind == "name" and text in _WORDS:
            return Const(_WORDS[text])
        if kind == "name" and text not in _RESERVED:
            return Name(text)
        raise TemplateError(f"{text!r} is no expression")


def _whole(source: str):
    e = _Expression(source)
    value = e.either()
    e.done()
    return value


def parse(source: str) -> tuple:
    """The statements of a template."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at:m.start()]))
        if m["out"] is not None:
            parts.append(("out", m["out"]))
        elif m["do"] is not None:
            word, _, rest = m["do"].strip().partition(" ")
            parts.append((word, rest))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    for kind, text in parts:
        if kind == "text" and re.search(r"\{[{%#]", text):
            raise TemplateError("a tag is not closed")
    position = 0

    def block(*ends: str) -> tuple:
        nonlocal position
        out = []
        while position < len(parts):
            kind, text = parts[position]
            if kind in ends:
                return tuple(out)
            position += 1
            if kind == "text":
                out.append(Text(text))
            elif kind == "out":
                out.append(Output(_whole(text)))
            elif kind == "set":
                e = _Expression(text)
                name = e.name()
                e.need("=")
                value = e.either()
                e.done()
                out.append(Set(name, value))
            elif kind == "for":
                e = _Expression(text)
                name = e.name()
                e.need("in")
                over = e.either()
                e.done()
                out.append(For(name, over, block("endfor")))
                position += 1
            elif kind == "generation":
                out.append(Generation(block("endgeneration")))
                position += 1
            elif kind == "if":
                branches, condition = [], _whole(text)
                while True:
                    branches.append((condition, block("elif", "else", "endif")))
                    kind, text = parts[position]
                    position += 1
                    if kind == "endif":
                        break
                    condition = _whole(text) if kind == "elif" else Const(True)
                out.append(If(tuple(branches)))
            else:
                raise TemplateError(f"unknown tag {kind!r}")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(out)

    return block()


# -- constant folding ----------------------------------------------------------

def text_of(value: Any) -> str:
    if value is None:
        return ""
    if value is True or value is False:
        return "true" if value else "false"
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} has no text")


def _plus(a, b):
    if type(a) is type(b) and isinstance(a, (str, int)):
        return a + b
    raise TemplateError("+ takes two strings or two numbers")


def _ordered(compare: Callable) -> Callable:
    def run(a, b):
        if type(a) is type(b) and isinstance(a, (str, int)):
            return compare(a, b)
        raise TemplateError("only strings or numbers have an order")
    return run


OPERATORS: dict[str, Callable] = {
    "+": _plus, "~": lambda a, b: text_of(a) + text_of(b), "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b, "not": lambda a: not a, "<": _ordered(lambda a, b: a < b),
    "<=": _ordered(lambda a, b: a <= b), ">": _ordered(lambda a, b: a > b),
    ">=": _ordered(lambda a, b: a >= b)}


def fold_expression(e, filters: Mapping[str, Callable]):
    if isinstance(e, Member):
        return Member(fold_expression(e.of, filters), fold_expression(e.key, filters))
    if isinstance(e, Filter):
        if e.name not in filters:
            raise TemplateError(f"unknown filter {e.name!r}")
        arg = fold_expression(e.arg, filters)
        return Const(filters[e.name](arg.value)) if isinstance(arg, Const) else Filter(e.name, arg)
    if isinstance(e, Op):
        args = tuple(fold_expression(a, filters) for a in e.args)
        if e.op in ("and", "or"):
            if isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (e.op == "and") else args[0]
        elif all(isinstance(a, Const) for a in args):
            return Const(OPERATORS[e.op](*(a.value for a in args)))
        return Op(e.op, args)
    return e


def fold(body: tuple, filters: Mapping[str, Callable]) -> tuple:
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)

    for node in body:
        if isinstance(node, Output):
            value = fold_expression(node.value, filters)
            add(Text(text_of(value.value)) if isinstance(value, Const) else Output(value))
        elif isinstance(node, If):
            branches = []
            for condition, inner in node.branches:
                condition = fold_expression(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(inner, filters)))
                if isinstance(condition, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(tuple(branches)))
        elif isinstance(node, For):
            add(For(node.name, fold_expression(node.over, filters), fold(node.body, filters)))
        elif isinstance(node, Set):
            add(Set(node.name, fold_expression(node.value, filters)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body, filters)))
        else:
            add(node)
    return tuple(out)


# -- closures ------------------------------------------------------------------

def _value(e, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    if isinstance(e, Const):
        constant = e.value
        return lambda env: constant
    if isinstance(e, Name):
        name = e.name

        def look(env):
            if name not in env:
                raise TemplateError(f"unknown name {name!r}")
            return env[name]
        return look
    if isinstance(e, Member):
        of, key = _value(e.of, filters), _value(e.key, filters)

        def member(env):
            mapping = of(env)
            if not isinstance(mapping, Mapping):
                raise TemplateError("only mappings have members")
            return mapping.get(key(env))
        return member
    if isinstance(e, Filter):
        apply, arg = filters[e.name], _value(e.arg, filters)
        return lambda env: apply(arg(env))
    args = [_value(a, filters) for a in e.args]
    if e.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if e.op == "or":
        return lambda env: args[0](env) or args[1](env)
    apply = OPERATORS[e.op]
    if len(args) == 1:
        return lambda env: apply(args[0](env))
    return lambda env: apply(args[0](env), args[1](env))


def _statement(node, filters: Mapping[str, Callable]) -> Callable[[dict], Iterator]:
    if isinstance(node, Text):
        constant = (node.text,)
        return lambda env: constant
    if isinstance(node, Output):
        value = _value(node.value, filters)
        return lambda env: (text_of(value(env)),)
    if isinstance(node, Set):
        name, value = node.name, _value(node.value, filters)

        def assign(env):
            env[name] = value(env)
            return ()
        return assign
    if isinstance(node, Generation):
        inner = _body(node.body, filters)

        def marked(env):
            yield BEGIN
            yield from inner(env)
            yield END
        return marked
    if isinstance(node, If):
        branches = [(_value(c, filters), _body(b, filters)) for c, b in node.branches]

        def choose(env):
            for condition, inner in branches:
                if condition(env):
                    return inner(env)
            return ()
        return choose
    name, over, inner = node.name, _value(node.over, filters), _body(node.body, filters)

    def loop(env):
        outer = {k: env[k] for k in (name, "loop") if k in env}
        for i, item in enumerate(over(env)):
            env[name], env["loop"] = item, {"index": i + 1, "first": i == 0}
            yield from inner(env)
            yield TURN
        for k in (name, "loop"):
            env.pop(k, None)
        env.update(outer)
    return loop


def _body(body: tuple, filters: Mapping[str, Callable]) -> Callable[[dict], Iterator]:
    steps = [_statement(node, filters) for node in body]
    if len(steps) == 1:
        return steps[0]

    def run(env):
        for step in steps:
            yield from step(env)
    return run


def compile_template(source: str, filters: Mapping[str, Callable]) -> Callable[..., Iterator]:
    """A function of the template's names that yields strings, BEGIN and END
    around what is to be learnt, and TURN after each turn of a loop."""
    run = _body(fold(parse(source), filters), filters)
    return lambda **names: iter(run(dict(names)))
