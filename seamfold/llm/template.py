"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}   {# comment #}   {% set name = expression %}
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for name in e %} {% endfor %}        with loop.index, loop.first, loop.last ...
    {% generation %} {% endgeneration %}    what is put out here is the model's part

A dash inside a delimiter trims the white space beyond it. Expressions know literals,
lists, names, .field and [key], + - * % ~, comparisons, in, and/or/not, a if b else c,
"is (not) defined/none" and filters. Names see only the variables given to render();
fields are only looked up in dictionaries; there are no calls but the filters given.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

MISSING = type("Missing", (), {"__bool__": lambda self: False, "__str__": lambda self: "", "__iter__": lambda self: iter(()), "__len__": lambda self: 0})()


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Op:
    """what is applied to args: an operator, "field", "list", "choose", "defined" or a filter's name with a bar."""

    what: str
    args: tuple


@dataclass(frozen=True)
class Put:
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


_PIECE = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*%~<>=.,|()\[\]]))""", re.S)
_ESCAPE = {"n": "\n", "t": "\t", "r": "\r"}
_BINARY: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "+": operator.add, "-": operator.sub, "*": operator.mul, "%": operator.mod, "~": lambda a, b: f"{a}{b}", "in": lambda a, b: a in b,
}


def lex(source: str) -> list[tuple[str, str]]:
    """("text" | "put" | "tag", content) pieces."""
    out, at, trim = [], 0, False
    for m in _PIECE.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if trim else text
        left, right = next(((m[i], m[j]) for i, j in ((1, 3), (4, 6), (7, 8)) if m[i] is not None), ("", ""))
        text = text.rstrip() if left else text
        if text:
            out.append(("text", text))
        if m[2] is not None:
            out.append(("put", m[2]))
        elif m[5] is not None:
            out.append(("tag", m[5].strip()))
        at, trim = m.end(), bool(right)
    text = source[at:].lstrip() if trim else source[at:]
    return [*out, ("text", text)] if text else out


class _Expression:
    """Precedence climbing over one expression's tokens."""

    LEVELS = (("==", "!=", "<", ">", "<=", ">=", "in"), ("~",), ("+", "-"), ("*", "%"))

    def __init__(self, source: str, filters: dict[str, Callable]) -> None:
        self.filters, self.tokens, self.i = filters, [], 0
        at = 0
        source = source.rstrip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"cannot read {source[at:]!r}")
            if m[1] is not None:
                self.tokens.append(("const", int(m[1])))
            elif m[2] is not None or m[3] is not None:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPE.get(e[1], e[1]), m[2] if m[2] is not None else m[3], flags=re.S)))
            elif m[4] is not None:
                self.tokens.append(("name", m[4]))
            else:
                self.tokens.append(("sign", m[5]))
            at = m.end()

    def peek(self, *values: str) -> bool:
        return self.i < len(self.tokens) and self.tokens[self.i][0] != "const" and self.tokens[self.i][1] in values

    def take(self, *values: str) -> bool:
        self.i += (hit := self.peek(*values))
        return hit

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value} is missing")

    def name(self) -> str:
        if self.i >= len(self.tokens) or self.tokens[self.i][0] != "name" or self.tokens[self.i][1].startswith("_"):
            raise TemplateError("a plain name is missing")
        self.i += 1
        return self.tokens[self.i - 1][1]

    def end(self, node):
        if self.i != len(self.tokens):
            raise TemplateError(f"{self.tokens[self.i][1]!r} is not expected")
        return node

    def whole(self):
        node = self.either()
        if self.take("if"):
            test = self.either()
            other = self.whole() if self.take("else") else Const("")
            return Op("choose", (test, node, other))
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = Op("or", (node, self.both()))
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = Op("and", (node, self.negated()))
        return node

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.binary(0)

    def binary(self, level: int):
        if level == len(self.LEVELS):
            return self.unary()
        node = self.binary(level + 1)
        while True:
            if level == 0 and self.take("is"):
                no, test = self.take("not"), self.name()
                if test not in ("defined", "none"):
                    raise TemplateError(f"no test named {test}")
                node = Op(test, (node,))
                node = Op("not", (node,)) if no else node
            elif level == 0 and self.peek("not") and self.i + 1 < len(self.tokens) and self.tokens[self.i + 1] == ("name", "in"):
                self.i += 2
                node = Op("not", (Op("in", (node, self.binary(1))),))
            elif self.peek(*self.LEVELS[level]):
                what = self.tokens[self.i][1]
                self.i += 1
                node = Op(what, (node, self.binary(level + 1)))
            else:
                return node

    def unary(self):
        return Op("-", (Const(0), self.unary())) if self.take("-") else self.postfix(self.atom())

    def postfix(self, node):
        while True:
            if self.take("."):
                node = Op("field", (node, Const(self.name())))
            elif self.take("["):
                node = Op("field", (node, self.whole()))
                self.need("]")
            elif self.take("|"):
                name = self.name()
                if name not in self.filters:
                    raise TemplateError(f"no filter named {name}")
                node = Op(f"|{name}", (node, *(self.items(")") if self.take("(") else ())))
            else:
                return node

    def items(self, close: str) -> list:
        out: list = []
        while not self.take(close):
            if out:
                self.need(",")
            out.append(self.whole())
        return out

    def atom(self):
        if self.take("("):
            node = self.whole()
            self.need(")")
            return node
        if self.take("["):
            return Op("list", tuple(self.items("]")))
        if self.i < len(self.tokens) and self.tokens[self.i][0] == "const":
            self.i += 1
            return Const(self.tokens[self.i - 1][1])
        name = self.name()
        return Const({"true": True, "false": False, "none": None}[name.lower()]) if name.lower() in ("true", "false", "none") else Name(name)


def parse(source: str, filters: dict[str, Callable]) -> tuple:
    """The syntax tree: a tuple of statements."""
    pieces, i = lex(source), 0
    read = lambda s: (x := _Expression(s, filters)).end(x.whole())

    def block(*closers: str) -> tuple[tuple, str, str]:
        nonlocal i
        out: list = []
        while i < len(pieces):
            kind, content = pieces[i]
            i += 1
            if kind != "tag":
                out.append(Put(Const(content) if kind == "text" else read(content)))
                continue
            word, _, rest = content.partition(" ")
            if word in closers:
                return tuple(out), word, rest
            if word == "if":
                out.append(branch(rest))
            elif word == "for":
                if not (m := re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.*)", rest, re.S)):
                    raise TemplateError("for needs: name in expression")
                out.append(For(m[1], read(m[2]), block("endfor")[0]))
            elif word == "set":
                if not (m := re.fullmatch(r"\s*([A-Za-z]\w*)\s*=(?!=)(.*)", rest, re.S)):
                    raise TemplateError("set needs: name = expression")
                out.append(Set(m[1], read(m[2])))
            elif word == "generation":
                out.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"no tag named {word}")
        if closers:
            raise TemplateError(f"{closers[-1]} is missing")
        return tuple(out), "", ""

    def branch(test: str) -> If:
        then, word, rest = block("elif", "else", "endif")
        other: tuple = ()
        if word == "elif":
            other = (branch(rest),)
        elif word == "else":
            other = block("endif")[0]
        return If(read(test), then, other)

    return block()[0]


def _apply(what: str, args: tuple, filters: dict[str, Callable]):
    if what == "field":
        box, key = args
        if isinstance(box, dict):
            return box.get(key, MISSING)
        return box[key] if isinstance(box, (list, tuple, str)) and isinstance(key, int) and -len(box) <= key < len(box) else MISSING
    if what == "list":
        return list(args)
    if what == "not":
        return not args[0]
    if what == "defined":
        return args[0] is not MISSING
    if what == "none":
        return args[0] is None
    return filters[what[1:]](*args) if what[0] == "|" else _BINARY[what](*args)


def fold(node, filters: dict[str, Callable]):
    """The same tree with constant parts evaluated and neighbouring texts joined."""
    again = lambda x: fold(x, filters)
    if isinstance(node, tuple):
        out: list = []
        for x in (y for n in node for y in (lambda f: f if isinstance(f, tuple) else (f,))(again(n))):
            if isinstance(x, Put) and isinstance(x.value, Const):
                text = _text(x.value.value)
                if out and isinstance(out[-1], Put) and isinstance(out[-1].value, Const):
                    text = out.pop().value.value + text
                x = Put(Const(text))
            if x != Put(Const("")):
                out.append(x)
        return tuple(out)
    if isinstance(node, Put):
        return Put(again(node.value))
    if isinstance(node, If):
        test = again(node.test)
        if isinstance(test, Const):
            return again(node.then if test.value else node.other)
        return If(test, again(node.then), again(node.other))
    if isinstance(node, For):
        return For(node.name, again(node.items), again(node.body))
    if isinstance(node, Set):
        return Set(node.name, again(node.value))
    if isinstance(node, Generation):
        return Generation(again(node.body))
    if isinstance(node, Op):
        args = tuple(again(a) for a in node.args)
        head = args[0] if args else None
        if node.what == "choose" and isinstance(head, Const):
            return args[1] if head.value else args[2]
        if node.what in ("and", "or") and isinstance(head, Const):
            return args[1] if bool(head.value) == (node.what == "and") else head
        if args and all(isinstance(a, Const) for a in args) and node.what not in ("choose", "and", "or"):
            try:
                return Const(_apply(node.what, tuple(a.value for a in args), filters))
            except Exception:  # noqa: BLE001  left for the run, should it come to it
                pass
        return Op(node.what, args)
    return node


def _text(x) -> str:
    return "" if x is None or x is MISSING else x if isinstance(x, str) else str(x)


@dataclass
class Output:
    limit: int
    parts: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def put(self, text: str) -> None:
        self.size += len(text)
        if self.size > self.limit:
            raise TemplateError("the output is too long")
        self.parts.append(text)


def _expression(node, filters) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda names, v=node.value: v
    if isinstance(node, Name):
        return lambda names, n=node.name: names.get(n, MISSING)
    what, args = node.what, tuple(_expression(a, filters) for a in node.args)
    if what == "and":
        return lambda names: args[0](names) and args[1](names)
    if what == "or":
        return lambda names: args[0](names) or args[1](names)
    if what == "choose":
        return lambda names: args[1](names) if args[0](names) else args[2](names)
    if what in _BINARY:
        f, (a, b) = _BINARY[what], args
        return lambda names: f(a(names), b(names))
    if what[0] == "|":
        f, a, more = filters[what[1:]], args[0], args[1:]
        return (lambda names: f(a(names), *(x(names) for x in more))) if more else (lambda names: f(a(names)))
    return lambda names: _apply(what, tuple(a(names) for a in args), filters)


def _statements(nodes: tuple, filters) -> Callable[[dict, Output], None]:
    steps = [_statement(n, filters) for n in nodes]

    def run(names: dict, out: Output) -> None:
        for step in steps:
            step(names, out)

    return steps[0] if len(steps) == 1 else run


def _statement(node, filters) -> Callable[[dict, Output], None]:
    if isinstance(node, Put):
        if isinstance(node.value, Const):
            return lambda names, out, text=_text(node.value.value): out.put(text)
        value = _expression(node.value, filters)
        return lambda names, out: out.put(_text(value(names)))
    if isinstance(node, If):
        test, then, other = _expression(node.test, filters), _statements(node.then, filters), _statements(node.other, filters)
        return lambda names, out: then(names, out) if test(names) else other(names, out)
    if isinstance(node, Set):
        value = _expression(node.value, filters)
        return lambda names, out: names.__setitem__(node.name, value(names))
    if isinstance(node, Generation):
        body = _statements(node.body, filters)

        def generate(names: dict, out: Output) -> None:
            start = out.size
            body(names, out)
            out.spans.append((start, out.size))

        return generate
    items, body = _expression(node.items, filters), _statements(node.body, filters)

    def loop(names: dict, out: Output) -> None:
        values = list(items(names))
        for i, value in enumerate(values):
            body(names | {node.name: value, "loop": {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(values) - 1, "length": len(values)}}, out)

    return loop


class Template:
    """A compiled template; filters are the only functions that it may call."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None, limit: int = 1 << 30) -> None:
        self.filters, self.limit = {"trim": lambda s: _text(s).strip(), "upper": lambda s: _text(s).upper(), "lower": lambda s: _text(s).lower(), "length": len, "default": lambda v, d: d if v is MISSING or v is None else v} | (filters or {}), limit
        self.tree = fold(parse(source, self.filters), self.filters)
        self._run = _statements(self.tree, self.filters)

    def render(self, **names) -> tuple[str, list[tuple[int, int]]]:
        """The text and the spans of its generated parts, in characters."""
        out = Output(self.limit)
        self._run(dict(names), out)
        return "".join(out.parts), out.spans
