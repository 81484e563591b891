"""A small, sandboxed template language: text -> syntax tree -> folded tree -> Python closures.

    {{ value }}   {% if a %}..{% elif b %}..{% else %}..{% endif %}   {% for m in messages %}..{% endfor %}
    {% set x = value %}   {% generation %}..{% endgeneration %}   {# remark #}   a '-' inside a tag eats white space beside it

Values: strings, whole numbers, true, false, none, names, ``m.role`` or ``m['role']``, ``loop.first`` and so on, ``a if c else b``,
``and or not == != < <= > >= in + ~ %`` and filters (``m.text | trim``).  A template reaches nothing but the values it is
given: a dot looks a key up in a dictionary and never an attribute, there are no calls, and the only loops run over given lists,
so every rendering ends.  Missing keys and names are none, and none is written as nothing.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass


class TemplateError(ValueError):
    """The text is no template of this language."""


@dataclass(frozen=True)
class Node:
    kind: str
    parts: tuple = ()


# ---------------------------------------------------------------- tokens
_OPEN = re.compile(r"\{\{-?|\{%-?|\{#")
_CLOSE = {"{{": re.compile(r"\s*(-?)\}\}"), "{%": re.compile(r"\s*(-?)%\}")}
_TOKEN = re.compile(
    r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-<>+~%|.,()\[\]=]))", re.S
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_CONSTANTS = {"true": True, "false": False, "none": None}
_KEYWORDS = {"and", "or", "not", "in", "if", "else", *_CONSTANTS}


def _scan(source: str) -> list[tuple[str, object]]:
    """('text', str), ('{{', tokens) and ('{%', tokens) in order."""
    found: list[tuple[str, object]] = []
    at, eat = 0, False
    while True:
        opened = _OPEN.search(source, at)
        text = source[at : opened.start() if opened else len(source)]
        if eat:
            text = text.lstrip()
        if opened and opened.group().endswith("-"):
            text = text.rstrip()
        if text:
            found.append(("text", text))
        if not opened:
            return found
        at, eat, kind = opened.end(), False, opened.group()[:2]
        if kind == "{#":
            end = source.find("#}", at)
            if end < 0:
                raise TemplateError("a remark is not closed")
            at = end + 2
            continue
        tokens: list[tuple[str, str]] = []
        while not (closed := _CLOSE[kind].match(source, at)):
            token = _TOKEN.match(source, at)
            if not token:
                raise TemplateError(f"cannot read {source[at : at + 20]!r}")
            value = token.group(token.lastgroup)
            if token.lastgroup == "string":
                value = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m.group(1), m.group(1)), value[1:-1], flags=re.S)
            is_word = token.lastgroup == "name" and value in _KEYWORDS
            tokens.append(("word" if is_word else token.lastgroup, value))
            at = token.end()
        at, eat = closed.end(), closed.group(1) == "-"
        found.append((kind, tokens))


# ---------------------------------------------------------------- syntax tree
class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, tokens: list[tuple[str, str]]):
        self.tokens, self.at = tokens, 0

    def peek(self, *wanted: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("word", "sign") and self.tokens[self.at][1] in wanted

    def take(self, *wanted: str) -> str | None:
        if not self.peek(*wanted):
            return None
        self.at += 1
        return self.tokens[self.at - 1][1]

    def need(self, kind: str, value: str | None = None) -> str:
        if self.at < len(self.tokens):
            found, text = self.tokens[self.at]
            if found == kind and value in (None, text):
                self.at += 1
                return text
        raise TemplateError(f"expected {value or kind} in {' '.join(t[1] for t in self.tokens)!r}")

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"did not expect {self.tokens[self.at][1]!r}")

    def choice(self) -> Node:
        value = self.either()
        if self.take("if"):
            test = self.either()
            other = self.choice() if self.take("else") else Node("const", (None,))
            return Node("pick", (test, value, other))
        return value

    def either(self) -> Node:
        value = self.both()
        while self.take("or"):
            value = Node("or", (value, self.both()))
        return value

    def both(self) -> Node:
        value = self.negation()
        while self.take("and"):
            value = Node("and", (value, self.negation()))
        return value

    def negation(self) -> Node:
        return Node("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Node:
        left = self.sum()
        sign = self.take("==", "!=", "<", "<=", ">", ">=", "in")
        if sign:
            return Node("binary", (sign, left, self.sum()))
        if self.take("not"):
            self.need("word", "in")
            return Node("not", (Node("binary", ("in", left, self.sum())),))
        return left

    def sum(self) -> Node:
        value = self.filtered()
        while sign := self.take("+", "~", "%"):
            value = Node("binary", (sign, value, self.filtered()))
        return value

    def filtered(self) -> Node:
        value = self.atom()
        while sign := self.take(".", "[", "|"):
            if sign == "|":
                value = Node("filter", (self.need("name"), value))
            elif sign == ".":
                value = Node("item", (value, Node("const", (self.need("name"),))))
            else:
                value = Node("item", (value, self.choice()))
                self.need("sign", "]")
        return value

    def atom(self) -> Node:
        if self.take("("):
            value = self.choice()
            self.need("sign", ")")
            return value
        for word, constant in _CONSTANTS.items():
            if self.take(word):
                return Node("const", (constant,))
        if self.at >= len(self.tokens):
            raise TemplateError("a value is missing")
        kind, text = self.tokens[self.at]
        if kind not in ("string", "number", "name"):
            raise TemplateError(f"did not expect {text!r}")
        self.at += 1
        if kind == "name":
            return Node("name", (text,))
        return Node("const", (int(text) if kind == "number" else text,))


def parse(source: str) -> Node:
    """Syntax tree of a template."""
    items = _scan(source)
    place = 0

    def block(*ends: str) -> tuple[list[Node], _Expression | None, str]:
        """Statements up to one of the tags ``ends``: they, the rest of that tag and its name."""
        nonlocal place
        body: list[Node] = []
        while place < len(items):
            kind, content = items[place]
            place += 1
            if kind == "text":
                body.append(Node("text", (content,)))
                continue
            tag = _Expression(content)
            if kind == "{{":
                body.append(Node("write", (tag.choice(),)))
                tag.end()
                continue
            name = tag.take("if", "else") or tag.need("name")
            if name in ends:
                return body, tag, name
            body.append(statement(name, tag))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return body, None, ""

    def statement(name: str, tag: _Expression) -> Node:
        if name == "if":
            branches: list[tuple[Node, tuple[Node, ...]]] = []
            test = tag.choice()
            tag.end()
            while True:
                ends = ("endif",) if name == "else" else ("elif", "else", "endif")
                body, tag, name = block(*ends)
                branches.append((test, tuple(body)))
                test = tag.choice() if name == "elif" else Node("const", (True,))
                tag.end()
                if name == "endif":
                    return Node("branches", tuple(branches))
        if name == "for":
            variable = tag.need("name")
            tag.need("word", "in")
            values = tag.choice()
            tag.end()
            body, tag, _ = block("endfor")
            tag.end()
            return Node("for", (variable, values, tuple(body)))
        if name == "set":
            variable = tag.need("name")
            tag.need("sign", "=")
            value = tag.choice()
            tag.end()
            return Node("set", (variable, value))
        if name == "generation":
            tag.end()
            body, tag, _ = block("endgeneration")
            tag.end()
            return Node("generation", (tuple(body),))
        raise TemplateError(f"unknown tag {name!r}")

    return Node("block", (tuple(block()[0]),))


# ---------------------------------------------------------------- values
def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _item(container: object, key: object) -> object:
    if isinstance(container, dict):
        return container.get(key)
    if isinstance(container, list) and isinstance(key, int) and -len(container) <= key < len(container):
        return container[key]
    return None


def _plus(a: object, b: object) -> object:
    return a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)


def _within(a: object, b: object) -> bool:
    return a in b if isinstance(b, (list, dict)) or (isinstance(b, str) and isinstance(a, str)) else False


def _ordered(compare: Callable) -> Callable:
    def run(a: object, b: object) -> bool:
        return compare(a, b) if type(a) is type(b) and isinstance(a, (int, str)) else False

    return run


_BINARY: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": _ordered(operator.lt), "<=": _ordered(operator.le), ">": _ordered(operator.gt),
    ">=": _ordered(operator.ge), "in": _within, "+": _plus, "~": lambda a, b: _text(a) + _text(b),
    "%": lambda a, b: a % b if isinstance(a, int) and isinstance(b, int) and b else None,
}
_FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(), "lower": lambda x: _text(x).lower(), "upper": lambda x: _text(x).upper(),
    "length": lambda x: len(x) if isinstance(x, (str, list, dict)) else 0, "string": _text,
}


# ---------------------------------------------------------------- folding
def fold(node: Node, filters: dict[str, Callable]) -> Node:
    """The same tree with everything worked out that no input can change."""
    kind, parts = node.kind, node.parts
    if kind in ("text", "const", "name"):
        return node
    if kind == "block":
        return Node("block", (_fold_body(parts[0], filters),))
    if kind == "write":
        value = fold(parts[0], filters)
        return Node("text", (_text(value.parts[0]),)) if value.kind == "const" else Node("write", (value,))
    if kind == "set":
        return Node("set", (parts[0], fold(parts[1], filters)))
    if kind == "generation":
        return Node("generation", (_fold_body(parts[0], filters),))
    if kind == "for":
        values, body = fold(parts[1], filters), _fold_body(parts[2], filters)
        return Node("for", (parts[0], values, body)) if values.kind != "const" else Node("block", ((),))
    if kind == "branches":
        kept = []
        for test, body in parts:
            test = fold(test, filters)
            if test.kind != "const" or test.parts[0]:
                kept.append((test, _fold_body(body, filters)))
            if test.kind == "const" and test.parts[0]:
                break
        if not kept or kept[0][0].kind == "const":
            return Node("block", (kept[0][1] if kept else (),))
        return Node("branches", tuple(kept))
    if kind == "binary":
        a, b = fold(parts[1], filters), fold(parts[2], filters)
        if a.kind == b.kind == "const":
            return Node("const", (_BINARY[parts[0]](a.parts[0], b.parts[0]),))
        return Node("binary", (parts[0], a, b))
    if kind == "filter":
        if parts[0] not in filters:
            raise TemplateError(f"unknown filter {parts[0]!r}")
        value = fold(parts[1], filters)
        return Node("const", (filters[parts[0]](value.parts[0]),)) if value.kind == "const" else Node("filter", (parts[0], value))
    folded = tuple(fold(p, filters) for p in parts)  # item, not, and, or, pick
    first = folded[0]
    if first.kind == "const":
        constant = first.parts[0]
        if kind == "not":
            return Node("const", (not constant,))
        if kind == "and":
            return folded[1] if constant else first
        if kind == "or":
            return first if constant else folded[1]
        if kind == "pick":
            return folded[1] if constant else folded[2]
        if folded[1].kind == "const":
            return Node("const", (_item(constant, folded[1].parts[0]),))
    return Node(kind, folded)


def _fold_body(body: tuple[Node, ...], filters: dict[str, Callable]) -> tuple[Node, ...]:
    out: list[Node] = []
    for node in body:
        node = fold(node, filters)
        for part in node.parts[0] if node.kind == "block" else (node,):
            if part.kind == "text" and out and out[-1].kind == "text":
                out[-1] = Node("text", (out[-1].parts[0] + part.parts[0],))
            elif part != Node("text", ("",)):
                out.append(part)
    return tuple(out)


# ---------------------------------------------------------------- closures
class Output:
    """Text written so far and the stretches of it that lie in generation blocks, in code points."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.size = 0
        self.marked: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.size += len(text)


def _value(node: Node, filters: dict[str, Callable]) -> Callable[[dict], object]:
    kind, parts = node.kind, node.parts
    if kind == "const":
        constant = parts[0]
        return lambda scope: constant
    if kind == "name":
        name = parts[0]
        return lambda scope: scope.get(name)
    if kind == "binary":
        run, a, b = _BINARY[parts[0]], _value(parts[1], filters), _value(parts[2], filters)
        return lambda scope: run(a(scope), b(scope))
    if kind == "filter":
        change, inner = filters[parts[0]], _value(parts[1], filters)
        return lambda scope: change(inner(scope))
    made = [_value(p, filters) for p in parts]
    a, b = made[0], made[-1]
    if kind == "item":
        if parts[1].kind == "const":
            key = parts[1].parts[0]
            return lambda scope: _item(a(scope), key)
        return lambda scope: _item(a(scope), b(scope))
    if kind == "not":
        return lambda scope: not a(scope)
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    chosen = made[1]  # pick
    return lambda scope: chosen(scope) if a(scope) else b(scope)


def _body(nodes: tuple[Node, ...], filters: dict[str, Callable]) -> Callable[[dict, Output], None]:
    steps = [_step(n, filters) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(scope: dict, out: Output) -> None:
        for step in steps:
            step(scope, out)

    return run


def _step(node: Node, filters: dict[str, Callable]) -> Callable[[dict, Output], None]:
    kind, parts = node.kind, node.parts
    if kind == "text":
        text = parts[0]
        return lambda scope, out: out.write(text)
    if kind == "write":
        value = _value(parts[0], filters)
        return lambda scope, out: out.write(_text(value(scope)))
    if kind == "set":
        name, value = parts[0], _value(parts[1], filters)
        return lambda scope, out: scope.__setitem__(name, value(scope))
    if kind == "generation":
        inside = _body(parts[0], filters)

        def mark(scope: dict, out: Output) -> None:
            start = out.size
            inside(scope, out)
            out.marked.append((start, out.size))

        return mark
    if kind == "branches":
        branches = [(_value(test, filters), _body(body, filters)) for test, body in parts]

        def choose(scope: dict, out: Output) -> None:
            for test, body in branches:
                if test(scope):
                    body(scope, out)
                    return

        return choose
    name, values, body = parts[0], _value(parts[1], filters), _body(parts[2], filters)  # for

    def loop(scope: dict, out: Output) -> None:
        items = values(scope)
        items = items if isinstance(items, list) else []
        last = len(items) - 1
        for i, item in enumerate(items):
            place = {"index": i + 1, "index0": i, "first": i == 0, "last": i == last, "length": last + 1}
            body({**scope, name: item, "loop": place}, out)

    return loop


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[..., Output]:
    """A function from named values to their rendering."""
    known = {**_FILTERS, **(filters or {})}
    run = _body(fold(parse(source), known).parts[0], known)

    def render(**values: object) -> Output:
        out = Output()
        run(dict(values), out)
        return out

    return render
