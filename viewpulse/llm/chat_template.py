"""A small, sandboxed template language for conversations, compiled to Python closures.

A template has literal text, ``{{ expression }}``, and the statements ``for``, ``if``/``elif``/``else``,
``set`` and ``generation`` in ``{% ... %}`` (a ``-`` inside a tag's edge strips white space beside it).  It has one loop, ``for m in
messages``; what stands before and after it can't refer to messages.  Expressions know strings, whole numbers,
``true``, ``false``, ``none``, fields of the message (``m.role`` or ``m['role']``), ``loop.index``, ``loop.index0``, ``loop.first``,
``loop.last``, the constants given to ``compile_template``, variables of ``set`` (which live
for one message), ``+``, ``~``, ``==``, ``!=``, ``in``, ``and``, ``or``, ``not``, the choice ``a if b else c`` and the filters of ``FILTERS``.  There are no calls, no attributes
of Python objects and no inner loops, so a template can neither reach out of its message nor run for
long.  Anything else is a ``TemplateError`` when the template is compiled.

Parsing gives a syntax tree; folding works out what depends on constants alone, drops branches
that can't be taken and joins literal text; each node left becomes a closure.  As a message's text
depends only on the message and its place, messages can be rendered apart from each other.

``escape`` makes control strings inside a text harmless: a backslash goes behind the first character of each
(``[INST]`` becomes ``[\\INST]``), also where some are there already, so that ``unescape`` takes back exactly what was put in.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field


class TemplateError(ValueError):
    """The template isn't one of this language."""


class Escaper:
    """Escapes control strings reversibly.

    A control string has two characters or more, no backslash, and its first character occurs in no control string again, so
    that no two can overlap.
    """

    def __init__(self, controls: list[str]):
        firsts = {c[:1] for c in controls}
        if any(len(c) < 2 or "\\" in c or firsts & set(c[1:]) for c in controls):
            raise TemplateError("a control string is too short, has a backslash or the first character of one inside")
        by_first = [f"{re.escape(f)}(\\\\*)(?={'|'.join(re.escape(c[1:]) for c in sorted(controls) if c[0] == f)})" for f in sorted(firsts)]
        self._put = re.compile("|".join(by_first))
        self._took = re.compile("|".join(p.replace("(\\\\*)", "(\\\\+)") for p in by_first))
        self.marks = re.compile("|".join(re.escape(c) for c in sorted(controls)))

    def escape(self, text: str) -> str:
        return self._put.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._took.sub(lambda m: m[0][0] + m[0][2:], text)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "capitalize": lambda v: _text(v).capitalize(),
    "length": lambda v: len(_text(v)),
}
LOOP_FIELDS = ("index", "index0", "first", "last")


def _text(value) -> str:
    if value is None:
        return ""
    return "true" if value is True else "false" if value is False else str(value)


# --- syntax tree -------------------------------------------------------------------


@dataclass
class Const:
    value: object


@dataclass
class Field:
    name: str


@dataclass
class Loop:
    name: str


@dataclass
class Variable:
    name: str


@dataclass
class Apply:
    """A filter or operator: a pure function of its parts."""

    name: str
    parts: list


@dataclass
class Choice:
    condition: object
    yes: object
    no: object


@dataclass
class Show:
    expression: object


@dataclass
class Assign:
    name: str
    expression: object


@dataclass
class Branch:
    cases: list[tuple[object, list]]  # (condition, body); the last condition may be Const(True)


@dataclass
class Generation:
    body: list


@dataclass
class Each:
    name: str
    body: list


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "in": lambda a, b: _text(a) in _text(b),
    "not": lambda a: not a,
}

_TAG = re.compile(r"(\{\{-?|\{%-?)(.*?)(-?\}\}|-?%\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[()\[\].|~+=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Parser:
    def __init__(self, source: str, constants: dict[str, object], filters: dict[str, Callable]):
        self.constants, self.filters, self.message = constants, filters, None
        self.pieces, at, strip = [], 0, False
        for m in _TAG.finditer(source):
            if m[1][:2] == "{{" and not m[3].endswith("}}") or m[1][:2] == "{%" and not m[3].endswith("%}"):
                raise TemplateError(f"tag isn't closed as it was opened: {m[0]}")
            text = source[at : m.start()]
            text = text.lstrip() if strip else text
            self.pieces.append(("text", text.rstrip() if m[1].endswith("-") else text))
            self.pieces.append(("show" if m[1][:2] == "{{" else "do", m[2]))
            at, strip = m.end(), m[3].startswith("-")
        rest = source[at:]
        self.pieces.append(("text", rest.lstrip() if strip else rest))
        for kind, text in self.pieces:
            if kind == "text" and re.search(r"\{\{|\{%|%\}|\}\}", text):
                raise TemplateError(f"unfinished tag in {text[:40]!r}")
        self.at = 0

    # statements

    def body(self, *ends: str) -> tuple[list, str]:
        """Nodes up to a statement that begins with one of ``ends``; that statement's text."""
        nodes = []
        while self.at < len(self.pieces):
            kind, text = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(Show(Const(text)))
            elif kind == "show":
                nodes.append(Show(self.expression(text)))
            else:
                word, _, rest = text.strip().partition(" ")
                if word in ends:
                    return nodes, text.strip()
                nodes.append(self.statement(word, rest.strip()))
        if ends:
            raise TemplateError(f"no {' or '.join(ends)}")
        return nodes, ""

    def statement(self, word: str, rest: str):
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest)
            if not m or self.message:
                raise TemplateError(f"only one loop, over messages: for {rest}")
            self.message = m[1]
            nodes, _ = self.body("endfor")
            self.message = None
            return Each(m[1], nodes)
        if word == "if":
            cases, condition = [], self.expression(rest)
            while True:
                nodes, end = self.body("elif", "else", "endif")
                cases.append((condition, nodes))
                if end == "endif":
                    return Branch(cases)
                condition = Const(True) if end == "else" else self.expression(end[4:])
        if word == "generation" and not rest:
            return Generation(self.body("endgeneration")[0])
        m = re.fullmatch(r"([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)
        if word == "set" and m and self.message and m[1] not in (*self.constants, self.message, "loop", "messages"):
            return Assign(m[1], self.expression(m[2]))
        raise TemplateError(f"unknown statement: {word} {rest}")

    # expressions, loosest first

    def expression(self, text: str):
        self.tokens, at = [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"can't read {text[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.tokens.append(("end", ""))
        node = self.choice()
        if self.tokens[0][0] != "end":
            raise TemplateError(f"can't read {self.tokens[0][1]!r} in {text!r}")
        return node

    def take(self, *values: str) -> str | None:
        kind, value = self.tokens[0]
        if kind in ("mark", "name") and value in values:
            self.tokens.pop(0)
            return value
        return None

    def expect(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected before {self.tokens[0][1]!r}")

    def choice(self):
        node = self.any_of()
        if self.take("if"):
            condition = self.any_of()
            node = Choice(condition, node, self.choice() if self.take("else") else Const(None))
        return node

    def any_of(self):
        node = self.all_of()
        while self.take("or"):
            node = Choice(node, node, self.all_of())
        return node

    def all_of(self):
        node = self.negated()
        while self.take("and"):
            node = Choice(node, self.negated(), node)
        return node

    def negated(self):
        return Apply("not", [self.negated()]) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        while op := self.take("==", "!=", "in"):
            node = Apply(op, [node, self.joined()])
        return node

    def joined(self):
        node = self.filtered()
        while op := self.take("+", "~"):
            node = Apply(op, [node, self.filtered()])
        return node

    def filtered(self):
        node = self.atom()
        while self.take("|"):
            kind, name = self.tokens.pop(0)
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            node = Apply("|" + name, [node])
        return node

    def member(self) -> str:
        if self.take("."):
            kind, name = self.tokens.pop(0)
            if kind == "name":
                return name
        elif self.take("["):
            kind, name = self.tokens.pop(0)
            self.expect("]")
            if kind == "string":
                return name[1:-1]
        raise TemplateError("a field's name expected")

    def atom(self):
        kind, value = self.tokens.pop(0)
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if (kind, value) == ("mark", "("):
            node = self.choice()
            self.expect(")")
            return node
        if kind != "name":
            raise TemplateError(f"a value expected before {value!r}")
        if value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        if value in self.constants:
            return Const(self.constants[value])
        if self.message is None:
            raise TemplateError(f"unknown outside the loop: {value}")
        if value == self.message:
            name = self.member()
            if name not in ("role", "text"):
                raise TemplateError(f"messages have no {name}")
            return Field(name)
        if value == "loop":
            name = self.member()
            if name not in LOOP_FIELDS:
                raise TemplateError(f"the loop has no {name}")
            return Loop(name)
        return Variable(value)


# --- folding -----------------------------------------------------------------------


def _fold(node, functions):
    if isinstance(node, Apply):
        parts = [_fold(p, functions) for p in node.parts]
        if all(isinstance(p, Const) for p in parts):
            return Const(functions[node.name](*[p.value for p in parts]))
        return Apply(node.name, parts)
    if isinstance(node, Choice):
        condition = _fold(node.condition, functions)
        if isinstance(condition, Const):
            return _fold(node.yes if condition.value else node.no, functions)
        return Choice(condition, _fold(node.yes, functions), _fold(node.no, functions))
    return node


def fold(nodes: list, functions: dict[str, Callable]) -> list:
    """The same template with constants worked out, dead branches dropped and text joined."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Show) and isinstance(node.expression, Const):
            text = _text(node.expression.value)
            if text and out and isinstance(out[-1], Show) and isinstance(out[-1].expression, Const):
                out[-1] = Show(Const(out[-1].expression.value + text))
            elif text:
                out.append(Show(Const(text)))
        else:
            out.append(node)

    for node in nodes:
        if isinstance(node, Show):
            add(Show(_fold(node.expression, functions)))
        elif isinstance(node, Assign):
            add(Assign(node.name, _fold(node.expression, functions)))
        elif isinstance(node, Generation):
            if body := fold(node.body, functions):
                add(Generation(body))
        elif isinstance(node, Each):
            add(Each(node.name, fold(node.body, functions)))
        else:
            cases = []
            for condition, body in node.cases:
                condition = _fold(condition, functions)
                if isinstance(condition, Const) and not condition.value:
                    continue
                cases.append((condition, fold(body, functions)))
                if isinstance(condition, Const):
                    break
            if cases and isinstance(cases[0][0], Const):
                for inner in cases[0][1]:
                    add(inner)
            elif cases:
                add(Branch(cases))
    return out


# --- closures ----------------------------------------------------------------------


class Output:
    """Pieces of rendered text, and the spans of it that the model is to generate."""

    def __init__(self):
        self.pieces: list[str] = []
        self.chars = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.chars += len(text)


def _value(node, functions) -> Callable:
    """A closure of the environment for an expression."""
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, (Field, Loop, Variable)):
        key = (type(node).__name__, node.name)
        return lambda env: env.get(key)
    if isinstance(node, Choice):
        condition, yes, no = (_value(n, functions) for n in (node.condition, node.yes, node.no))
        return lambda env: yes(env) if condition(env) else no(env)
    function, parts = functions[node.name], [_value(p, functions) for p in node.parts]
    if len(parts) == 1:
        only = parts[0]
        return lambda env: function(only(env))
    left, right = parts
    return lambda env: function(left(env), right(env))


def _action(nodes: list, functions) -> Callable:
    """A closure of environment and output for a body."""
    steps = []
    for node in nodes:
        if isinstance(node, Show):
            if isinstance(node.expression, Const):
                steps.append(lambda env, out, text=node.expression.value: out.write(text))
            else:
                steps.append(lambda env, out, value=_value(node.expression, functions): out.write(_text(value(env))))
        elif isinstance(node, Assign):
            steps.append(lambda env, out, key=("Variable", node.name), value=_value(node.expression, functions): env.__setitem__(key, value(env)))
        elif isinstance(node, Generation):
            def generate(env, out, body=_action(node.body, functions)):
                start = out.chars
                body(env, out)
                out.spans.append((start, out.chars))

            steps.append(generate)
        else:
            def branch(env, out, cases=[(_value(c, functions), _action(b, functions)) for c, b in node.cases]):
                for condition, body in cases:
                    if condition(env):
                        body(env, out)
                        return

            steps.append(branch)

    def run(env, out):
        for step in steps:
            step(env, out)

    return run


def _walk(nodes):
    """All parts of a tree."""
    for node in nodes:
        yield node
        for part in vars(node).values():
            if isinstance(part, list):
                yield from _walk([x for p in part for x in ([p] if not isinstance(p, tuple) else [p[0], *p[1]])])
            elif hasattr(part, "__dataclass_fields__"):
                yield from _walk([part])


@dataclass
class Template:
    """A compiled template: text before the messages, a closure for each message, text after them."""

    before: str
    message: Callable
    after: str
    loop_fields: set[str] = field(default_factory=set)

    def render_message(self, role: str, text: str, loop: dict[str, object] | None = None) -> tuple[str, list[tuple[int, int]]]:
        """The message's piece of the output and the spans of it to generate."""
        env = {("Field", "role"): role, ("Field", "text"): text}
        for name, value in (loop or {}).items():
            env[("Loop", name)] = value
        out = Output()
        self.message(env, out)
        return "".join(out.pieces), out.spans


def compile_template(source: str, constants: dict[str, object] | None = None, escaper: Escaper | None = None) -> Template:
    filters = dict(FILTERS)
    if escaper:
        filters["escape"] = lambda v: escaper.escape(_text(v))
    functions = OPERATORS | {"|" + name: f for name, f in filters.items()}
    parser = _Parser(source, constants or {}, filters)
    nodes = fold(parser.body()[0], functions)
    loops = [i for i, n in enumerate(nodes) if isinstance(n, Each)]
    if len(loops) != 1 or any(isinstance(n, Each) for n in _walk([n for n in nodes if not isinstance(n, Each)])):
        raise TemplateError("a template has one loop over messages, outside of conditions")
    around = nodes[: loops[0]], nodes[loops[0] + 1 :]
    if any(not isinstance(n, Show) for part in around for n in part):
        raise TemplateError("only text may stand beside the loop")
    body = nodes[loops[0]].body
    assigned: set[str] = {n.name for n in _walk(body) if isinstance(n, Assign)}
    if unknown := {n.name for n in _walk(body) if isinstance(n, Variable)} - assigned:
        raise TemplateError(f"unknown names: {', '.join(sorted(unknown))}")
    before, after = ("".join(n.expression.value for n in part) for part in around)
    return Template(before, _action(body, functions), after, {n.name for n in _walk(body) if isinstance(n, Loop)})
