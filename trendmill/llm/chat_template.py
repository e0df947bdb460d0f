"""A compiler for a small, sandboxed template language: text to syntax tree, folded, to Python closures.

    {{ expression }}                                   output
    {% for x in list %} ... {% endfor %}               loop.index, loop.first, loop.last inside
    {% if a %} ... {% elif b %} ... {% else %} ... {% endif %}
    {% set x = expression %}
    {% generation %} ... {% endgeneration %}           what a model is to learn to write
    {# comment #}                                      and {%- -%}, {{- -}} take away the white space beside them

Expressions have literals, names, entries (a.b, a["b"]), + ~ == != < <= > >= in, not, and, or, "x if c else y", and filters
from FILTERS. There are no calls and no attributes of Python objects, so a template reaches nothing but its input.
A compiled template is a generator over pieces (text, learned); a list it loops over may be an iterator and is then
read one element ahead, never whole.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#-?.*?-?#\})", re.S)
_LEXEME = re.compile(r"""\s*(?:
    (?P<number>\d+) | (?P<name>[A-Za-z_]\w*) | (?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')
    | (?P<sign>==|!=|<=|>=|[-+~<>|.()\[\]=])
)""", re.X | re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_CONSTANTS = {"true": True, "false": False, "none": None}
_WORDS = {"and", "or", "not", "in", "if", "else"}


class TemplateError(ValueError):
    pass


def escape_control(text: str) -> str:
    """Make control strings harmless: no "<|" is left, and ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    """The same for a text that must stay on one line."""
    return escape_control(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable] = {
    "escape_control": escape_control, "escape_line": escape_line, "trim": lambda x: x.strip(),
    "lower": lambda x: x.lower(), "upper": lambda x: x.upper(), "length": len, "string": lambda x: _text(x),
}
_BINARY = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt,
           ">=": operator.ge, "+": operator.add, "~": lambda a, b: _text(a) + _text(b),
           "in": lambda a, b: a in b, "not in": lambda a, b: a not in b}


def _text(value) -> str:
    if value is None:
        return ""
    return str(value).lower() if isinstance(value, bool) else str(value)


# --- the syntax tree -------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Entry:
    of: object
    key: object


@dataclass(frozen=True)
class Binary:
    sign: str
    left: object
    right: object


@dataclass(frozen=True)
class Logic:
    sign: str
    parts: tuple


@dataclass(frozen=True)
class Choice:
    test: object
    then: object
    other: object


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Loop:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Branch:
    cases: tuple
    other: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- reading ---------------------------------------------------------------------------------------------------------

class _Expression:
    def __init__(self, source: str):
        self.lexemes: list[tuple[str, str]] = []
        at = 0
        while at < len(source.rstrip()):
            m = _LEXEME.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.lexemes.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else (None, None)
        return None if kind == "text" else value

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and self.peek() is not None:
            self.at += 1
            return self.lexemes[self.at - 1][1]
        return None

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise TemplateError(f"{sign!r} expected")

    def end(self):
        if self.at < len(self.lexemes):
            raise TemplateError(f"unexpected {self.lexemes[self.at][1]!r}")

    def whole(self):
        value = self.choice()
        self.end()
        return value

    def choice(self):
        value = self.either()
        if self.take("if"):
            test = self.either()
            return Choice(test, value, self.choice() if self.take("else") else Const(None))
        return value

    def either(self):
        parts = [self.both()]
        while self.take("or"):
            parts.append(self.both())
        return parts[0] if len(parts) == 1 else Logic("or", tuple(parts))

    def both(self):
        parts = [self.negated()]
        while self.take("and"):
            parts.append(self.negated())
        return parts[0] if len(parts) == 1 else Logic("and", tuple(parts))

    def negated(self):
        return Logic("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        value = self.joined()
        while True:
            sign = self.take("==", "!=", "<", "<=", ">", ">=", "in")
            if not sign and self.take("not"):
                self.need("in")
                sign = "not in"
            if not sign:
                return value
            value = Binary(sign, value, self.joined())

    def joined(self):
        value = self.filtered()
        while sign := self.take("+", "~"):
            value = Binary(sign, value, self.filtered())
        return value

    def filtered(self):
        value = self.entry()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Filter(name, value)
        return value

    def entry(self):
        value = self.atom()
        while sign := self.take(".", "["):
            if sign == ".":
                value = Entry(value, Const(self.name()))
            else:
                value = Entry(value, self.choice())
                self.need("]")
        return value

    def name(self) -> str:
        kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else (None, "the end")
        if kind != "name" or value in _WORDS:
            raise TemplateError(f"a name expected, not {value!r}")
        self.at += 1
        return value

    def atom(self):
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else (None, "the end")
        if kind == "number":
            self.at += 1
            return Const(int(value))
        if kind == "text":
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        name = self.name()
        return Const(_CONSTANTS[name]) if name in _CONSTANTS else Name(name)


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    parts = _TAG.split(source)
    for i in range(1, len(parts), 2):
        tag = parts[i]
        if tag[2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if tag[-3] == "-" and len(tag) > 4:
            parts[i + 1] = parts[i + 1].lstrip()
    tree, rest, end = _statements(parts, 0, ())
    if rest < len(parts):
        raise TemplateError(f"{end!r} without a beginning")
    return tree


def _statements(parts: list[str], at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
    """(statements up to a tag of ``ends``, the place of that tag, its content)."""
    found = []
    while at < len(parts):
        part = parts[at]
        if at % 2 == 0:
            if part:
                found.append(Output(Const(part)))
            at += 1
            continue
        content = part[2:-2].removeprefix("-").removesuffix("-").strip()
        if part.startswith("{#"):
            at += 1
        elif part.startswith("{{"):
            found.append(Output(_Expression(content).whole()))
            at += 1
        else:
            word, _, rest = content.partition(" ")
            if word in ends or word in ("endfor", "endif", "elif", "else", "endgeneration"):
                return tuple(found), at, content
            statement, at = _statement(parts, at, word, rest)
            found.append(statement)
    if ends:
        raise TemplateError(f"{ends[-1]!r} is missing")
    return tuple(found), at, ""


def _block(parts: list[str], at: int, *ends: str) -> tuple[tuple, int, str]:
    body, at, content = _statements(parts, at, ends)
    if content.partition(" ")[0] not in ends:
        raise TemplateError(f"{ends[-1]!r} expected, not {content!r}")
    return body, at, content


def _statement(parts: list[str], at: int, word: str, rest: str) -> tuple[object, int]:
    if word == "generation":
        body, at, _ = _block(parts, at + 1, "endgeneration")
        return Generation(body), at + 1
    if word == "set":
        expression = _Expression(rest)
        name = expression.name()
        expression.need("=")
        return Assign(name, expression.whole()), at + 1
    if word == "for":
        expression = _Expression(rest)
        name = expression.name()
        expression.need("in")
        over = expression.whole()
        body, at, _ = _block(parts, at + 1, "endfor")
        return Loop(name, over, body), at + 1
    if word == "if":
        cases, other, content = [], (), f"if {rest}"
        while content.startswith(("if ", "elif ")):
            test = _Expression(content.partition(" ")[2]).whole()
            body, at, content = _block(parts, at + 1, "elif", "else", "endif")
            cases.append((test, body))
        if content == "else":
            other, at, content = _block(parts, at + 1, "endif")
        return Branch(tuple(cases), other), at + 1
    raise TemplateError(f"no statement {word!r}")


# --- folding ---------------------------------------------------------------------------------------------------------

def _folded(do: Callable, values: tuple, node):
    """The result as a constant; what cannot be worked out stays, and fails only if it is reached."""
    try:
        return Const(do(*values))
    except (TypeError, AttributeError):
        return node


def fold(node):
    """The tree with constant parts worked out; neighbouring texts become one, branches never taken go."""
    if isinstance(node, tuple):
        out: list = []
        for statement in map(fold, node):
            for s in statement if isinstance(statement, tuple) else (statement,):
                if isinstance(s, Output) and isinstance(s.value, Const):
                    s = Output(Const(_text(s.value.value)))
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                        out[-1] = Output(Const(out[-1].value.value + s.value.value))
                        continue
                    if not s.value.value:
                        continue
                out.append(s)
        return tuple(out)
    if isinstance(node, Entry):
        return Entry(fold(node.of), fold(node.key))
    if isinstance(node, Binary):
        left, right = fold(node.left), fold(node.right)
        if isinstance(left, Const) and isinstance(right, Const):
            return _folded(_BINARY[node.sign], (left.value, right.value), Binary(node.sign, left, right))
        return Binary(node.sign, left, right)
    if isinstance(node, Filter):
        of = fold(node.of)
        if isinstance(of, Const):
            return _folded(FILTERS[node.name], (of.value,), Filter(node.name, of))
        return Filter(node.name, of)
    if isinstance(node, Logic):
        parts = tuple(map(fold, node.parts))
        if all(isinstance(p, Const) for p in parts):
            return Const(_logic(node.sign, [lambda _, v=p.value: v for p in parts])(None))
        return Logic(node.sign, parts)
    if isinstance(node, Choice):
        test, then, other = fold(node.test), fold(node.then), fold(node.other)
        if isinstance(test, Const):
            return then if test.value else other
        return Choice(test, then, other)
    if isinstance(node, Output):
        return Output(fold(node.value))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, Branch):
        cases = []
        for test, body in node.cases:
            test = fold(test)
            if isinstance(test, Const) and test.value:
                return Branch(tuple(cases), fold(body)) if cases else fold(body)
            if not isinstance(test, Const):
                cases.append((test, fold(body)))
        return Branch(tuple(cases), fold(node.other)) if cases else fold(node.other)
    return node


# --- closures --------------------------------------------------------------------------------------------------------

def _logic(sign: str, parts: list[Callable]) -> Callable:
    if sign == "not":
        return lambda env: not parts[0](env)

    def run(env):
        for p in parts:
            value = p(env)
            if bool(value) == (sign == "or"):
                return value
        return value
    return run


def _entry(of, key):
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple)) and isinstance(key, int):
        return of[key]
    raise TemplateError(f"no entry {key!r} in {type(of).__name__}")


def _value(node) -> Callable:
    """A closure that works an expression out in an environment."""
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        def look(env, name=node.name):
            if name not in env:
                raise TemplateError(f"{name!r} is not defined")
            return env[name]
        return look
    if isinstance(node, Entry):
        of, key = _value(node.of), _value(node.key)
        return lambda env: _entry(of(env), key(env))
    if isinstance(node, Binary):
        left, right, do = _value(node.left), _value(node.right), _BINARY[node.sign]
        return lambda env: do(left(env), right(env))
    if isinstance(node, Filter):
        of, do = _value(node.of), FILTERS[node.name]
        return lambda env: do(of(env))
    if isinstance(node, Logic):
        return _logic(node.sign, [_value(p) for p in node.parts])
    if isinstance(node, Choice):
        test, then, other = _value(node.test), _value(node.then), _value(node.other)
        return lambda env: then(env) if test(env) else other(env)
    raise TemplateError(f"not an expression: {node!r}")


def _run(node) -> Callable:
    """A closure that makes a generator of the pieces of a statement, or of a tuple of them."""
    if isinstance(node, tuple):
        steps = [_run(s) for s in node]

        def each(env, learned):
            for step in steps:
                yield from step(env, learned)
        return each
    if isinstance(node, Output):
        value = _value(node.value)

        def output(env, learned):
            if text := _text(value(env)):
                yield text, learned
        return output
    if isinstance(node, Assign):
        value = _value(node.value)

        def assign(env, learned):
            env[node.name] = value(env)
            yield from ()
        return assign
    if isinstance(node, Generation):
        body = _run(node.body)
        return lambda env, learned: body(env, True)
    if isinstance(node, Branch):
        cases = [(_value(test), _run(body)) for test, body in node.cases]
        other = _run(node.other)

        def branch(env, learned):
            for test, body in cases:
                if test(env):
                    yield from body(env, learned)
                    return
            yield from other(env, learned)
        return branch
    if isinstance(node, Loop):
        over, body = _value(node.over), _run(node.body)

        def loop(env, learned):
            items, index, nothing = iter(over(env)), 0, object()
            item = next(items, nothing)
            while item is not nothing:
                following = next(items, nothing)
                index += 1
                inner = {**env, node.name: item, "loop": {
                    "index": index, "index0": index - 1, "first": index == 1, "last": following is nothing}}
                yield from body(inner, learned)
                item = following
        return loop
    raise TemplateError(f"not a statement: {node!r}")


def compile_template(source: str) -> Callable[..., Iterator[tuple[str, bool]]]:
    """A function of the template's input names that generates (text, learned) pieces."""
    render = _run(fold(parse(source)))
    return lambda **names: render(dict(names), False)
