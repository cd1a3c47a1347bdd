"""Chat formatting: a template compiler for conversations.

A template is text with ``{{ expression }}`` and ``{% statement %}`` parts (``-`` inside a tag strips the whitespace
beside it).  Statements: ``for x in e``, ``if / elif / else``, ``set x = e``, and ``generation ... endgeneration``, which
marks what a model should learn.  Expressions: literals, names, ``a.b``, ``a['b']``, ``a[0]``, ``loop.index`` (also
index0, first, last), ``+ ~ == != < <= > >= and or not in``, ``x if c else y``, and the filters ``trim upper lower length
first last default(x)``.  Templates are sandboxed: there are no calls, no Python attributes, and only data that was
passed in is reachable.

Templates are parsed into a syntax tree, whose constant parts are folded, and become nested Python closures; each worker
compiles a template once.

No data makes a template fail: a missing or NULL value is '' in text, 0 beside a number in ``+``, of length 0, in nothing and without
order; ``+`` of a number and a text joins them as text; ``for`` over what is no list does nothing.

Defined results of :func:`render`: turns go by (turn, role, text), a NULL turn first, so ties and repeated rows have an order; NULL
role and text read as ''; a NULL ``conv_id`` is one conversation; very long texts are kept whole; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import ship

CHATML = (
    "{% for m in messages %}{{ '<|im_start|>' + m.role + '\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | trim }}{{ '<|im_end|>' }}{% endgeneration %}"
    "{% else %}{{ m.text | trim }}{{ '<|im_end|>' }}{% endif %}{{ '\n' }}{% endfor %}"
)
_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>.()\[\]|,=]))", re.S)
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_WHITE = " \t\r\n"


def _text(x) -> str:
    return "" if x is None else str(x)


def _plus(a, b):
    if isinstance(a, list) and isinstance(b, list):
        return a + b
    if all(x is None or isinstance(x, (int, float)) for x in (a, b)) and not a is b is None:
        return (a or 0) + (b or 0)
    return _text(a) + _text(b)


def _compared(how: Callable) -> Callable:
    """Numbers with numbers and texts with texts; nothing else is less or greater."""

    def run(a, b) -> bool:
        alike = (isinstance(a, str) and isinstance(b, str)) or (isinstance(a, (int, float)) and isinstance(b, (int, float)))
        return alike and how(a, b)

    return run


def _inside(a, b) -> bool:
    if isinstance(b, str):
        return _text(a) in b
    return isinstance(b, (list, dict)) and a in list(b)


_FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(_WHITE), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(),
    "length": lambda x: len(x) if isinstance(x, (str, list, dict)) else len(_text(x)),
    "first": lambda x: (x[0] if x else "") if isinstance(x, (str, list)) else _text(x), "last": lambda x: (x[-1] if x else "") if isinstance(x, (str, list)) else _text(x),
    "default": lambda x, d: d if x is None or x == "" else x,
}
_OPERATORS: dict[str, Callable] = {
    "+": _plus, "~": lambda a, b: _text(a) + _text(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": _compared(lambda a, b: a < b), "<=": _compared(lambda a, b: a <= b), ">": _compared(lambda a, b: a > b), ">=": _compared(lambda a, b: a >= b),
    "in": _inside, "not in": lambda a, b: not _inside(a, b),
}


class TemplateError(ValueError):
    """The template is not in the language, or reaches for what it may not."""


def _field(value, key):
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, list) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    if value is None:
        return None
    raise TemplateError(f"{type(value).__name__} has no field {key!r}")


class _Expression:
    """Recursive descent over one tag's tokens; nodes are tuples, of which ("const", value) is folded."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected text: {source[at : at + 20]!r}")
            number, single, double, name, sign = m.groups()
            at = m.end()
            if number:
                self.tokens.append(("const", int(number)))
            elif single is not None or double is not None:
                raw = single if single is not None else double
                self.tokens.append(("const", re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t", "r": "\r"}.get(x[1], x[1]), raw, flags=re.S)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
        self.at = 0

    def peek(self) -> tuple[str, object]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *values: object) -> object | None:
        kind, value = self.peek()
        if kind in ("name", "sign") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if self.take(value) is None:
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name" or value in _WORDS or str(value).startswith("_"):
            raise TemplateError(f"not a name: {value!r}")
        self.at += 1
        return str(value)

    def whole(self) -> tuple:
        node = self.ternary()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def ternary(self) -> tuple:
        node = self.either()
        if self.take("if"):
            test = self.either()
            other = self.ternary() if self.take("else") else ("const", "")
            return fold(("if", test, node, other))
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = fold(("or", node, self.both()))
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = fold(("and", node, self.negated()))
        return node

    def negated(self) -> tuple:
        return fold(("not", self.negated())) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.sum()
        while True:
            op = self.take("==", "!=", "<", "<=", ">", ">=", "in")
            if op is None and self.take("not"):
                self.need("in")
                op = "not in"
            if op is None:
                return node
            node = fold(("op", op, node, self.sum()))

    def sum(self) -> tuple:
        node = self.filtered()
        while op := self.take("+", "~"):
            node = fold(("op", op, node, self.filtered()))
        return node

    def filtered(self) -> tuple:
        node = self.postfix()
        while self.take("|"):
            name, args = self.name(), []
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.take("("):
                args.append(self.ternary())
                self.need(")")
            if len(args) != (name == "default"):
                raise TemplateError(f"wrong number of arguments for {name}")
            node = fold(("filter", name, node, *args))
        return node

    def postfix(self) -> tuple:
        kind, value = self.peek()
        if self.take("("):
            node = self.ternary()
            self.need(")")
        elif kind == "const" or (kind == "name" and value in _WORDS):
            self.at += 1
            node = ("const", value if kind == "const" else _WORDS[value])
        else:
            node = ("name", self.name())
        while True:
            if self.take("."):
                node = fold(("field", node, ("const", self.name())))
            elif self.take("["):
                minus = self.take("-")
                key = self.ternary()
                node = fold(("field", node, ("const", -key[1]) if minus and key[0] == "const" else key))
                self.need("]")
            else:
                return node


def fold(node: tuple) -> tuple:
    """The node, or its value as a constant if all it depends on is constant."""
    kind, *rest = node
    parts = [x for x in rest if isinstance(x, tuple)]
    if kind in ("if", "and", "or") and parts[0][0] == "const":
        truth = bool(parts[0][1])
        if kind == "if":
            return parts[1] if truth else parts[2]
        return parts[1] if truth == (kind == "and") else parts[0]
    if parts and all(x[0] == "const" for x in parts):
        try:
            return ("const", expression(node)({}))
        except (TypeError, IndexError) as e:
            raise TemplateError(str(e)) from e
    return node


def expression(node: tuple) -> Callable[[dict], object]:
    """A closure that evaluates the node in a scope."""
    kind, *rest = node
    if kind == "const":
        value = rest[0]
        return lambda scope: value
    if kind == "name":
        name = rest[0]
        return lambda scope: scope.get(name)
    if kind == "field":
        of, key = map(expression, rest)
        return lambda scope: _field(of(scope), key(scope))
    if kind == "op":
        run, (a, b) = _OPERATORS[rest[0]], map(expression, rest[1:])
        return lambda scope: run(a(scope), b(scope))
    if kind == "filter":
        run, (of, *args) = _FILTERS[rest[0]], map(expression, rest[1:])
        return lambda scope: run(of(scope), *[a(scope) for a in args])
    if kind == "not":
        (a,) = map(expression, rest)
        return lambda scope: not a(scope)
    a, b, *c = map(expression, rest)
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    return lambda scope: b(scope) if a(scope) else c[0](scope)


def parse(template: str) -> list[tuple]:
    """Syntax tree: ("text", s), ("out", e), ("for", name, e, body), ("if", [(e, body)]), ("set", name, e), ("generation", body)."""
    pieces: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _TAG.finditer(template):
        lead = template[at : m.start()]
        at = m.end()
        lead = lead.lstrip() if strip else lead
        if m[1] or m[4]:
            lead = lead.rstrip()
        strip = bool(m[3] or m[6])
        pieces.append(("text", lead))
        if m[2] is not None:
            pieces.append(("out", m[2]))
        elif m[5] is not None:
            pieces.append(("tag", m[5].strip()))
    pieces.append(("text", template[at:].lstrip() if strip else template[at:]))
    body, end = _block(iter(pieces), ())
    return body


def _block(pieces: Iterator[tuple[str, str]], ends: tuple[str, ...]) -> tuple[list[tuple], str]:
    body: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "out" and node[1][0] == "const":
            node = ("text", _text(node[1][1]))
        if node[0] == "text" and body and body[-1][0] == "text":
            body[-1] = ("text", body[-1][1] + node[1])
        elif node != ("text", ""):
            body.append(node)

    for kind, source in pieces:
        if kind == "text":
            add(("text", source))
        elif kind == "out":
            add(("out", _Expression(source).whole()))
        else:
            word, _, rest = source.partition(" ")
            if word in ends:
                return body, source
            if word == "for":
                e = _Expression(rest)
                name = e.name()
                e.need("in")
                add(("for", name, e.whole(), _block(pieces, ("endfor",))[0]))
            elif word == "if":
                arms = []
                while True:
                    inner, end = _block(pieces, ("elif", "else", "endif"))
                    arms.append((_Expression(rest).whole() if rest else ("const", True), inner))
                    word, _, rest = end.partition(" ")
                    if word == "endif":
                        break
                    rest = rest if word == "elif" else ""
                add(_fold_if(arms))
            elif word == "set":
                e = _Expression(rest)
                name = e.name()
                e.need("=")
                add(("set", name, e.whole()))
            elif word == "generation":
                add(("generation", _block(pieces, ("endgeneration",))[0]))
            else:
                raise TemplateError(f"unknown tag {word!r}")
    if ends:
        raise TemplateError(f"missing {' or '.join(ends)}")
    return body, ""


def _fold_if(arms: list[tuple]) -> tuple:
    live = []
    for test, body in arms:
        if test[0] == "const" and not test[1]:
            continue
        live.append((test, body))
        if test[0] == "const":
            break
    return ("if", live) if live else ("text", "")


class Output:
    """Rendered text and the character spans inside generation blocks."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size, self.spans = 0, []

    def write(self, s: str) -> None:
        self.parts.append(s)
        self.size += len(s)


def _statement(node: tuple) -> Callable[[dict, Output], None]:
    kind, *rest = node
    if kind == "text":
        s = rest[0]
        return lambda scope, out: out.write(s)
    if kind == "out":
        value = expression(rest[0])
        return lambda scope, out: out.write(_text(value(scope)))
    if kind == "set":
        name, value = rest[0], expression(rest[1])

        def assign(scope: dict, out: Output) -> None:
            scope[name] = value(scope)

        return assign
    if kind == "generation":
        inside = _sequence(rest[0])

        def mark(scope: dict, out: Output) -> None:
            start = out.size
            inside(scope, out)
            if out.size > start:
                out.spans.append((start, out.size))

        return mark
    if kind == "for":
        name, items, run = rest[0], expression(rest[1]), _sequence(rest[2])

        def loop(scope: dict, out: Output) -> None:
            values = items(scope)
            values = values if isinstance(values, list) else []
            for i, value in enumerate(values):
                at = {"index": i + 1, "index0": i, "first": i == 0, "last": i + 1 == len(values)}
                run(scope | {name: value, "loop": at}, out)

        return loop
    arms = [(expression(test), _sequence(body)) for test, body in rest[0]]

    def choose(scope: dict, out: Output) -> None:
        for test, run in arms:
            if test(scope):
                run(scope, out)
                return

    return choose


def _sequence(body: list[tuple]) -> Callable[[dict, Output], None]:
    runs = [_statement(n) for n in body]

    def all_of(scope: dict, out: Output) -> None:
        for run in runs:
            run(scope, out)

    return all_of


def compile_template(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from the template's variables to (text, spans to learn)."""
    run = _sequence(parse(template))

    def rendered(values: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(values), out)
        return "".join(out.parts), out.spans

    return rendered


def render(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """``conv_id, n_turns, text, spans``: every conversation as text; ``spans`` lists generation markers "start-end" by ';'.

    One shuffle by ``conv_id`` gathers the turns JVM-side; rendering maps Arrow batches of whole conversations.
    """
    ship(conversations.sparkSession)
    compile_template(template)  # errors come at once, on the driver
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("messages"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        go = compile_template(template)
        for pdf in frames:
            done = [go({"messages": [{"turn": m["turn"], "role": m["role"], "text": m["text"]} for m in ms]}) for ms in pdf["messages"]]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "n_turns": pdf["messages"].map(len), "text": [d[0] for d in done], "spans": [";".join(f"{a}-{b}" for a, b in d[1]) for d in done]})

    return gathered.mapInPandas(run, "conv_id long, n_turns long, text string, spans string")


CHATML_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, trim(coalesce(text, ''), E' \t\r\n') AS body, coalesce(text, '') AS raw FROM conversations),
p AS (
  SELECT *, '<|im_start|>' || role || chr(10) AS head, body || '<|im_end|>' AS tail FROM m),
l AS (
  SELECT *, coalesce(sum(length(head) + length(tail) + 1) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, raw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM p)
SELECT conv_id, count(*) AS n_turns, string_agg(head || tail || chr(10), '' ORDER BY turn NULLS FIRST, role, raw) AS text,
  coalesce(string_agg(CAST(base + length(head) AS BIGINT)::VARCHAR || '-' || CAST(base + length(head) + length(tail) AS BIGINT)::VARCHAR, ';' ORDER BY turn NULLS FIRST, role, raw) FILTER (WHERE role = 'assistant'), '') AS spans
FROM l GROUP BY conv_id
"""
