"""Chat formatting with compiled templates.

``compile_template`` parses a small template language into a syntax tree, folds constant expressions and adjacent
texts, and turns the tree into nested Python closures. The language has output ``{{ expr }}``, ``{% for x in expr %}``,
``{% if %} {% elif %} {% else %}``, ``{% set x = expr %}`` and ``{% generation %}``, whose output is marked as written
by the model. Expressions know strings, numbers, lists, names, ``a.b``, ``a['b']``, ``|`` filters, ``+ ~ == != < > in
not and or`` and ``loop.first/last/index``. It is a sandbox: values are plain data, names reach only the template's
own variables, attributes reach only dictionary keys, and nothing is called but the filters below.

``format_conversations`` renders every conversation whole: its text and the code-point spans of its generation marks.
``read_back`` splits formatted text into turns again and takes what the spans cover.

Texts are escaped so that no control string in them can be taken for the template's own: a backslash goes before each
backslash and each control string; in headers also before a line feed. Taking a backslash away undoes it.

Defined cases: a null text or role is empty; rows of equal turn stand in order of role, then text, a null turn last;
rows of a null conversation id form one conversation; a conversation is one output text and so one unit of work; an
empty table gives no rows; columns beyond the named ones are not read.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TEMPLATE = (
    "{% for m in messages %}{{ '<turn>' }}{{ m.role|header }}{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}"
    "{% else %}{{ m.text|escape }}{% endif %}{{ '</turn>' + '\\n' }}{% endfor %}"
)
CONTROLS = ("<turn>", "</turn>")

_SPECIAL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))
_HEADER = re.compile(_SPECIAL.pattern + "|\n")


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": lambda v: escape(str(v)),
    "header": lambda v: _HEADER.sub(lambda m: "\\" + m[0], str(v)),
    "trim": lambda v: str(v).strip(),
    "upper": lambda v: str(v).upper(),
    "lower": lambda v: str(v).lower(),
    "length": len,
}


class TemplateError(ValueError):
    pass


# Syntax tree: tuples of a kind and its parts.

_TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKENS = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>|.,()\[\]]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            kind = ("string", "number", "name", "sign")[m.lastindex - 1]
            value = m[m.lastindex]
            if kind == "string":
                value = re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), value[1:-1], flags=re.S)
            self.tokens.append((kind, int(value) if kind == "number" else value))
            at = m.end()
        self.at = 0

    def next(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("sign", "name") and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.next(value):
            raise TemplateError(f"{value} is missing")

    def whole(self) -> tuple:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.next("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.next("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.next("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        while sign := self.next(*_COMPARE, "in"):
            node = ("in", node, self.joined()) if sign == "in" else ("compare", sign, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while sign := self.next("+", "~", "-"):
            node = ("join", sign, node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.member()
        while self.next("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def member(self) -> tuple:
        node = self.atom()
        while sign := self.next(".", "["):
            if sign == "[":
                node = ("get", node, self.either())
                self.need("]")
            else:
                if self.at == len(self.tokens) or self.tokens[self.at][0] != "name":
                    raise TemplateError("a name must follow the dot")
                node = ("get", node, ("value", self.tokens[self.at][1]))
                self.at += 1
        return node

    def atom(self) -> tuple:
        if self.next("("):
            node = self.either()
            self.need(")")
            return node
        if self.next("["):
            items = []
            while not self.next("]"):
                items.append(self.either())
                if not self.next(","):
                    self.need("]")
                    break
            return ("list", *items)
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind in ("string", "number"):
            return ("value", value)
        if kind == "name":
            constants = {"true": True, "false": False, "none": None}
            return ("value", constants[value]) if value in constants else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces = [p for p in _TAGS.split(source) if p]
    node, rest, end = _body(pieces, 0, ())
    if end:
        raise TemplateError(f"unexpected {end}")
    return node


def _body(pieces: list[str], at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
    nodes: list[tuple] = []
    while at < len(pieces):
        piece = pieces[at]
        at += 1
        if piece.startswith("{{"):
            nodes.append(("out", _Expression(piece[2:-2]).whole()))
        elif not piece.startswith("{%"):
            nodes.append(("text", piece))
        else:
            word, _, rest = piece[2:-2].strip().partition(" ")
            if word in ends:
                return ("block", *nodes), at, piece[2:-2].strip()
            if word == "for":
                m = re.fullmatch(r"\s*(\w+)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {piece}")
                inner, at, _ = _closed(pieces, at, ("endfor",))
                nodes.append(("for", m[1], _Expression(m[2]).whole(), inner))
            elif word == "if":
                arms, condition, end = [], rest, "elif"
                while end.startswith("elif"):
                    inner, at, end = _closed(pieces, at, ("elif", "else", "endif"))
                    arms.append((_Expression(condition).whole(), inner))
                    condition = end[4:]
                other = ("block",)
                if end == "else":
                    other, at, _ = _closed(pieces, at, ("endif",))
                nodes.append(("if", tuple(arms), other))
            elif word == "set":
                name, _, value = rest.partition("=")
                nodes.append(("set", name.strip(), _Expression(value).whole()))
            elif word == "generation":
                inner, at, _ = _closed(pieces, at, ("endgeneration",))
                nodes.append(("generation", inner))
            else:
                raise TemplateError(f"unknown tag {word!r}")
    return ("block", *nodes), at, ""


def _closed(pieces: list[str], at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
    node, at, end = _body(pieces, at, ends)
    if not end:
        raise TemplateError(f"{ends[-1]} is missing")
    return node, at, end


def fold(node: tuple) -> tuple:
    """The tree with constant expressions evaluated, dead branches gone and adjacent texts joined."""
    kind, *parts = node
    if kind in ("value", "name", "text"):
        return node
    if kind == "out":
        inner = fold(parts[0])
        return ("text", _shown(inner[1])) if inner[0] == "value" else ("out", inner)
    if kind == "block":
        out: list[tuple] = []
        for part in map(fold, parts):
            for x in part[1:] if part[0] == "block" else [part]:
                if x[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + x[1])
                elif x != ("text", ""):
                    out.append(x)
        return ("block", *out)
    if kind == "if":
        arms = []
        for condition, inner in parts[0]:
            condition = fold(condition)
            if condition[0] == "value" and condition[1]:
                return ("if", tuple(arms), fold(inner)) if arms else fold(inner)
            if condition[0] != "value":
                arms.append((condition, fold(inner)))
        return ("if", tuple(arms), fold(parts[1])) if arms else fold(parts[1])
    if kind == "for":
        return ("for", parts[0], fold(parts[1]), fold(parts[2]))
    if kind == "set":
        return ("set", parts[0], fold(parts[1]))
    parts = [fold(p) if isinstance(p, tuple) else p for p in parts]
    node = (kind, *parts)
    if kind != "generation" and all(p[0] == "value" for p in parts if isinstance(p, tuple)):
        return ("value", _expression(node)({}))
    return node


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


def _expression(node: tuple) -> Callable[[dict], Any]:
    kind, *parts = node
    if kind == "value":
        value = parts[0]
        return lambda scope: value
    if kind == "name":
        name = parts[0]
        return lambda scope: scope.get(name)
    f = [_expression(p) for p in parts if isinstance(p, tuple)]
    if kind == "list":
        return lambda scope: [x(scope) for x in f]
    if kind == "or":
        return lambda scope: f[0](scope) or f[1](scope)
    if kind == "and":
        return lambda scope: f[0](scope) and f[1](scope)
    if kind == "not":
        return lambda scope: not f[0](scope)
    if kind == "in":
        return lambda scope: f[0](scope) in f[1](scope)
    if kind == "compare":
        compare = _COMPARE[parts[0]]
        return lambda scope: compare(f[0](scope), f[1](scope))
    if kind == "filter":
        apply = FILTERS[parts[0]]
        return lambda scope: apply(f[0](scope))
    if kind == "join":
        if parts[0] == "~":
            return lambda scope: _shown(f[0](scope)) + _shown(f[1](scope))
        apply = operator.add if parts[0] == "+" else operator.sub
        return lambda scope: apply(f[0](scope), f[1](scope))

    def get(scope: dict) -> Any:
        owner, key = f[0](scope), f[1](scope)
        if isinstance(owner, dict):
            return owner.get(key)
        if isinstance(owner, (list, str)) and isinstance(key, int):
            return owner[key] if -len(owner) <= key < len(owner) else None
        return None

    return get


class _Output:
    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _statement(node: tuple) -> Callable[[dict, _Output], None]:
    kind, *parts = node
    if kind == "text":
        text = parts[0]
        return lambda scope, out: out.add(text)
    if kind == "out":
        value = _expression(parts[0])
        return lambda scope, out: out.add(_shown(value(scope)))
    if kind == "block":
        steps = [_statement(p) for p in parts]

        def block(scope: dict, out: _Output) -> None:
            for step in steps:
                step(scope, out)

        return block
    if kind == "if":
        arms, other = [(_expression(c), _statement(b)) for c, b in parts[0]], _statement(parts[1])

        def choose(scope: dict, out: _Output) -> None:
            for condition, body in arms:
                if condition(scope):
                    return body(scope, out)
            return other(scope, out)

        return choose
    if kind == "set":
        name, value = parts[0], _expression(parts[1])
        return lambda scope, out: scope.__setitem__(name, value(scope))
    body = _statement(parts[-1])
    if kind == "generation":

        def marked(scope: dict, out: _Output) -> None:
            start = out.length
            body(scope, out)
            out.spans.append((start, out.length))

        return marked
    name, items = parts[0], _expression(parts[1])

    def loop(scope: dict, out: _Output) -> None:
        rows = items(scope) or []
        for i, row in enumerate(rows):
            place = {"first": i == 0, "last": i == len(rows) - 1, "index": i + 1, "length": len(rows)}
            body({**scope, name: row, "loop": place}, out)

    return loop


def compile_template(source: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A renderer: variables -> (text, spans marked as generated, in code points)."""
    run = _statement(fold(parse(source)))

    def render(variables: dict) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        run(dict(variables), out)
        return "".join(out.parts), out.spans

    return render


def read_back(formatted: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[str, str]], str]:
    """(role, text) of every turn of text that TEMPLATE made, and the unescaped text under the spans."""
    turns, at = [], 0
    mark = re.compile(r"\\.|<turn>|</turn>\n|\n", re.S)
    role, start = None, None
    for m in mark.finditer(formatted):
        if m[0] == "<turn>":
            role, start = None, m.end()
        elif m[0] == "\n" and role is None and start is not None:
            role, start = formatted[start : m.start()], m.end()
        elif m[0] == "</turn>\n":
            turns.append((unescape(role), unescape(formatted[start : m.start()])))
            role = start = None
    return turns, "".join(unescape(formatted[a:b]) for a, b in spans)


def format_conversations(
    rows: DataFrame, template: str = TEMPLATE, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: (conv, formatted, spans array<struct<begin,end>>)."""
    compile_template(template)  # a faulty template fails here
    name, kind = conv, rows.schema[conv].dataType.simpleString()

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            texts, spans = [], []
            for messages in batch.column("_turns").to_pylist():
                out, marks = render({"messages": messages})
                texts.append(out)
                spans.append([{"begin": a, "end": b} for a, b in marks])
            kinds = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_conv"), pa.array(texts, pa.string()), pa.array(spans, kinds)], [name, "formatted", "spans"]
            )

    one = F.struct(
        F.col(turn).isNull().alias("no_turn"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )
    turns = rows.select(F.col(conv).alias("_conv"), one.alias("_one")).groupBy("_conv")
    turns = turns.agg(F.transform(F.array_sort(F.collect_list("_one")), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("_turns"))
    return turns.mapInArrow(formatted, f"`{conv}` {kind}, formatted string, spans array<struct<begin:bigint,end:bigint>>")
