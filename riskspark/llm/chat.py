"""Chat formatting: a small sandboxed template language, compiled to Python closures.

    {{ expr | filter }}                      output
    {% for m in messages %} .. {% endfor %}  one pass over the turns; loop.index, loop.first
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set name = e %}
    {% generation %} .. {% endgeneration %}  what a model is trained on

Expressions know strings, integers, true / false, names, fields by dot, + == != and
or not and parentheses. There are no calls, no indexes and no attributes of Python
objects: a field is a key of a turn, anything else is an error when it is compiled.

``compile_template`` parses to a syntax tree, folds constants (operators on literals,
dead branches, neighbouring literals of the output) and turns each node into a closure
that yields (text, trained) parts, so a conversation is rendered turn by turn.

Control strings inside texts are escaped reversibly: every ``<``, backslashes, ``|``
gets one more backslash, so ``<|`` only ever comes from the template.

Null texts and roles are empty. Turns that share a number follow by role, then text;
a null number comes first. Turns without a conversation form the conversation null.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
CHAT = (
    "{% for m in messages %}<|im_start|>{{ m.role | line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "<|im_end|>\n{% endfor %}"
)
Part = tuple[str, bool]


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_line(text: str) -> str:
    """As ``escape``, on one line."""
    return escape(text).replace("\n", BREAK)


def unescape_line(text: str) -> str:
    return unescape(text.replace(BREAK, "\n"))


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "line": escape_line, "trim": str.strip, "lower": str.lower, "upper": str.upper}
TOKENS = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+|().=]))")
ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


class TemplateError(ValueError):
    """The template is not valid."""


# --- parsing: nodes are tuples (kind, ...) ----------------------------------------


class Expression:
    """Parser of one expression."""

    def __init__(self, source: str):
        self.items: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            found = TOKENS.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.items.append((found.lastgroup or "", found.group(found.lastgroup or 0)))
            at = found.end()
        self.at = 0

    def take(self, *texts: str) -> str | None:
        if self.at < len(self.items) and self.items[self.at][0] != "str" and self.items[self.at][1] in texts:
            self.at += 1
            return self.items[self.at - 1][1]
        return None

    def name(self) -> str:
        if self.at >= len(self.items) or self.items[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.items[self.at - 1][1]

    def ended(self, node: tuple) -> tuple:
        if self.at < len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")
        return node

    def parse(self) -> tuple:
        node = self.chain("or", lambda: self.chain("and", self.negated))
        while self.take("|"):
            filter_name = self.name()
            if filter_name not in FILTERS:
                raise TemplateError(f"unknown filter {filter_name!r}")
            node = ("filter", filter_name, node)
        return node

    def chain(self, word: str, part: Callable[[], tuple]) -> tuple:
        node = part()
        while self.take(word):
            node = (word, node, part())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.added()
        while op := self.take("==", "!="):
            node = (op, node, self.added())
        return node

    def added(self) -> tuple:
        node = self.atom()
        while self.take("+"):
            node = ("+", node, self.atom())
        return node

    def atom(self) -> tuple:
        if self.take("("):
            node = self.parse()
            if not self.take(")"):
                raise TemplateError("a bracket is open")
            return node
        if self.at >= len(self.items):
            raise TemplateError("an expression ends early")
        kind, text = self.items[self.at]
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[0]), text[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(text))
        if kind != "name":
            raise TemplateError(f"unexpected {text!r}")
        if text in ("true", "false"):
            return ("const", text == "true")
        node: tuple = ("name", text)
        while self.take("."):
            node = ("field", node, self.name())
        return node


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def block(ends: tuple[str, ...]) -> tuple[tuple, str, str]:
        nonlocal at
        nodes: list[tuple] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                reader = Expression(part[2:-2])
                nodes.append(("out", reader.ended(reader.parse())))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return ("seq", *nodes), word, rest
                nodes.append(statement(word, rest))
            elif part:
                nodes.append(("text", part))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return ("seq", *nodes), "", ""

    def whole(rest: str) -> tuple:
        reader = Expression(rest)
        return reader.ended(reader.parse())

    def statement(word: str, rest: str) -> tuple:
        if word == "for":
            found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, flags=re.S)
            if not found:
                raise TemplateError(f"cannot read for {rest!r}")
            body, _, _ = block(("endfor",))
            return ("for", found[1], whole(found[2]), body)
        if word == "if":
            then, ended, more = block(("elif", "else", "endif"))
            if ended == "elif":
                return ("if", whole(rest), then, ("seq", statement("if", more)))
            other = block(("endif",))[0] if ended == "else" else ("seq",)
            return ("if", whole(rest), then, other)
        if word == "set":
            name, equals, value = rest.partition("=")
            if not equals or not name.strip().isidentifier():
                raise TemplateError(f"cannot read set {rest!r}")
            return ("set", name.strip(), whole(value))
        if word == "generation":
            return ("generation", block(("endgeneration",))[0])
        raise TemplateError(f"unknown statement {word!r}")

    return block(())[0]


# --- folding ----------------------------------------------------------------------

BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "+": lambda x, y: x + y if isinstance(x, int) and isinstance(y, int) else f"{shown(x)}{shown(y)}",
    "==": lambda x, y: x == y,
    "!=": lambda x, y: x != y,
}


def shown(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if not isinstance(value, (str, int)):
        raise TemplateError("only text and numbers can be put out")
    return str(value)


def fold(node: tuple) -> tuple:
    """The tree without what is known before any conversation."""
    kind = node[0]
    if kind in BINARY:
        left, right = fold(node[1]), fold(node[2])
        if left[0] == right[0] == "const":
            return ("const", BINARY[kind](left[1], right[1]))
        return (kind, left, right)
    if kind in ("and", "or"):
        left, right = fold(node[1]), fold(node[2])
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind == "not":
        inner = fold(node[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    if kind == "filter":
        inner = fold(node[2])
        return ("const", FILTERS[node[1]](shown(inner[1]))) if inner[0] == "const" else ("filter", node[1], inner)
    if kind == "out":
        inner = fold(node[1])
        return ("text", shown(inner[1])) if inner[0] == "const" else ("out", inner)
    if kind == "if":
        test = fold(node[1])
        if test[0] == "const":
            return fold(node[2] if test[1] else node[3])
        return ("if", test, fold(node[2]), fold(node[3]))
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "generation":
        return ("generation", fold(node[1]))
    if kind == "set":
        return ("set", node[1], fold(node[2]))
    if kind == "seq":
        out: list[tuple] = []
        for child in map(fold, node[1:]):
            for x in child[1:] if child[0] == "seq" else [child]:
                if x[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + x[1])
                elif x != ("text", ""):
                    out.append(x)
        return ("seq", *out)
    return node


# --- closures ---------------------------------------------------------------------


def value_of(node: tuple) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        return lambda _, v=node[1]: v
    if kind == "name":
        return lambda scope, n=node[1]: scope.get(n)
    if kind == "field":
        inner = value_of(node[1])

        def field(scope: dict, name: str = node[2]) -> Any:
            holder = inner(scope)
            if not isinstance(holder, dict):
                raise TemplateError(f"nothing has a field {name!r} here")
            return holder.get(name)

        return field
    if kind == "filter":
        inner, change = value_of(node[2]), FILTERS[node[1]]
        return lambda scope: change(shown(inner(scope)))
    if kind == "not":
        inner = value_of(node[1])
        return lambda scope: not inner(scope)
    left, right = value_of(node[1]), value_of(node[2])
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    op = BINARY[kind]
    return lambda scope: op(left(scope), right(scope))


def parts_of(node: tuple, trained: bool = False) -> Callable[[dict], Iterator[Part]]:
    kind = node[0]
    if kind == "text":
        fixed = (node[1], trained)
        return lambda _: iter((fixed,))
    if kind == "out":
        value = value_of(node[1])
        return lambda scope: iter(((shown(value(scope)), trained),))
    if kind == "seq":
        steps = [parts_of(x, trained) for x in node[1:]]

        def seq(scope: dict) -> Iterator[Part]:
            for step in steps:
                yield from step(scope)

        return seq
    if kind == "generation":
        return parts_of(node[1], True)
    if kind == "if":
        test, then, other = value_of(node[1]), parts_of(node[2], trained), parts_of(node[3], trained)
        return lambda scope: then(scope) if test(scope) else other(scope)
    if kind == "set":
        value = value_of(node[2])

        def put(scope: dict, name: str = node[1]) -> Iterator[Part]:
            scope[name] = value(scope)
            return iter(())

        return put
    values, body = value_of(node[2]), parts_of(node[3], trained)

    def loop(scope: dict, name: str = node[1]) -> Iterator[Part]:
        for i, item in enumerate(values(scope)):
            inner = {**scope, name: item, "loop": {"index": i + 1, "first": i == 0}}
            yield from body(inner)

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Part]]:
    """A function from turns to (text, trained) parts; turns may be an iterator and are read one at a time."""
    run = parts_of(fold(parse(source)))
    return lambda messages: run({"messages": messages})


def render(source: str, messages: Iterable[dict]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the (start, end) spans of it under the loss."""
    out, spans, at = [], [], 0
    for text, trained in compile_template(source)(messages):
        if trained and text:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        out.append(text)
        at += len(text)
    return "".join(out), spans


class Reader:
    """Turns read back from formatted text as it arrives."""

    def __init__(self) -> None:
        self.held = ""

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        self.held += text
        stop = END + "\n"
        while (end := self.held.find(stop)) >= 0:
            turn, self.held = self.held[:end], self.held[end + len(stop) :]
            if not turn.startswith(START):
                raise ValueError("a turn does not begin with its mark")
            role, _, body = turn[len(START) :].partition("\n")
            yield unescape_line(role), unescape(body)


def ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), each conversation in one partition and in order."""
    slim = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[dict]]]:
    """(conv_id, its turns) of sorted batches; turns are read as they are asked for."""
    from itertools import groupby

    flat = ((c, {"role": r, "text": t}) for b in batches for c, r, t in zip(*(col.to_pylist() for col in b.columns), strict=True))
    for conv, group in groupby(flat, key=lambda x: x[0]):
        yield conv, (m for _, m in group)


def formatted(turns: DataFrame, template: str = CHAT) -> DataFrame:
    """(conv_id, formatted, spans): the text of every conversation and its spans under the loss."""

    def run(batches):
        for conv, messages in conversations(batches):
            text, spans = render(template, messages)
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([text]), pa.array([[{"start": a, "end": b} for a, b in spans]], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["conv_id", "formatted", "spans"])

    return ordered(turns).mapInArrow(run, "conv_id long, formatted string, spans array<struct<start:long,end:long>>")


def digests(turns: DataFrame, template: str = CHAT) -> DataFrame:
    """Per conversation what is read back from its formatted text, in memory bounded by one turn."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        form, rows = compile_template(template), []
        for conv, messages in conversations(batches):
            reader, n, chars, loss_chars = Reader(), 0, 0, 0
            whole, loss, held = sha256(), sha256(), ""
            for text, trained in form(messages):
                chars += len(text)
                if trained:
                    held += text
                elif held:
                    plain = unescape(held)
                    loss_chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                    held = ""
                for role, body in reader.feed(text):
                    n += 1
                    whole.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            if reader.held or held:
                raise ValueError("a conversation ends inside a turn")
            rows.append((conv, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(rows) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return ordered(turns).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
