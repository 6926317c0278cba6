"""Chat formatting by compiled templates (operator 1).

A template is text with ``{{ expression }}``, ``{% for x in xs %}``,
``{% if %} / {% elif %} / {% else %}``, ``{% set x = ... %}``, ``{# comment #}``
and ``{% generation %} ... {% endgeneration %}`` around what a model is to
learn.  Expressions know strings, integers, true, false, none, names, ``a.b``
and ``a[b]`` on the data alone, ``+ == != in not and or``, parentheses and the
filters in ``FILTERS``.  There are no calls and no Python attributes, so a
template reaches nothing but the messages.

The compiler reads a template into a syntax tree, folds constants (constant
expressions, branches that cannot run, neighbouring texts) and turns the tree
into Python closures.  They render as a stream of pieces, each marked as
inside generation or not, so a conversation needs no memory for its output;
``for`` reads its messages one ahead to know ``loop.last``.

``escape`` puts a backslash before backslashes and before the control strings
``CONTROLS``; ``unescape`` undoes exactly that, whatever a text holds.

Cases: null texts and roles count as empty; rows of a conversation are taken
by turn (null first), then role, then text, and repeated rows are turns like
any other; rows without a conversation id form one; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ("<turn>", "<text>", "</turn>")
TEMPLATE = (
    "{% for m in messages %}"
    "<turn>{{ m.role | escape }}<text>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "</turn>{{ '\\n' }}"
    "{% endfor %}")

_TO_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable] = {
    "escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len, "string": str}


class TemplateError(ValueError):
    """A template that cannot be compiled or rendered."""


# -- syntax tree ------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    body: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.DOTALL)
_WORDS = re.compile(r"""\s*(?:(\d+)|('(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|([A-Za-z_]\w*)|(==|!=|[+|.\[\]()=]))""")
_STRING_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over one expression's words."""

    def __init__(self, source: str):
        self.words, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _WORDS.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, text, name, sign = m.groups()
            if number:
                self.words.append(("const", int(number)))
            elif text:
                self.words.append(("const", re.sub(r"\\(.)", lambda e: _STRING_ESCAPES.get(e[1], e[1]), text[1:-1])))
            else:
                self.words.append(("name", name) if name else ("sign", sign))
            at = m.end()
        self.at = 0

    def next_is(self, *words: str) -> bool:
        return self.at < len(self.words) and self.words[self.at][0] != "const" and self.words[self.at][1] in words

    def take(self, *words: str) -> str:
        if not self.next_is(*words):
            raise TemplateError(f"expected {' or '.join(words)}")
        self.at += 1
        return self.words[self.at - 1][1]

    def name(self) -> str:
        if self.at >= len(self.words) or self.words[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return self.words[self.at - 1][1]

    def done(self, node):
        if self.at != len(self.words):
            raise TemplateError(f"unread: {self.words[self.at:]}")
        return node

    def any_of(self):
        node = self.all_of()
        while self.next_is("or"):
            self.at += 1
            node = Op("or", (node, self.all_of()))
        return node

    def all_of(self):
        node = self.negation()
        while self.next_is("and"):
            self.at += 1
            node = Op("and", (node, self.negation()))
        return node

    def negation(self):
        if self.next_is("not"):
            self.at += 1
            return Op("not", (self.negation(),))
        node = self.sum()
        while self.next_is("==", "!=", "in"):
            node = Op(self.take("==", "!=", "in"), (node, self.sum()))
        return node

    def sum(self):
        node = self.filtered()
        while self.next_is("+"):
            self.at += 1
            node = Op("+", (node, self.filtered()))
        return node

    def filtered(self):
        node = self.primary()
        while self.next_is("|"):
            self.at += 1
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            node = Filter(name, node)
        return node

    def primary(self):
        if self.at >= len(self.words):
            raise TemplateError("expression ends early")
        kind, word = self.words[self.at]
        if kind == "sign":
            self.take("(")
            node = self.any_of()
            self.take(")")
        else:
            self.at += 1
            fixed = {"true": True, "false": False, "none": None}
            node = Const(word) if kind == "const" else Const(fixed[word]) if word in fixed else Name(word)
        while self.next_is(".", "["):
            if self.take(".", "[") == ".":
                node = Item(node, Const(self.name()))
            else:
                node = Item(node, self.any_of())
                self.take("]")
        return node


def parse(template: str) -> tuple:
    """The syntax tree of a template: a tuple of nodes."""
    parts, at = [], 0
    for m in _TAGS.finditer(template):
        if m.start() > at:
            parts.append(("text", template[at:m.start()]))
        if m.group(1) is not None:
            parts.append(("out", m.group(1)))
        elif m.group(2) is not None:
            parts.append(("tag", m.group(2).strip()))
        at = m.end()
    parts.append(("text", template[at:]))
    queue = iter(parts)

    def block(*ends: str) -> tuple[tuple, str]:
        """Nodes up to one of the end tags, and that tag."""
        nodes = []
        for kind, source in queue:
            if kind == "text":
                nodes.append(Text(source))
            elif kind == "out":
                e = _Expression(source)
                nodes.append(Output(e.done(e.any_of())))
            else:
                word, _, rest = source.partition(" ")
                if word in ends:
                    return tuple(nodes), source
                nodes.append(tag(word, rest))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(nodes), ""

    def tag(word: str, rest: str):
        e = _Expression(rest)
        if word == "for":
            name = e.name()
            e.take("in")
            over = e.done(e.any_of())
            return For(name, over, block("endfor")[0])
        if word == "if":
            test = e.done(e.any_of())
            body, end = block("elif", "else", "endif")
            if end.startswith("elif"):
                return If(test, body, (tag("if", end[4:]),))
            return If(test, body, block("endif")[0] if end == "else" else ())
        if word == "set":
            name = e.name()
            e.take("=")
            return Set(name, e.done(e.any_of()))
        if word == "generation":
            return Generation(block("endgeneration")[0])
        raise TemplateError(f"no tag {word!r}")

    return block()[0]


# -- constants ----------------------------------------------------------------

_OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b, "not": lambda a: not a,
    "+": lambda a, b: a + b, "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(node):
    """The same tree with constant parts computed."""
    if isinstance(node, tuple):
        out: list = []
        for n in (fold(n) for n in node):
            for one in n if isinstance(n, tuple) else (n,):
                if isinstance(one, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].text + one.text)
                elif one != Text(""):
                    out.append(one)
        return tuple(out)
    if isinstance(node, Op):
        args = tuple(fold(a) for a in node.args)
        if all(isinstance(a, Const) for a in args):
            return Const(_guard(_OPS[node.op], *(a.value for a in args)))
        if node.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
        return Op(node.op, args)
    if isinstance(node, Filter):
        of = fold(node.of)
        return Const(_guard(FILTERS[node.name], of.value)) if isinstance(of, Const) else Filter(node.name, of)
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Output):
        value = fold(node.value)
        return Text(_shown(value.value)) if isinstance(value, Const) else Output(value)
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, If):
        test, body, other = fold(node.test), fold(node.body), fold(node.other)
        if isinstance(test, Const):
            return body if test.value else other
        return If(test, body, other)
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _guard(f: Callable, *args):
    try:
        return f(*args)
    except (TypeError, AttributeError) as e:
        raise TemplateError(str(e)) from e


def _shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# -- closures -----------------------------------------------------------------

Pieces = Iterator[tuple[str, int]]     # text, and the number of the generation it is part of (0: none)


@dataclass
class _Scope:
    values: dict
    marked: int = 0                     # the generation now open
    begun: int = field(default=0)       # generations so far


def _value(node) -> Callable[[_Scope], object]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        def look(scope, name=node.name):
            try:
                return scope.values[name]
            except KeyError:
                raise TemplateError(f"no value {name}") from None
        return look
    if isinstance(node, Item):
        of, key = _value(node.of), _value(node.key)

        def item(scope):
            data, at = of(scope), key(scope)
            if isinstance(data, dict):
                return data.get(at)
            if isinstance(data, (list, tuple, str)) and isinstance(at, int):
                return data[at] if -len(data) <= at < len(data) else None
            raise TemplateError(f"no item {at!r}")
        return item
    if isinstance(node, Filter):
        f, of = FILTERS[node.name], _value(node.of)
        return lambda scope: _guard(f, of(scope))
    f, args = _OPS[node.op], [_value(a) for a in node.args]
    if node.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    return lambda scope: _guard(f, *(a(scope) for a in args))


def _block(nodes: tuple) -> Callable[[_Scope], Pieces]:
    steps = [_step(n) for n in nodes]

    def run(scope):
        for step in steps:
            yield from step(scope)
    return run


def _step(node) -> Callable[[_Scope], Pieces]:
    if isinstance(node, Text):
        def text(scope, t=node.text):
            yield t, scope.marked
        return text
    if isinstance(node, Output):
        value = _value(node.value)

        def output(scope):
            yield _shown(value(scope)), scope.marked
        return output
    if isinstance(node, Set):
        value = _value(node.value)

        def assign(scope, name=node.name):
            scope.values[name] = value(scope)
            yield from ()
        return assign
    if isinstance(node, If):
        test, body, other = _value(node.test), _block(node.body), _block(node.other)
        return lambda scope: body(scope) if test(scope) else other(scope)
    if isinstance(node, Generation):
        body = _block(node.body)

        def generation(scope):
            outer = scope.marked
            if not outer:
                scope.begun += 1
                scope.marked = scope.begun
            yield from body(scope)
            scope.marked = outer
        return generation
    over, body = _value(node.over), _block(node.body)

    def loop(scope, name=node.name):
        kept = {k: scope.values[k] for k in (name, "loop") if k in scope.values}
        rows, i = iter(over(scope)), 0
        row = next(rows, rows)
        while row is not rows:
            after = next(rows, rows)
            scope.values[name] = row
            scope.values["loop"] = {"index0": i, "index": i + 1, "first": i == 0, "last": after is rows}
            yield from body(scope)
            row, i = after, i + 1
        for k in (name, "loop"):
            scope.values.pop(k, None)
        scope.values.update(kept)
    return loop


@lru_cache(maxsize=16)
def compiled(template: str) -> Callable[[Iterable[dict]], Pieces]:
    """A function from messages (dicts with ``role`` and ``text``) to the pieces of the output."""
    run = _block(fold(parse(template)))
    return lambda messages: run(_Scope({"messages": messages}))


def render(template: str, messages: Iterable[dict]) -> tuple[str, list[tuple[int, int]]]:
    """The whole output and the spans of its generations."""
    out, spans, at, last = [], [], 0, 0
    for text, marked in compiled(template)(messages):
        if marked:
            if marked == last:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
                last = marked
        out.append(text)
        at += len(text)
    return "".join(out), spans


class Reader:
    """Reads turns back from a stream of pieces of the default template's output."""

    _TURN = re.compile(r"<turn>((?:[^\\<]|\\.|<(?!text>|/turn>|turn>))*)<text>((?:[^\\<]|\\.|<(?!text>|/turn>|turn>))*)</turn>\n",
                       re.DOTALL)

    def __init__(self):
        self.waiting: list[str] = []

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.waiting.append(piece)
        if piece.endswith("</turn>\n"):
            text, at = "".join(self.waiting), 0
            while m := self._TURN.match(text, at):
                yield unescape(m.group(1)), unescape(m.group(2))
                at = m.end()
            self.waiting = [text[at:]]

    def end(self) -> None:
        if "".join(self.waiting):
            raise TemplateError("output ends within a turn")


# -- Spark ----------------------------------------------------------------------

def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """Sorted rows as conversations, one message at a time."""
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))))
    for conv, group in groupby(rows, key=lambda r: r[0]):
        yield conv, ({"role": r[1], "text": r[2]} for r in group)


def _sorted(rows: DataFrame) -> DataFrame:
    """The rows of each conversation together and in order; partitions sort on disk if they must."""
    return (rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``, the spans in code points of the output."""
    compiled(template)                          # a wrong template fails here, not in a task
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, messages in _conversations(batches):
            text, spans = render(template, messages)
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": conv, "formatted": text, "loss_spans": [{"start": a, "end": b} for a, b in spans]}],
                schema=schema)

    schema = pa.schema([("conv_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()),
                        ("formatted", pa.string()),
                        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    return _sorted(rows).mapInArrow(run, f"conv_id {kind}, formatted string, loss_spans array<struct<start: long, end: long>>")


def report(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Per conversation, read back from its output: turns, their digest, the loss mask's text, and sizes."""
    compiled(template)
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def one(messages: Iterator[dict]) -> tuple[int, str, int, str, int]:
        reader, turns, loss = Reader(), hashlib.sha256(), hashlib.sha256()
        n, size, loss_chars, open_, marked_text = 0, 0, 0, 0, []

        def close() -> int:
            text = unescape("".join(marked_text))
            marked_text.clear()
            loss.update(text.encode())
            return len(text)

        for piece, marked in compiled(template)(messages):
            size += len(piece)
            if marked != open_:
                loss_chars += close()
                open_ = marked
            if marked:
                marked_text.append(piece)
            for role, text in reader.feed(piece):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
        loss_chars += close()
        reader.end()
        return n, turns.hexdigest(), loss_chars, loss.hexdigest(), size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        for conv, messages in _conversations(batches):
            done.append((conv, *one(messages)))
            if len(done) == 1000:
                yield batch(done)
                done = []
        if done:
            yield batch(done)

    def batch(done: list[tuple]) -> pa.RecordBatch:
        first = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
        kinds = [first, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)

    return _sorted(rows).mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                         "loss_sha256 string, formatted_chars long")
