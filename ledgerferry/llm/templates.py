"""Chat formatting with a compiled, sandboxed template language.

A template is parsed to a syntax tree, constants are folded, and every node becomes a Python
closure. There is no access to Python: names come from the turn and the loop, attributes are dict
lookups, filters are those in FILTERS, and the only loop is the one over the conversation's turns.

    {{ expression }}   {% if e %} {% elif e %} {% else %} {% endif %}
    {% for t in turns %} {% endfor %}   {% generation %} {% endgeneration %}

Expressions: 'text', numbers, names, t.role, ~ (join), == != and or not, e|filter, ( ).
Text inside generation marks is what a model is to learn: it carries the loss mask.

Rendering is a generator over an iterator of turns, so a conversation of any length passes
through in constant memory. Rows are dealt out by conversation and sorted by turn.

Defined results: null role and text count as empty; a null conv_id is one conversation, and so is
a null turn its first; equal turns are ordered by role, then text; repeated rows are repeated
turns; an empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks turns; the escape filter keeps its control strings out of roles and texts.
CHAT = (
    "{% for t in turns %}<turn>{{ t.role|escape }}\n"
    "{% if t.role == 'assistant' %}{% generation %}{{ t.text|escape }}{% endgeneration %}"
    "{% else %}{{ t.text|escape }}{% endif %}</turn>\n{% endfor %}"
)
ESCAPES = {"\\": "\\\\", "<": "\\l", "\n": "\\n"}
UNESCAPES = {v: k for k, v in ESCAPES.items()}


def escape(text: str) -> str:
    """Reversible; what it returns has no '<', no line feed and no lone backslash."""
    return re.sub(r"[\\<\n]", lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: UNESCAPES[m[0]], text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}

#: A piece of output, and whether it lies inside a generation mark.
Piece = tuple[str, bool]
Scope = dict[str, object]


class TemplateError(ValueError):
    """A template that does not belong to the language."""


TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[().|~]))")
TAG = re.compile(r"\{\{(?P<expr>.*?)\}\}|\{%(?P<stmt>.*?)%\}", re.S)


class Expression:
    """Recursive descent over one expression; nodes are tuples, the first item names the kind."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unreadable: {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *values: str) -> str | None:
        if self.peek()[1] in values and self.peek()[0] in ("op", "name"):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> tuple:
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        if op := self.take("==", "!="):
            node = (op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while self.take("~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def atom(self) -> tuple:
        kind, value = self.peek()
        self.at += 1
        if kind == "text":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "num":
            return ("const", int(value))
        if kind == "name":
            node = ("const", value == "true") if value in ("true", "false") else ("name", value)
            while self.take("."):
                kind, key = self.peek()
                if kind != "name":
                    raise TemplateError("a name has to follow '.'")
                self.at += 1
                node = ("key", node, key)
            return node
        if value == "(":
            node = self.either()
            if not self.take(")"):
                raise TemplateError("')' is missing")
            return node
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in TAG.finditer(source):
        parts += [("text", source[at : m.start()])] if m.start() > at else []
        parts.append(("expr", m["expr"]) if m["expr"] is not None else ("stmt", m["stmt"].strip()))
        at = m.end()
    parts += [("text", source[at:])] if at < len(source) else []
    parts.reverse()

    def block(*ends: str) -> tuple[list[tuple], str]:
        nodes: list[tuple] = []
        while parts:
            kind, body = parts.pop()
            word = body.split(None, 1)[0] if kind == "stmt" and body else ""
            if kind == "text":
                nodes.append(("out", ("const", body)))
            elif kind == "expr":
                nodes.append(("out", Expression(body).whole()))
            elif word in ends:
                return nodes, body
            elif word == "if":
                nodes.append(branch(body[2:]))
            elif word == "for":
                m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+turns", body)
                if not m:
                    raise TemplateError(f"a loop goes over turns: {body!r}")
                nodes.append(("for", m[1], block("endfor")[0]))
            elif word == "generation":
                nodes.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected {body!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return nodes, ""

    def branch(test: str) -> tuple:
        yes, end = block("elif", "else", "endif")
        no = [branch(end[4:])] if end.startswith("elif") else block("endif")[0] if end == "else" else []
        return ("if", Expression(test).whole(), yes, no)

    return block()[0]


def fold(node: tuple) -> tuple:
    """An expression with everything that has constant parts only worked out."""
    if node[0] in ("const", "name"):
        return node
    if node[0] == "key":
        return ("key", fold(node[1]), node[2])
    parts = [fold(x) if isinstance(x, tuple) else x for x in node[1:]]
    if all(x[0] == "const" for x in parts if isinstance(x, tuple)):
        return ("const", closure((node[0], *parts))({}))
    return (node[0], *parts)


def fold_block(nodes: list[tuple]) -> list[tuple]:
    """Constant branches are chosen, neighbouring constant output becomes one."""
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "out":
            value = fold(node[1])
            if value[0] == "const" and out and out[-1][0] == "out" and out[-1][1][0] == "const":
                out[-1] = ("out", ("const", text(out[-1][1][1]) + text(value[1])))
            elif value != ("const", ""):
                out.append(("out", value))
        elif node[0] == "if":
            test = fold(node[1])
            if test[0] == "const":
                out += fold_block(node[2] if test[1] else node[3])
            else:
                out.append(("if", test, fold_block(node[2]), fold_block(node[3])))
        else:
            out.append((*node[:-1], fold_block(node[-1])))
    return out


def text(value: object) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def closure(node: tuple) -> Callable[[Scope], object]:
    kind, parts = node[0], [closure(x) if isinstance(x, tuple) else x for x in node[1:]]
    if kind == "const":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        return lambda scope: scope.get(node[1])
    if kind == "key":
        of, key = parts
        return lambda scope: x.get(key) if isinstance(x := of(scope), dict) else None
    if kind == "filter":
        change, of = FILTERS[node[1]], parts[1]
        return lambda scope: change(text(of(scope)))
    if kind == "not":
        return lambda scope: not parts[0](scope)
    a, b = parts
    return {
        "~": lambda scope: text(a(scope)) + text(b(scope)),
        "==": lambda scope: a(scope) == b(scope),
        "!=": lambda scope: a(scope) != b(scope),
        "and": lambda scope: a(scope) and b(scope),
        "or": lambda scope: a(scope) or b(scope),
    }[kind]


Render = Callable[[Scope, bool], Iterator[Piece]]


def generate(nodes: list[tuple]) -> Render:
    """A closure that yields the output of a block, piece by piece."""
    runs = [_statement(node) for node in nodes]

    def render(scope: Scope, marked: bool) -> Iterator[Piece]:
        for run in runs:
            yield from run(scope, marked)

    return render


def _statement(node: tuple) -> Render:
    if node[0] == "out":
        value = closure(node[1])
        return lambda scope, marked: iter(((text(value(scope)), marked),))
    if node[0] == "generation":
        body = generate(node[1])
        return lambda scope, marked: body(scope, True)
    if node[0] == "if":
        test, yes, no = closure(node[1]), generate(node[2]), generate(node[3])
        return lambda scope, marked: yes(scope, marked) if test(scope) else no(scope, marked)
    name, body = node[1], generate(node[2])

    def loop(scope: Scope, marked: bool) -> Iterator[Piece]:
        for i, turn in enumerate(scope["turns"]):
            yield from body({**scope, name: turn, "loop": {"first": i == 0, "index": i + 1}}, marked)

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from turns (dicts with role and text) to (text, in generation marks) pieces."""
    render = generate(fold_block(parse(source)))
    return lambda turns: render({"turns": turns}, False)


TURN_END = "</turn>\n"


class Reader:
    """Reads turns back from the output of CHAT, fed in pieces of any size."""

    def __init__(self):
        self.turns, self.loss_chars, self.chars, self.held = 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.tail = ""  # of masked text: an escape may be cut in two

    def feed(self, piece: str, marked: bool) -> None:
        self.chars += len(piece)
        if marked:
            whole = self.tail + piece
            cut = len(whole) - (len(whole) - len(whole.rstrip("\\"))) % 2
            self.tail = whole[cut:]
            plain = unescape(whole[:cut])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "replace"))
        whole, start = self.held + piece, 0
        at = max(0, len(self.held) - len(TURN_END))  # the end of a turn may be cut in two
        while (end := whole.find(TURN_END, at)) >= 0:
            self._turn(whole[start:end])
            start = at = end + len(TURN_END)
        self.held = whole[start:]

    def _turn(self, source: str) -> None:
        if not source.startswith("<turn>"):
            raise ValueError(f"not a turn: {source[:40]!r}")
        role, _, body = source[len("<turn>") :].partition("\n")
        self.turns += 1
        self.all.update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "replace"))

    def result(self) -> tuple[int, str, int, str, int]:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


#: Pieces in a batch of output.
BATCH = 2_048


def format_conversations(turns: DataFrame, template: str = CHAT) -> DataFrame:
    """Rows (conv_id, piece, text, loss): a conversation's output is its texts joined by piece.

    Partitions hold whole conversations, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        rows = ((c, {"role": r or "", "text": x or ""}) for b in batches for s in range(0, b.num_rows, BATCH) for c, r, x in zip(*(b.column(k).slice(s, BATCH).to_pylist() for k in range(3)), strict=True))
        out: list[tuple] = []
        for conv, own in groupby(rows, key=lambda row: row[0]):
            for k, (piece, loss) in enumerate(render(row[1] for row in own)):
                out.append((conv, k, piece, loss))
                if len(out) >= BATCH:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "role", "text", "turn").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, piece long, text string, loss boolean")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, piece, body, loss = zip(*rows, strict=True)
    return pa.record_batch([pa.array(conv, pa.int64()), pa.array(piece, pa.int64()), pa.array(body, pa.string()), pa.array(loss, pa.bool_())], ["conv_id", "piece", "text", "loss"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its formatted output, which has to be in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, reader, done = none, Reader(), []
        columns = lambda b: zip(*(b.column(k).to_pylist() for k in (0, 2, 3)), strict=True)
        for conv, piece, loss in chain.from_iterable(map(columns, batches)):
            if conv != now or now is none:
                done += [(now, *reader.result())] if now is not none else []
                now, reader = conv, Reader()
                if len(done) >= BATCH:
                    yield rows(done)
                    done = []
            reader.feed(piece, loss)
        done += [(now, *reader.result())] if now is not none else []
        if done:
            yield rows(done)

    rows = lambda done: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), names.types, strict=True)], schema=names)
    names = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def probe(spark) -> DataFrame:
    """A conversation whose texts look like control strings."""
    said = r"\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def with_probe(turns: DataFrame) -> DataFrame:
    cast = turns.select(*[F.col(c).cast(t) for c, t in (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))])
    return cast.unionByName(probe(turns.sparkSession))
