"""Chat formatting: a small template compiler.

A sandboxed template language (text, ``{{ expression }}``, ``{% for %}``,
``{% if %}``, ``{% generation %}``) is parsed into a syntax tree, constants are
folded, and each node becomes a Python closure that writes to a sink.  There is
no attribute access beyond the fields of a message and no call but the named
filters.  The loop over messages is driven by an iterator, so a conversation of
any length streams through one task turn by turn.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlake.llm.common import shipped

shipped(__name__)

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[/TURN]"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_BREAK = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL) + r"|\\")

TEMPLATE = (
    "{% for message in messages %}"
    "{% if message.role == 'user' %}<s>[INST]{{ message.text | escape }}[/INST]"
    "{% elif message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}{{ '<' + '/s>' }}"
    "{% elif message.role == 'system' %}<<SYS>>{{ message.text | escape }}<</SYS>>"
    "{% else %}[TURN]{{ message.role | escape }}[/TURN]{{ message.text | escape }}</s>"
    "{% endif %}{% endfor %}"
)


def escape(text: str) -> str:
    """Break every control string by a backslash after its first character; double backslashes."""
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


# A doubled backslash reads as one, a single one vanishes: ``x\\`` + ``\`` never mix, because
# escaped text holds backslashes only in pairs or singly before another character.
FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "lower": str.lower, "upper": str.upper}

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z_]\w*(?:\.\w+)?)|(\d+)|(==|!=|[+|()]))""")


class TemplateError(ValueError):
    """A template outside the language."""


# --- expressions: ("const", value) | ("name", path) | ("filter", f, x) | (operator, a, b) | ("not", x)


class _Expression:
    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"bad expression: {source[at:]}")
            self.tokens.append(m.group().strip())
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self, expected: str | None = None) -> str:
        token = self.peek()
        if token is None or (expected is not None and token != expected):
            raise TemplateError(f"expected {expected or 'an operand'}, found {token}")
        self.at += 1
        return token

    def whole(self):
        tree = self.either()
        if self.peek() is not None:
            raise TemplateError(f"unexpected {self.peek()}")
        return fold(tree)

    def _chain(self, operand, operators):
        tree = operand()
        while self.peek() in operators:
            operator = self.take()
            tree = (operator, tree, operand())
        return tree

    def either(self):
        return self._chain(self.both, ("or",))

    def both(self):
        return self._chain(self.negated, ("and",))

    def negated(self):
        if self.peek() == "not":
            self.take()
            return ("not", self.negated())
        return self._chain(self.sum, ("==", "!="))

    def sum(self):
        return self._chain(self.filtered, ("+",))

    def filtered(self):
        tree = self.atom()
        while self.peek() == "|":
            self.take()
            name = self.take()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            tree = ("filter", name, tree)
        return tree

    def atom(self):
        token = self.take()
        if token == "(":
            tree = self.either()
            self.take(")")
            return tree
        if token[0] in "'\"":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), token[1:-1]))
        if token.isdigit():
            return ("const", int(token))
        if re.fullmatch(r"[A-Za-z_]\w*(\.\w+)?", token):
            return ("name", token)
        raise TemplateError(f"unexpected {token}")


def fold(tree):
    """Evaluate what depends on constants only."""
    if tree[0] in ("const", "name"):
        return tree
    if tree[0] == "filter":
        inner = fold(tree[2])
        return ("const", FILTERS[tree[1]](inner[1])) if inner[0] == "const" else ("filter", tree[1], inner)
    parts = [fold(x) for x in tree[1:]]
    if all(p[0] == "const" for p in parts):
        return ("const", _compile((tree[0], *parts))({}))
    if tree[0] in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (tree[0] == "and") else parts[0]
    return (tree[0], *parts)


def _compile(tree) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda env: value
    if kind == "name":
        head, _, field = tree[1].partition(".")
        return (lambda env: env[head][field]) if field else (lambda env: env[head])
    if kind == "filter":
        function, inner = FILTERS[tree[1]], _compile(tree[2])
        return lambda env: function(str(inner(env)))
    if kind == "not":
        inner = _compile(tree[1])
        return lambda env: not inner(env)
    a, b = _compile(tree[1]), _compile(tree[2])
    return {
        "or": lambda env: a(env) or b(env),
        "and": lambda env: a(env) and b(env),
        "==": lambda env: a(env) == b(env),
        "!=": lambda env: a(env) != b(env),
        "+": lambda env: a(env) + b(env),
    }[kind]


# --- statements: ("text", s) | ("out", e) | ("for", var, of, body) | ("if", [(e, body)...]) | ("generation", body)


def parse(template: str) -> list:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            pieces.append(("text", template[at : m.start()]))
        pieces.append(("out", _Expression(m[1]).whole()) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(template):
        pieces.append(("text", template[at:]))
    body, rest, end = _block(pieces, 0, ())
    if end is not None or rest != len(pieces):
        raise TemplateError("unbalanced tags")
    return body


def _block(pieces: list, at: int, ends: tuple[str, ...]):
    body: list = []
    while at < len(pieces):
        kind, value = pieces[at][0], pieces[at][1]
        at += 1
        if kind == "out" and value[0] == "const":
            kind, value = "text", str(value[1])
        if kind == "text" and body and body[-1][0] == "text":
            body[-1] = ("text", body[-1][1] + value)  # folded with the text before
        elif kind != "tag":
            body.append((kind, value))
        elif value.split()[0] in ends:
            return body, at, value
        elif m := re.fullmatch(r"for\s+(\w+)\s+in\s+(\w+)", value):
            inner, at, end = _block(pieces, at, ("endfor",))
            body.append(("for", m[1], m[2], inner))
        elif value.startswith("if "):
            branches, end = [], value
            while end and not end.startswith(("endif", "else")):
                test = _Expression(end.split(None, 1)[1]).whole()
                inner, at, end = _block(pieces, at, ("elif", "else", "endif"))
                branches.append((test, inner))
            if end == "else":
                inner, at, end = _block(pieces, at, ("endif",))
                branches.append((("const", True), inner))
            body += _fold_if(branches)
        elif value == "generation":
            inner, at, end = _block(pieces, at, ("endgeneration",))
            body.append(("generation", inner))
        else:
            raise TemplateError(f"unknown tag {value}")
        if kind == "tag" and end is None:
            raise TemplateError(f"{value} is not closed")
    return body, at, None


def _fold_if(branches: list) -> list:
    live = []
    for test, inner in branches:
        if test[0] == "const":
            if not test[1]:
                continue
            if not live:
                return inner
            live.append((test, inner))
            break
        live.append((test, inner))
    return [("if", live)] if live else []


class Sink:
    """Receives the pieces of an output; ``generated`` tells whether a piece is under the loss mask."""

    def write(self, text: str, generated: bool) -> None:
        raise TypeError("a sink defines write()")

    def turn_done(self) -> None:
        """Called after each pass of a loop, so that a long output can be handled in parts."""


class Pieces(Sink):
    """Keeps the whole output and the spans of generated text."""

    def __init__(self):
        self.parts, self.length, self.spans = [], 0, []

    def write(self, text, generated):
        if generated and text:
            self.spans.append((self.length, self.length + len(text)))
        self.parts.append(text)
        self.length += len(text)


def compile_template(template: str) -> Callable[[dict, Sink], None]:
    """``render(env, sink)`` of a template; loops take any iterable of ``env``."""

    def statement(node):
        kind = node[0]
        if kind == "text":
            return lambda env, sink, generated: sink.write(node[1], generated)
        if kind == "out":
            value = _compile(node[1])
            return lambda env, sink, generated: sink.write(str(value(env)), generated)
        if kind == "generation":
            inner = block(node[1])
            return lambda env, sink, generated: inner(env, sink, True)
        if kind == "if":
            branches = [(_compile(test), block(inner)) for test, inner in node[1]]

            def choose(env, sink, generated):
                for test, inner in branches:
                    if test(env):
                        inner(env, sink, generated)
                        return

            return choose
        inner = block(node[3])

        def loop(env, sink, generated):
            for index, item in enumerate(env[node[2]]):
                inner({**env, node[1]: item, "loop": {"index0": index, "first": index == 0}}, sink, generated)
                sink.turn_done()

        return loop

    def block(nodes):
        run = [statement(n) for n in nodes]

        def all_of(env, sink, generated):
            for f in run:
                f(env, sink, generated)

        return all_of

    whole = block(parse(template))
    return lambda env, sink: whole(env, sink, False)


def render(template: str, messages: Iterable[dict]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and its generated spans."""
    sink = Pieces()
    compile_template(template)({"messages": messages}, sink)
    return "".join(sink.parts), sink.spans


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from output of ``TEMPLATE``."""
    turns, held, before = [], None, 0
    for m in _CONTROL.finditer(text):
        between, mark = text[before : m.start()], m[0]
        before = m.end()
        if mark == "[/INST]":
            turns.append(("user", between))
        elif mark == "<</SYS>>":
            turns.append(("system", between))
        elif mark == "[/TURN]":
            held = between
        elif mark == "</s>":
            turns.append(("assistant" if held is None else held, between))
            held = None
    return [(unescape(role), unescape(body)) for role, body in turns]


class Digest(Sink):
    """Reads the output back turn by turn and keeps digests only."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.part, self.masked = Pieces(), None

    def write(self, text, generated):
        self.part.write(text, generated)

    def turn_done(self):
        text, spans = "".join(self.part.parts), self.part.spans
        for role, body in read_turns(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode())
        for start, end in spans:
            masked = unescape(text[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())
        self.formatted_chars += len(text)
        self.part = Pieces()


_COLUMNS = ["_conv", "_turn", "_role", "_text"]


def _ordered(conversations: DataFrame) -> DataFrame:
    """Rows of each conversation together, by turn; ties by role, then text.

    Rows spread by conversation, never by less: an output is one string in
    order.  A task streams its rows, it never holds a conversation.
    """
    return (
        conversations.select(
            F.col("conv_id").cast("long").alias("_conv"),
            F.col("turn").cast("long").alias("_turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("_role"),
            F.coalesce(F.col("text"), F.lit("")).alias("_text"),
        )
        .repartition("_conv")
        .sortWithinPartitions(*_COLUMNS)
    )


def _messages(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per turn: ``conv_id, turn, formatted, generated`` (spans within ``formatted``).

    The pieces of a conversation, in order, are its formatted text; what the
    template writes before or after its loop belongs to no turn and is refused.
    Null roles and texts are empty; ties on ``turn`` go by role, then text;
    equal rows are turns of their own; rows without ``conv_id`` form one
    conversation; other columns are dropped; an empty table gives no rows.
    """
    tree = parse(template)
    if [n[0] for n in tree] != ["for"]:
        raise TemplateError("the template must be one loop over the messages")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        turn = compile_template(template)
        for batch in batches:
            rows = {"conv_id": [], "turn": [], "formatted": [], "generated": []}
            for conv, at, role, text in _messages([batch]):
                sink = Pieces()
                turn({"messages": [{"role": role, "text": text}]}, sink)
                rows["conv_id"].append(conv)
                rows["turn"].append(at)
                rows["formatted"].append("".join(sink.parts))
                rows["generated"].append([{"start": a, "end": b} for a, b in sink.spans])
            arrays = [pa.array(rows["conv_id"], pa.int64()), pa.array(rows["turn"], pa.int64())]
            arrays += [pa.array(rows["formatted"], pa.string()), pa.array(rows["generated"], span)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(rows))

    schema = "conv_id bigint, turn bigint, formatted string, generated array<struct<start: bigint, end: bigint>>"
    return _ordered(conversations).mapInArrow(run, schema)


def conversation_digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per conversation, read back from its formatted text.

    Same rules as :func:`format_conversations`; the template must be readable
    by :func:`read_turns`.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        whole = compile_template(template)
        done = []

        def flush():
            columns = list(zip(*done, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for conv, rows in itertools.groupby(_messages(batches), key=lambda r: r[0]):
            sink = Digest()
            whole({"messages": ({"role": role, "text": text} for _, _, role, text in rows)}, sink)
            sink.turn_done()
            turns, loss = sink.turns.hexdigest(), sink.loss.hexdigest()
            done.append((conv, sink.n_turns, turns, sink.loss_chars, loss, sink.formatted_chars))
            if len(done) >= 1000:
                yield flush()
                done = []
        if done:
            yield flush()

    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    return _ordered(conversations).mapInArrow(run, schema)
