"""Secret scans by assignment-aware lexing.

Each text is cut into tokens once, from left to right: comments, texts (triple
quoted ones too), names, operators, brackets and bare runs; what stands in a
comment or a text is no code.  Statements become (name, literal) pairs: plain,
annotated, subscripted and tuple targets, keyword arguments, keys of JSON, YAML,
ini and env files, elements of XML, setters.  Names bound to literals are
propagated as constants through ``+`` and brackets, results of calls are unknown,
and a literal is scored by how sensitive the name is that it ends up in.  Every
token is read a bounded number of times, so the work grows with the text.  Three
plain patterns (assignments, access keys, long hexadecimal runs) are always
reported.
"""

from __future__ import annotations

from collections import Counter
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from marketlake.llm.common import shipped, whole_text

shipped(__name__)

KINDS = ["assign", "access", "hex", "literal"]
SPAN_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
)

# The three base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Matches of AKIA[A-Z0-9]+ and [0-9a-f]+ are maximal runs, so a least length in
# the pattern finds the same runs as filtering afterwards.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Sensitive words of a target name and their weight.
_SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "token": 0.9, "bearer": 0.9, "auth": 0.7, "authorization": 0.8,
    "private": 0.6, "key": 0.6, "access": 0.4, "signature": 0.6, "salt": 0.5,
}
_PLACEHOLDERS = ("example", "changeme", "placeholder", "your_", "xxxx", "<", "${", "{{", "none", "null", "true", "false")

_TOKEN = re.compile(
    r"""(?P<comment>(?<!\S)\#[^\n]*|(?<![:\w])//[^\n]*)|(?P<block>/\*|<!--)
    |(?P<long>\"{3}|'{3})|(?P<text>"(?:[^"\\\n]|\\.)*"|(?<!\w)'(?:[^'\\\n]|\\.)*')
    |(?P<element><[A-Za-z_][\w.\-]*>[^<>\n]+(?=</))
    |(?P<name>[A-Za-z_][\w\-]*(?:\.[A-Za-z_][\w\-]*)*)|(?P<op>:=|=>|[=!<>]=+|\|\||\?\?|[=:+?])
    |(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<sep>[,;&])|(?P<line>\n)|(?P<bare>[^\s"'(){}\[\],;&=:+?<>]+)|(?P<other>[^\s])""",
    re.VERBOSE,
)
_BARE = re.compile(r"""(?:[^\s"'#;,(){}\[\]&<>=:]|(?<=\S)\#|:(?=//)|=+(?=[\s"'#;,)}\]&]|$))+""")
_CLOSERS = {"/*": "*/", "<!--": "-->", '"""': '"""', "\'\'\'": "\'\'\'"}
_ASSIGNS = (":=", "=>", "=", ":")
_JOINS = ("if", "else", "or", "||", "??", "?", ":", "and", "not")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    weights = [_SENSITIVE.get(part.lower(), 0.0) for part in _NAME_PARTS.findall(name)]
    return min(1.0, max(weights, default=0.0) + 0.2 * (sum(w > 0 for w in weights) > 1))


class Value:
    """What a name is bound to: its characters counted, and the literals and values it is made of."""

    __slots__ = ("counts", "fit", "parts", "size")

    def __init__(self, text: str = "", span: tuple[int, int] | None = None):
        self.counts, self.size = Counter(text), len(text)
        self.fit = not any(p in text.lower() for p in _PLACEHOLDERS)
        self.parts: list = [span] if span else []

    def joined(self, other: "Value") -> "Value":
        out = Value()
        out.counts, out.size = self.counts + other.counts, self.size + other.size
        out.fit, out.parts = self.fit and other.fit, [self, other]
        return out

    def literals(self, seen: "set[Value]") -> list[tuple[int, int]]:
        """Spans of the literals, without those of values seen before."""
        out, stack = [], [self]
        while stack:
            part = stack.pop()
            if isinstance(part, tuple):
                out.append(part)
            elif part not in seen:
                seen.add(part)
                stack.extend(part.parts)
        return out


def literal_score(value: Value | str) -> float:
    """How much a literal looks like key material: length and character entropy, 0 for placeholders."""
    value = Value(value) if isinstance(value, str) else value
    if value.size < 6 or not value.fit or any(c.isspace() for c in value.counts):
        return 0.0
    entropy = -sum(n / value.size * math.log2(n / value.size) for n in value.counts.values())
    chars = value.counts
    mixed = any(c.isdigit() for c in chars) + any(c.isalpha() for c in chars) + any(not c.isalnum() for c in chars)
    return min(1.0, entropy / 3.5) * (0.6 + 0.2 * mixed)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three plain patterns."""
    spans = []
    low = text.lower()
    if any(word in low for word in _ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return spans


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all tokens; a text's span is that between its quotes, comments are left out."""
    out, at, unclosed = [], 0, set()
    while True:
        found = _TOKEN.search(text, at)
        if not found:
            return out
        kind, start, at = found.lastgroup, found.start(), found.end()
        if kind in ("block", "long"):
            mark = found[0]
            close = -1 if mark in unclosed else text.find(_CLOSERS[mark], at)
            if close < 0:
                unclosed.add(mark)  # looked for once
                kind = "other"
            else:
                if kind == "long":
                    out.append(("text", at, close))
                at = close + len(_CLOSERS[mark])
                continue
        if kind == "text":
            out.append((kind, start + 1, at - 1))
        elif kind == "element":
            name = text.index(">", start)
            out += [("name", start + 1, name), ("tag", name, name + 1), ("inside", name + 1, at)]
        elif kind != "comment":
            out.append((kind, start, at))


def assignments(text: str):
    """(name, :class:`Value`) of all statements that bind literals, constants propagated, in order of appearance."""
    found = tokens(text)
    n = len(found)
    constants: dict[str, Value] = {}

    def word(i: int) -> str:
        return text[found[i][1] : found[i][2]] if i < n else ""

    def kind(i: int) -> str:
        return found[i][0] if 0 <= i < n else ""

    def value(i: int, nested: int = 0) -> tuple[Value | None, bool, int]:
        """Value from token i on, whether all of it is known, and the token after it."""
        total, known = None, True
        while True:
            while nested and kind(i) == "line":
                i += 1
            if kind(i) == "text":
                part, i = Value(word(i), found[i][1:]), i + 1
                if kind(i) == "open" and word(i) == "[":
                    known = False
            elif kind(i) == "name" and kind(i + 1) == "open" and found[i][2] == found[i + 1][1] and word(i + 1) == "(":
                return None, False, i + 1  # a call: nobody knows
            elif kind(i) == "name" and word(i) in constants:
                part, i = constants[word(i)], i + 1
            elif kind(i) == "open" and word(i) == "(" and nested < 50:
                part, inner, i = value(i + 1, nested + 1)
                known &= inner
                while kind(i) == "line":
                    i += 1
                i += kind(i) == "close"
                if part is None:
                    return total, False, i
            else:
                return total, False, i
            total = part if total is None else total.joined(part)
            while nested and kind(i) == "line":
                i += 1
            adjacent = nested and kind(i) == "text"  # texts side by side are one
            if not adjacent:
                if word(i) != "+" or kind(i) != "op":
                    return total, known, i
                i += 1

    def bare(i: int) -> tuple[tuple[int, int] | None, int]:
        """Span of an unquoted value at token i and the token after it; none where it names a further target."""
        if kind(i) not in ("name", "bare", "other", "op") or word(i) in _ASSIGNS or word(i)[:1] in "<>":
            return None, i
        run = _BARE.match(text, found[i][1])
        if not run:
            return None, i
        j = i
        while j < n and found[j][1] < run.end():
            j += 1
        if kind(j) == "op" and word(j) in _ASSIGNS and found[j][1] == run.end() or word(j) == "(" and found[j][1] == run.end():
            return None, i
        return run.span(), j

    def target(i: int) -> str | None:
        """Name that ends right before token i."""
        if kind(i - 1) in ("name", "text"):
            return word(i - 1)
        if kind(i - 1) == "close" and word(i - 1) == "]" and kind(i - 2) == "text" and word(i - 3) == "[":
            return word(i - 2)
        return None

    i = 0
    while i < n:
        token = word(i)
        if kind(i) == "tag":
            yield word(i - 1), Value(word(i + 1).strip(), found[i + 1][1:])
            i += 2
            continue
        if kind(i) == "name" and word(i + 1) == "(" and kind(i + 2) == "text" and word(i + 3) == ")":
            setter = token.rsplit(".", 1)[-1]
            if setter.lower().startswith("set") and len(setter) > 3:
                yield setter[3:], Value(word(i + 2), found[i + 2][1:])
        if kind(i) != "op" or token not in _ASSIGNS or (name := target(i)) is None:
            i += 1
            continue
        names, back = [name], i - 2
        while token != ":" and kind(back) == "sep" and word(back) == "," and kind(back - 1) == "name":
            names.append(word(back - 1))
            back -= 2
        names.reverse()
        at = i + 1
        if token == ":" and kind(at) == "name":  # an annotation, then the value
            end = at + 1
            if word(end) == "[":
                while end < min(n, at + 12) and word(end) != "]":
                    end += 1
                end += 1
            if kind(end) == "op" and word(end) == "=" and text[found[end - 1][2] : found[end][1]].strip(" \t") == "":
                if found[end][1] > found[end - 1][2]:
                    at = end + 1
        i = at
        for name in names:
            held, known, after = value(at)
            if held is None and (run := bare(at))[0]:
                span, after = run
                held, known = Value(text[span[0] : span[1]], span), True
            if held is not None:
                if known:
                    constants[name] = held
                else:
                    constants.pop(name, None)
                yield name, held
            else:
                constants.pop(name, None)
            # either literal of a conditional, up to the end of the line
            chosen = False
            while kind(after) in ("name", "text", "op", "bare") and (chosen or word(after) in _JOINS) and kind(after) != "line":
                chosen = True
                if word(after) in ("=", ":="):
                    break
                if kind(after) == "text":
                    yield name, Value(word(after), found[after][1:])
                    constants.pop(name, None)
                after += 1
            i = max(i, after)
            at = after
            if len(names) == 1 or word(at) != ",":
                break
            at += 1


def scan(text: str, threshold: float = 0.5) -> list[tuple[int, int, str]]:
    """All spans of a text by start, then kind."""
    spans = base_spans(text)
    if any(c in text for c in "=:<("):
        added, seen = set(), set()
        for name, value in assignments(text):
            sensitive = name_score(name)
            if sensitive and sensitive * literal_score(value) >= threshold:
                added.update((a, b, "literal") for a, b in value.literals(seen) if b > a)
        spans += added
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


@arrow_udf(SPAN_TYPE)
def _scan(text: pa.Array) -> pa.Array:
    rows = [[{"kind": k, "start": a, "end": b} for a, b, k in scan(t or "")] for t in text.to_pylist()]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    return pa.array(rows, pa.list_(kind))


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``secrets``: an array of (kind, start, end) in code points, end exclusive, by start then kind.

    Kinds are ``assign``, ``access`` and ``hex`` (plain patterns) and
    ``literal`` (a literal that reaches a sensitive name).  A null or empty text
    has no spans; a column called ``secrets`` is replaced; rows are independent,
    so ties and repeated rows need no rule and an empty table stays empty.
    """
    return docs.withColumn("secrets", _scan(whole_text(text_col)))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
