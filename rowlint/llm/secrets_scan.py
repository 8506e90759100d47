"""Secret scans by assignment-aware lexing.

Three plain patterns give the base spans: assignments to a telling name,
access key ids and long hexadecimal runs.  On top of them a small lexer reads
source and configuration syntax (``name = "literal"``, ``"name": 'literal'``,
``NAME=literal``, ``name := a + "b"``) into pairs of a name and its literals.
Constants are propagated: a name that was given a literal stands for it when it
is assigned to another name, so ``k = "..."`` followed by ``api_secret = k``
reports the literal of ``k``.  A literal is scored by how sensitive its target
name is and by its own look; from ``CUTOFF`` on it is a span of kind
``literal``.  Base spans always stay.

The scan reads one text at a time and moves no rows between tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from ._common import col

# The base patterns and their order
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # greedy runs: the same as runs of any length kept from 24 on
MIN_VALUE, MIN_ACCESS = 6, 20

CUTOFF = 0.7
ENDS = 16  # signs kept of both ends of a value: more than any fixed placeholder has
STRONG = frozenset("password passwd passphrase pwd pass secret token apikey credential credentials privatekey accesskey secretkey bearer".split())
WEAK = frozenset("auth authorization key cred creds salt signature cookie session pin".split())
PAIRS = frozenset({("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("signing", "key"), ("encryption", "key"), ("account", "key")})
# every sensitive name holds one of these, so a text without them has none
HINT = re.compile("(?ai:" + "|".join(sorted(STRONG | WEAK | {last for _, last in PAIRS})) + ")")
PLACEHOLDER = re.compile(r"(?ai:^(?:x+|\*+|\.+|none|null|nil|true|false|undefined|example.*|changeme|change_me|todo|your[_-].*|dummy|test|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*)$)")
LEX = re.compile(r"""
    (?P<string>"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`)
  | (?P<name>[A-Za-z_$][A-Za-z0-9_$]*+(?:[.-][A-Za-z0-9_$]++)*+)
  | (?P<assign>:=|=>|=(?![=~])|:(?!:))
  | (?P<other>==|!=|<=|>=|::|\+|[^\s])
  | (?P<line>\n)
""", re.X)
BARE = re.compile(r"""[^\s,;"'`(){}\[\]=]++(?:={1,2}(?=[\s,;"'`(){}\[\]]|\Z))?""")
PLUS = re.compile(r"[ \t]*\+[ \t]*")
SPLIT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
                   StructField("name", StringType()), StructField("score", DoubleType())])


def name_weight(name: str) -> float:
    """How sensitive a target name is: 0.6, 0.35 or 0."""
    parts = [p.lower() for p in SPLIT.findall(name)]
    if any(p in STRONG for p in parts) or any(p in PAIRS for p in zip(parts, parts[1:], strict=False)):
        return 0.6
    return 0.35 if any(p in WEAK for p in parts) else 0.0


class Value:
    """What a name was given: literals ``(start, end, quoted)`` and values of other names, by reference, in order."""

    __slots__ = ("best", "look", "parts")

    def __init__(self, parts: list[tuple[int, int, bool] | Value]):
        self.parts = parts
        self.look: Look | None = None
        self.best: tuple[float, int, str] | None = None  # score, minus its place in the text, name


class Look:
    """What the weight of a literal depends on; for a sum made from its parts, however long it is."""

    __slots__ = ("counts", "head", "quoted", "size", "tail")

    def __init__(self, value: str = "", quoted: bool = False):
        self.size, self.counts, self.quoted = len(value), Counter(value), quoted
        self.head, self.tail = value[:ENDS], value[-ENDS:]

    def add(self, other: Look) -> None:
        if self.size < ENDS:
            self.head = (self.head + other.head)[:ENDS]
        self.tail = other.tail if other.size >= ENDS else (self.tail + other.tail)[-ENDS:]
        self.size += other.size
        self.quoted |= other.quoted
        for c, n in other.counts.items():
            self.counts[c] += n
        if self.size > 1 << 500:  # names that double again and again: entropy needs the proportions only
            self.size >>= 400
            self.counts = Counter({c: max(1, n >> 400) for c, n in self.counts.items()})

    def weight(self) -> float:
        """How much a literal looks like a secret: its length, signs and entropy."""
        if self.size < MIN_VALUE or self._placeholder() or any(c.isspace() for c in self.counts):
            return -1.0
        signs = "".join(self.counts)
        kinds = sum(bool(re.search(x, signs)) for x in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        entropy = -sum(c / self.size * math.log2(c / self.size) for c in self.counts.values())
        w = 0.1 + 0.1 * (self.size >= 16) + 0.1 * (kinds >= 2) + 0.15 * (entropy >= 3)
        return w if self.quoted or kinds >= 2 else w - 0.3

    def _placeholder(self) -> bool:
        if self.size <= ENDS:
            return bool(PLACEHOLDER.match(self.head))
        # longer than any fixed word: one sign again and again, or told by the two ends
        ends = self.head + self.tail
        return bool(PLACEHOLDER.match(ends)) and (len(set(ends.lower())) > 1 or len({c.lower() for c in self.counts}) == 1)


def literal_weight(value: str, quoted: bool) -> float:
    """The weight of a single literal."""
    return Look(value, quoted).weight()


def look(text: str, value: Value) -> Look:
    """The look of a value, parts first and without recursion, each value once."""
    todo = [value]
    while todo:
        v = todo[-1]
        missing = [] if v.look else [p for p in v.parts if isinstance(p, Value) and not p.look]
        if missing:
            todo += missing
            continue
        todo.pop()
        if not v.look:
            made = Look()
            for p in v.parts:
                made.add(p.look if isinstance(p, Value) else Look(text[p[0]:p[1]], p[2]))
            v.look = made
    return value.look


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """``(name, value)``: what each name is given, in order; parts come before what refers to them.

    A name once given literals stands for them on the right side from then on;
    inside one text only.
    """
    known: dict[str, Value] = {}
    at, end = 0, len(text)
    before = None  # the name that an assignment sign would belong to
    while at < end:
        m = LEX.search(text, at)
        if not m:
            break
        at, kind = m.end(), m.lastgroup
        if kind == "name":
            before = m.group()
        elif kind == "string":
            before = m.group()[1:-1] if len(m.group()) > 2 else None
        elif kind == "assign" and before:
            found, at = _value(text, at, known)
            if found:
                # another name for a value is that value
                value = found[0] if len(found) == 1 and isinstance(found[0], Value) else Value(found)
                known[before.lower()] = value
                known[before.lower().rpartition(".")[2]] = value
                yield before, value
            before = None
        else:
            before = None


def _value(text: str, at: int, known: dict[str, Value]) -> tuple[list[tuple[int, int, bool] | Value], int]:
    """The parts of the expression at ``at`` and where it ends."""
    out: list[tuple[int, int, bool] | Value] = []
    while True:
        while at < len(text) and text[at] in " \t":
            at += 1
        if at >= len(text):
            return out, at
        if text[at] in "\"'`":
            m = LEX.match(text, at)
            if not m or m.lastgroup != "string":
                return out, at + 1
            out.append((at + 1, m.end() - 1, True))
            at = m.end()
        else:
            m = BARE.match(text, at)
            if not m:
                return out, at
            word = m.group()
            seen = known.get(word.lower()) or known.get(word.lower().rpartition(".")[2])
            if text[m.end():m.end() + 1] == "(":  # a call: its arguments are read as assignments of their own
                return out, m.end()
            if seen:
                out.append(seen)
            elif not out:
                stop = m.end()
                while stop > at and text[stop - 1] in ".:=+":
                    stop -= 1
                if text[m.end():m.end() + 1] == "=":  # a=b=c: b is a name of its own
                    return out, at
                out.append((at, stop, False))
            at = m.end()
        m = PLUS.match(text, at)
        if not m:
            return out, at
        at = m.end()


def scan(text: str, cutoff: float = CUTOFF) -> list[tuple[str, int, int, str | None, float]]:
    """All spans of a text by start, then kind: ``(kind, start, end, name, score)``."""
    out = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_VALUE:
                out.append(("assign", m.start(), m.end(), m.group(1), 1.0))
        if HINT.search(text):
            best: dict[tuple[int, int], tuple[float, int, str]] = {}
            values: dict[int, Value] = {}
            for i, (name, value) in enumerate(pairs(text)):
                values.setdefault(id(value), value)
                w = name_weight(name)
                if w:
                    score = round(w + look(text, value).weight(), 4)
                    if score >= cutoff and (value.best is None or value.best[0] < score):
                        value.best = (score, -i, name)
            # from each value to its parts, which were made before it: the highest score, then the first name
            for value in reversed(values.values()):
                if value.best:
                    for p in value.parts:
                        if isinstance(p, Value):
                            p.best = max(p.best or value.best, value.best)
                        elif p[1] > p[0]:
                            best[p[:2]] = max(best.get(p[:2], value.best), value.best)
            out += [("literal", a, b, name, min(1.0, score)) for (a, b), (score, _, name) in best.items()]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), None, 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [("hex", m.start(), m.end(), None, 1.0) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


@F.pandas_udf(ArrayType(SPAN))
def _spans(s: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("kind", "start", "end", "name", "score"), x, strict=True)) for x in scan(t)] for t in s], index=s.index, dtype=object)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_secrets(docs: DataFrame, out: str = "secrets", text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets of each whole text in column ``out``.

    An array of ``(kind, start, end, name, score)`` by start, then kind
    (``KINDS``); places are code points, the end exclusive.  ``name`` is the
    target name of an assignment, else null.

    Null and empty texts have none.  Spans of one kind do not overlap, spans of
    different kinds may.  All rows and other columns stay; a column named
    ``out`` is replaced.
    """
    return docs.withColumn(out, _spans(F.coalesce(col(text_col), F.lit(""))))


def op3_secrets(spark, sf_dir):
    docs = with_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "literal")

    def n(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                       joined(F.col("secrets")).alias("spans"), n("literal"))
