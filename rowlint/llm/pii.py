"""Personal data: patterns propose spans, checksums confirm, context adjusts.

Every kind has a pattern, a validator and context words.  Luhn confirms card
numbers, mod-97 confirms IBANs; words next to a span raise or lower its score.
Kinds of ``BASE`` are reported whenever they are valid, whatever the score; the
others only from ``CUTOFF`` on.

The places of matches come from cutting the text at the pattern: the pieces
between the matches and the matches themselves give all starts as prefix sums,
and the ends of the pieces are the context.  The patterns match what their
plain forms match, written so that no run of characters is scanned twice
(a look-behind bars restarts inside a run, possessive loops bar backtracking).

JVM expressions only; no Python runs on executors and no rows move.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import col

CUTOFF = 0.7
BEFORE, AFTER = 48, 24
BLOCK = 64


def _luhn(digits: str) -> str:
    # every second digit from the right counts double, its digits added
    return f"""(aggregate(transform(sequence(1, char_length({digits})), i -> cast(substring({digits}, char_length({digits}) - i + 1, 1) as int) * (2 - i % 2)),
        0, (a, v) -> a + if(v > 9, v - 9, v)) % 10 = 0)"""


def _mod97(s: str) -> str:
    r = f"concat(substring({s}, 5), substring({s}, 1, 4))"
    return f"""(aggregate(transform(sequence(1, char_length({s})), i -> substring({r}, i, 1)), 0,
        (a, c) -> if(c <= '9', a * 10 + ascii(c) - 48, a * 100 + ascii(c) - 55) % 97) = 1)"""


_DIGITS = "regexp_replace(x, '[^0-9]', '')"
_ALNUM = "replace(x, ' ', '')"


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes; ``valid`` is SQL over a match ``x``; ``guard`` is SQL
    over ``text`` that must hold for any match; context words are a regex."""

    name: str
    pattern: str
    valid: str
    guard: str
    score: float
    near: str
    against: str = "no such word"


# What the base kinds match, and their order
BASE = ("email", "ip", "card", "phone")
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "true", "contains(text, '@')", 0.8, "mail|contact|write to|e-mail|correo|courriel", "noreply|no-reply"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "forall(split(x, '[.]'), p -> char_length(ltrim('0', p)) <= 3 and try_cast(concat('0', ltrim('0', p)) as int) <= 255)",
         "digit and contains(text, '.')", 0.6, "address|server|host|login|from|client|ip", "version|release|section|chapter"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
         _luhn(_DIGITS), "digit", 0.7, "card|visa|master|amex|pay|credit|karte|tarjeta|carte", "order|isbn|serial|tracking"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]",
         f"char_length({_DIGITS}) between 10 and 15", "contains(text, '+')", 0.6, "phone|tel|call|mobile|fax|ruf|llam|appel"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
         f"char_length({_ALNUM}) between 15 and 34 and {_mod97(_ALNUM)}", "digit", 0.7, "iban|account|bank|konto|cuenta|compte", "serial|model"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         "substring(x, 1, 3) not in ('000', '666') and substring(x, 1, 1) <> '9' and substring(x, 5, 2) <> '00' and substring(x, 8, 4) <> '0000'",
         "digit and contains(text, '-')", 0.5, "ssn|social security|tax id", "part|order|serial"),
)


def _places(p: str, m: str) -> str:
    """Start of every match: prefix sums in two levels, so that a text with very
    many matches costs no square of their number."""
    a = f"transform({m}, (x, i) -> char_length({p}[i]) + char_length(x))"
    tops = f"""transform(sequence(0, size(a) div {BLOCK}), b -> aggregate(slice(a, b * {BLOCK} + 1, {BLOCK}), 0, (s, v) -> s + v))"""
    return f"""transform(array({a}), a -> transform(array(aggregate({tops}, array(0), (s, v) -> concat(s, array(s[size(s) - 1] + v)))),
        t -> transform({m}, (x, i) -> t[i div {BLOCK}] + aggregate(slice(a, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), 0, (s, v) -> s + v)
             + char_length({p}[i])))[0])[0]"""


def _spans(k: Kind, order: int) -> str:
    p, m, s = f"__p_{k.name}", f"__m_{k.name}", f"__s_{k.name}"
    context = f"lower(concat(right({p}[i], {BEFORE}), ' ', left({p}[i + 1], {AFTER})))"
    score = f"cast({k.score} + if({context} rlike '{k.near}', 0.2, 0) - if({context} rlike '{k.against}', 0.3, 0) as double)"
    found = f"""filter(transform({m}, (x, i) -> named_struct('start', {s}[i], 'o', {order}, 'end', {s}[i] + char_length(x),
        'score', {score}, 'valid', {k.valid})), z -> z.valid{'' if k.name in BASE else f' and z.score >= {CUTOFF}'})"""
    return f"if(size({m}) > 0, {found}, array())"


def with_pii(docs: DataFrame, out: str = "pii", text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data of each whole text in column ``out``.

    An array of ``(kind, start, end, score)`` by start, then kind (``KINDS``);
    places are code points, the end exclusive.

    Null and empty texts have none.  Spans of one kind do not overlap, spans of
    different kinds may.  All rows and other columns stay, whatever their
    names; a column named ``out`` is replaced.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    whole = F.struct(*[col(c) for c in docs.columns]).alias("__row")
    rows = docs.select(whole, text.alias("text")).withColumn("digit", F.col("text").rlike("[0-9]"))
    none = F.array().cast("array<string>")
    for k in KINDS:
        guard = F.expr(k.guard)
        rows = rows.withColumns({
            f"__m_{k.name}": F.when(guard, F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).otherwise(none)})
    rows = rows.withColumns({f"__p_{k.name}": F.when(F.size(f"__m_{k.name}") > 0, F.split("text", k.pattern, -1)).otherwise(none) for k in KINDS})
    rows = rows.withColumns({f"__s_{k.name}": F.expr(f"if(size(__m_{k.name}) > 0, {_places(f'__p_{k.name}', f'__m_{k.name}')}, array())") for k in KINDS})
    every = F.array_sort(F.concat(*[F.expr(_spans(k, i)) for i, k in enumerate(KINDS)]))
    names = F.array(*[F.lit(k.name) for k in KINDS])
    found = F.transform(every, lambda s: F.struct(F.get(names, s["o"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    rows = rows.select("__row", found.alias("__found"))
    return rows.select(*[F.col("__row")[c].alias(c) for c in docs.columns if c != out], F.col("__found").alias(out))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark, sf_dir):
    docs = with_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))

    def n(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select("doc_id", *[n(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))
