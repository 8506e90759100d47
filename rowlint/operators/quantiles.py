"""Exact quantiles without a global sort, and range rules from them.

Each wanted rank lies in a bracket of values.  A round proposes three cuts of the
bracket with ``percentile_approx`` (its sketch may be off by a ten-thousandth of
the bracket's rows) and then counts exactly how many values lie below and on each
cut.  Either a cut is the value, or the bracket shrinks to the values between two
cuts, some thousandth of it, whatever the distribution; a bracket of few values
is counted one by one.  Only counts decide, so the result is exact.  All columns
and ranks share the jobs of a round, each one aggregate with one row per task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType

from ..plans.compile import quote
from ..plans.spec import SpecError

ACCURACY = 10000
FEW = 4096  # values of a bracket that are counted one by one


@dataclass
class _Search:
    """One rank of one column (from 1), somewhere in [lo, hi] with ``below`` values under lo."""

    column: str
    prob: float
    rank: int
    lo: float
    hi: float
    below: int
    size: int
    value: float | None = None


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], few: int = FEW,
                    accuracy: int = ACCURACY) -> DataFrame:
    """``column, prob, value, n``: the value of rank ceil(prob * n), at least 1, among the
    n values that are neither NULL nor NaN; exact, as if they were sorted.

    Numbers up to 2^53 and all doubles are exact; larger whole numbers and
    decimals are refused.  Infinities count as the doubles farthest out.  A column
    without values has NULL.  Runs some jobs at once (two a round, about three rounds
    for 10^12 rows); what comes to the driver are three cuts, or ``few`` values, a rank.
    """
    spark = df.sparkSession
    columns, probs = list(columns), [float(p) for p in probs]
    if any(not 0 <= p <= 1 for p in probs):
        raise ValueError("probabilities are from 0 to 1")
    big = 1.7976931348623157e308
    for c in columns:
        t = df.schema[c].dataType
        if not isinstance(t, NumericType) or isinstance(t, DecimalType):
            raise SpecError([f"quantiles of {c!r}: {t.simpleString()} is no plain number"])
    value = {c: F.greatest(F.least(F.col(quote(c)).cast("double"), F.lit(big)), F.lit(-big)) for c in columns}
    value = {c: F.when(F.col(quote(c)).isNotNull() & ~F.isnan(F.col(quote(c)).cast("double")), v) for c, v in value.items()}
    first = df.agg(*[a for i, c in enumerate(columns) for a in (F.count(value[c]).alias(f"n{i}"), F.min(value[c]).alias(f"lo{i}"), F.max(value[c]).alias(f"hi{i}"))]).first()
    searches, n = [], {}
    for i, c in enumerate(columns):
        n[c] = first[f"n{i}"]
        if isinstance(df.schema[c].dataType, IntegralType) and n[c] and max(abs(first[f"lo{i}"]), abs(first[f"hi{i}"])) > 1 << 53:
            raise SpecError([f"quantiles of {c!r}: whole numbers beyond 2^53"])
        searches += [_Search(c, p, max(1, math.ceil(p * n[c])), first[f"lo{i}"], first[f"hi{i}"], 0, n[c]) for p in probs if n[c]]
    open_ = [s for s in searches if not _settled(s)]
    while open_:
        few_left = [s for s in open_ if s.size <= few]
        for s, rows in zip(few_left, _values(df, value, few_left)):
            at = s.below
            for v, k in sorted(rows):
                at += k
                if at >= s.rank:
                    s.value = v
                    break
        open_ = [s for s in open_ if s.value is None]
        if open_:
            _narrow(df, value, open_, accuracy)
        open_ = [s for s in open_ if not _settled(s)]
    rows = [(s.column, s.prob, s.value, n[s.column]) for s in searches] + [(c, p, None, 0) for c in columns if not n[c] for p in probs]
    return spark.createDataFrame(rows, "column string, prob double, value double, n long")


def _settled(s: _Search) -> bool:
    if s.value is None and s.lo == s.hi:
        s.value = s.lo
    return s.value is not None


def _narrow(df: DataFrame, value: dict[str, Column], searches: list[_Search], accuracy: int) -> None:
    """One round: cuts near each rank, exact counts around them, the bracket between two of them."""
    inside = [F.when((value[s.column] >= s.lo) & (value[s.column] <= s.hi), value[s.column]) for s in searches]
    wanted = []
    for i, s in enumerate(searches):
        at = (s.rank - s.below) / s.size
        wanted.append(F.percentile_approx(inside[i], [max(0.0, at - 2 / accuracy), min(1.0, at), min(1.0, at + 2 / accuracy)], accuracy).alias(f"q{i}"))
    cuts = [sorted(set(q)) for q in df.agg(*wanted).first()]
    counts = []
    for i, (v, mine) in enumerate(zip(inside, cuts)):
        for j, c in enumerate(mine):
            counts += [F.count_if(v < c).alias(f"lt{i}_{j}"), F.count_if(v == c).alias(f"eq{i}_{j}"),
                       F.max(F.when(v < c, v)).alias(f"under{i}_{j}"), F.min(F.when(v > c, v)).alias(f"over{i}_{j}")]
    got = df.agg(*counts).first()
    for i, (s, mine) in enumerate(zip(searches, cuts)):
        target, lo, start, hi, end = s.rank - s.below, s.lo, 0, s.hi, s.size
        for j, c in enumerate(mine):
            lt, eq = got[f"lt{i}_{j}"], got[f"eq{i}_{j}"]
            if target <= lt:
                hi, end = got[f"under{i}_{j}"], lt
                break
            if target <= lt + eq:
                s.value = c
                break
            lo, start = got[f"over{i}_{j}"], lt + eq
        if s.value is None:
            s.lo, s.hi, s.below, s.size = lo, hi, s.below + start, end - start


def _values(df: DataFrame, value: dict[str, Column], searches: list[_Search]) -> list[list[tuple[float, int]]]:
    if not searches:
        return []
    entries = [F.when((value[s.column] >= s.lo) & (value[s.column] <= s.hi), F.struct(F.lit(i).alias("i"), value[s.column].alias("v"))) for i, s in enumerate(searches)]
    rows = df.select(F.inline(F.filter(F.array(*entries), lambda x: x.isNotNull()))).groupBy("i", "v").agg(F.count(F.lit(1)).alias("k")).collect()
    out = [[] for _ in searches]
    for r in rows:
        out[r["i"]].append((r["v"], r["k"]))
    return out


def outlier_bounds(df: DataFrame, columns: Sequence[str], fence: float = 1.5, low: float = 0.25, high: float = 0.75) -> DataFrame:
    """Range rules from exact quantiles: ``column, min, max, n``, from
    q(low) - fence * spread to q(high) + fence * spread, spread being q(high) - q(low)."""
    q = exact_quantiles(df, columns, [low, high]).groupBy("column").agg(
        F.max(F.when(F.col("prob") == low, F.col("value"))).alias("lo"), F.max(F.when(F.col("prob") == high, F.col("value"))).alias("hi"), F.max("n").alias("n"))
    spread = (F.col("hi") - F.col("lo")) * fence
    return q.select("column", (F.col("lo") - spread).alias("min"), (F.col("hi") + spread).alias("max"), "n")


def outlier_rules(bounds: DataFrame, prefix: str = "outlier_") -> list[dict]:
    """``check_range`` rules of an :func:`outlier_bounds` table (a row per column); columns without values have none."""
    return [{"id": prefix + r["column"], "type": "check_range", "column": r["column"], "min": r["min"], "max": r["max"]}
            for r in sorted(bounds.collect()) if r["min"] is not None]
