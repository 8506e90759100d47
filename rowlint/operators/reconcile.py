"""Two versions of a table compared: which keys came, went or changed, and where.

One exchange, by key.  Both versions are united with a sign, every compared
column is hashed in place, and a key's rows are summed to what two equal sets of
rows would cancel to zero: per column the exclusive or and the signed sum of
the hashes.  All of it is partially aggregated per task, so a key of a third of
all rows costs one row per task, and rows that repeat are counted, not matched.

A changed cell of a key that has one row on each side is seen unless two 64-bit
hashes collide (2^-64).
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..plans.compile import quote

CHANGES = ("added", "removed", "changed", "repeated", "same")
_LOW = (1 << 24) - 1  # summed per key: room for 2^39 rows


def _hashable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _hashable(t.elementType)
    return not isinstance(t, StructType) or all(_hashable(f.dataType) for f in t.fields)


def _cell(name: str) -> Column:
    c = F.col(quote(name))
    return F.xxhash64(c.isNull(), c)  # NULL is a value like any other


def reconcile(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, keep_same: bool = False) -> DataFrame:
    """``keys, change, changed_columns, n_old, n_new``: one row per key that differs.

    ``change`` is ``added`` (no such key in ``old``), ``removed`` (none in ``new``),
    ``changed`` (``changed_columns``, in order, hold other values), or
    ``repeated`` (all its rows are alike, there are only more or fewer of them);
    with ``keep_same`` also ``same``.  ``n_old`` and ``n_new`` count its rows.

    A key may have several rows; they are compared as sets with counts, column
    by column and as whole rows.  Rows that merely exchanged cells are
    ``changed`` without a changed column; where rows that are not all alike
    became more or fewer, every column counts as changed.  NULL keys are one key,
    NULL cells equal each other.  ``columns`` (default: all others, which must be
    the same on both sides) are compared; further columns are not read.  Types are
    widened as in a union; maps cannot be compared.  Two empty tables give an empty
    result.
    """
    keys = list(keys)
    if columns is None:
        odd = set(old.columns) ^ set(new.columns)
        if odd:
            raise ValueError(f"columns on one side only: {sorted(odd)}; name the columns to compare")
        columns = [c for c in old.columns if c not in keys]
    columns = list(columns)
    if not keys:
        raise ValueError("reconcile needs keys")
    if clash := set(keys) & {"change", "changed_columns", "n_old", "n_new"}:
        raise ValueError(f"keys named like a result column: {sorted(clash)}; rename them first")
    names = [quote(c) for c in (*keys, *columns)]
    both = old.select(*names, F.lit(-1).alias("__side")).unionByName(new.select(*names, F.lit(1).alias("__side")))
    bad = [f.name for f in both.schema.fields if not _hashable(f.dataType)]
    if bad:
        raise ValueError(f"cannot compare columns of maps or variants: {bad}")
    side = F.col("__side")
    marks = {f"__c{i}": _cell(c) for i, c in enumerate(columns)}
    marks["__row"] = F.xxhash64(F.lit(0), *marks.values())
    rows = both.select(*[F.col(quote(k)) for k in keys], side, *[m.alias(n) for n, m in marks.items()])
    cancelled = [a for n in marks for a in (
        F.bit_xor(n).alias(f"x{n}"), F.sum(F.col(n).bitwiseAND(F.lit(_LOW).cast("long")) * side).alias(f"s{n}"))]
    one = rows.groupBy(*[F.col(quote(k)) for k in keys]).agg(
        F.count_if(side < 0).alias("__old"), F.count_if(side > 0).alias("__new"),
        F.min("__row").alias("__lo"), F.max("__row").alias("__hi"), *cancelled)

    def moved(n: str) -> Column:
        return (F.col(f"x{n}") != 0) | (F.col(f"s{n}") != 0)

    alike = F.col("__lo") == F.col("__hi")
    more = F.col("__old") != F.col("__new")
    differs = more | reduce(or_, [moved(n) for n in marks])
    change = (F.when(F.col("__old") == 0, "added").when(F.col("__new") == 0, "removed")
              .when(alike & more, "repeated").when(~alike & differs, "changed").otherwise("same"))
    which = [F.when(more | moved(f"__c{i}"), F.lit(c)) for i, c in enumerate(columns)]
    none = F.array().cast("array<string>")
    out = one.select(*[F.col(quote(k)) for k in keys], change.alias("change"),
                     F.when(change == "changed", F.array_compact(F.array(*which)) if which else none).otherwise(none).alias("changed_columns"),
                     F.col("__old").alias("n_old"), F.col("__new").alias("n_new"))
    return out if keep_same else out.where("change <> 'same'")


def reconcile_summary(changes: DataFrame) -> DataFrame:
    """``change, column, n_keys`` of a :func:`reconcile` result: keys per change
    (``column`` NULL), and per changed column."""
    per = changes.select("change", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col("changed_columns"))).alias("column"))
    return per.groupBy("change", "column").agg(F.count(F.lit(1)).alias("n_keys"))
