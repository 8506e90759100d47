"""Built-in row checks: each returns a boolean Column, never a DataFrame.

Returning expressions (not DataFrames) is what lets a whole ``dq`` stage
become one projection.  Every check is total under ANSI mode: text that is
not a number is a FAIL, not a job abort (``try_cast``), and set literals are
shaped to the column type up front.  A NULL predicate is a FAIL once the
status is taken (see ``plans.compile``).
"""

from __future__ import annotations

import datetime
import math
import re
import struct
from decimal import Context, Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from .registry import Param, register_check


_EXACT = Context(prec=400)


class RuleTypeError(TypeError):
    """A rule cannot apply to a column of this type (raised at compile time)."""


def _as_text(c: Column, dtype: DataType, rule: str) -> Column:
    if isinstance(dtype, (StringType, NullType)):
        return c
    if isinstance(dtype, (ArrayType, MapType, StructType)):
        raise RuleTypeError(f"{rule} needs a scalar column, got {dtype.simpleString()}")
    return c.cast("string")


def _as_number(c: Column, dtype: DataType, rule: str) -> Column:
    """Numbers compare natively; text goes through double, bad text -> NULL."""
    if isinstance(dtype, NumericType):
        return c
    if isinstance(dtype, (StringType, NullType)):
        return c.try_cast("double")
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        raise RuleTypeError(
            f"{rule} compares numbers; column is {dtype.simpleString()}. "
            "Check dates with check_regex or cast them in a cleanse first"
        )
    raise RuleTypeError(f"{rule} compares numbers; column is {dtype.simpleString()}")


def _bounds_given(params: dict[str, Any], lo: str, hi: str, rule: str) -> list[str]:
    problems = []
    if params.get(lo) is None and params.get(hi) is None:
        problems.append(f"{rule} needs {lo} or {hi}")
    a, b = params.get(lo), params.get(hi)
    if a is not None and b is not None and a > b:
        problems.append(f"{rule}: {lo} {a} is above {hi} {b}; nothing can pass")
    return problems


def _number(v) -> Column:
    """A numeric literal; whole numbers beyond 64 bits as decimals."""
    if isinstance(v, int) and not -(1 << 63) <= v < 1 << 63:
        v = Decimal(v)
    return F.lit(v)


@register_check("check_not_null")
def check_not_null(c: Column, dtype: DataType) -> Column:
    """PASS iff the value is not NULL; empty and blank strings pass."""
    return c.isNotNull()


@register_check("check_regex", params=[Param("pattern", "str")])
def check_regex(c: Column, dtype: DataType, pattern: str) -> Column:
    """PASS iff the (Java) pattern is found in the value, unanchored."""
    return _as_text(c, dtype, "check_regex").rlike(pattern)


@register_check("check_min", params=[Param("value", "number")])
def check_min(c: Column, dtype: DataType, value: float) -> Column:
    """PASS iff number(value) >= bound, inclusive."""
    return _as_number(c, dtype, "check_min") >= _number(value)


@register_check("check_max", params=[Param("value", "number")])
def check_max(c: Column, dtype: DataType, value: float) -> Column:
    """PASS iff number(value) <= bound, inclusive."""
    return _as_number(c, dtype, "check_max") <= _number(value)


@register_check(
    "check_range",
    params=[Param("min", "number", required=False), Param("max", "number", required=False)],
    check=lambda p: _bounds_given(p, "min", "max", "check_range"),
)
def check_range(c: Column, dtype: DataType, min: float | None = None, max: float | None = None) -> Column:
    """PASS iff min <= number(value) <= max; a missing bound is open."""
    x = _as_number(c, dtype, "check_range")
    if min is not None and max is not None:
        return x.between(_number(min), _number(max))
    if min is not None:
        return x >= _number(min)
    return x <= _number(max)


def _set_literals(values: list[Any], dtype: DataType) -> list[Column]:
    """Literals shaped to the column type, deduplicated, NULLs dropped.

    Text columns compare as text (a YAML ``False`` becomes ``'false'``, as a
    Spark cast prints it).  Other columns keep a literal only if their type can
    hold it exactly (``_fitting``); one that does not fit can never match.
    """
    seen: set[tuple[str, Any]] = set()
    out = []
    target = StringType() if isinstance(dtype, NullType) else dtype
    for v in values:
        if v is None:
            continue
        key = (type(v).__name__, v)
        if key in seen:
            continue
        seen.add(key)
        if isinstance(target, StringType):
            out.append(F.lit(v).cast(target))
        elif (fit := _fitting(v, target)) is not None:
            out.append(F.lit(fit).try_cast(target))
    return out


_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_TIME = re.compile(r"\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}.*)?")


def _fitting(v: Any, dtype: DataType) -> Any:
    """``v`` if a column of ``dtype`` can hold exactly that value, else None.

    Nothing is rounded, cut or completed: no 1.5 in an integer column, no third
    decimal in a decimal(10,2), no bool as a number, no year as a date.
    """
    if isinstance(dtype, BooleanType):
        word = {"true": True, "false": False}.get(v.strip().lower()) if isinstance(v, str) else v
        return word if isinstance(word, bool) else None
    if isinstance(dtype, NumericType):
        if isinstance(v, bool) or not isinstance(v, (int, float, str, Decimal)):
            return None
        if isinstance(dtype, (FloatType, DoubleType)):
            try:
                x = float(v)
                if isinstance(dtype, FloatType) and math.isfinite(x):
                    x = struct.unpack("f", struct.pack("f", x))[0]
                same = isinstance(v, str) or x == v or (x != x and v != v)
            except (ValueError, OverflowError):
                return None
            if isinstance(v, str) and isinstance(dtype, FloatType) and x != float(v):
                return None
            return x if same else None
        try:
            exact = Decimal(repr(v) if isinstance(v, float) else v)
        except InvalidOperation:
            return None
        if not exact.is_finite():
            return None
        if isinstance(dtype, DecimalType):
            scaled = exact.scaleb(dtype.scale, _EXACT)
            return exact if scaled == scaled.to_integral_value() and abs(scaled) < 10 ** dtype.precision else None
        bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[dtype.simpleString()]
        return int(exact) if exact == exact.to_integral_value() and -(1 << bits - 1) <= exact < 1 << bits - 1 else None
    if isinstance(dtype, DateType):
        if isinstance(v, datetime.datetime):
            return v.date() if v.time() == datetime.time() and v.tzinfo is None else None
        return v if isinstance(v, datetime.date) or isinstance(v, str) and _DATE.fullmatch(v.strip()) else None
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return v if isinstance(v, datetime.date) or isinstance(v, str) and _TIME.fullmatch(v.strip()) else None
    return v


@register_check("check_in_set", params=[Param("values", "list")])
def check_in_set(c: Column, dtype: DataType, values: list[Any]) -> Column:
    """PASS iff the value equals a member of the list; case-sensitive.

    Catalyst turns a long literal list into a hash ``INSET``; the list lives
    in the plan, so it must stay spec-sized (for table-sized sets use
    ``check_in_table``).
    """
    if isinstance(dtype, (ArrayType, MapType, StructType, BinaryType)):
        raise RuleTypeError(f"check_in_set needs a scalar column, got {dtype.simpleString()}")
    lits = _set_literals(list(values), dtype)
    if not lits:
        return F.lit(False)
    return c.isin(*lits)


def _length_of(c: Column, dtype: DataType) -> Column:
    # code points for text, bytes for binary, text form for anything scalar
    if isinstance(dtype, (StringType, BinaryType, NullType)):
        return F.length(c)
    if isinstance(dtype, BooleanType) or not isinstance(dtype, (ArrayType, MapType, StructType)):
        return F.length(c.cast("string"))
    raise RuleTypeError(f"check_length needs a scalar column, got {dtype.simpleString()}")


@register_check(
    "check_length",
    params=[
        Param("min_len", "int", required=False, aliases=("min",)),
        Param("max_len", "int", required=False, aliases=("max",)),
    ],
    check=lambda p: _bounds_given(p, "min_len", "max_len", "check_length"),
)
def check_length(c: Column, dtype: DataType, min_len: int | None = None, max_len: int | None = None) -> Column:
    """PASS iff min_len <= length <= max_len (code points; bytes for binary)."""
    n = _length_of(c, dtype)
    if min_len is not None and max_len is not None:
        return (n >= F.lit(min_len)) & (n <= F.lit(max_len))
    if min_len is not None:
        return n >= F.lit(min_len)
    return n <= F.lit(max_len)
