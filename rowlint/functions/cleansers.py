"""Built-in cleansers: ``Column -> Column`` replacements of one column.

A cleanser on a non-text scalar turns the column into text (the value's
string form, then cleaned); validation reports that drift.  Arrays, maps and
structs are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from .checks import RuleTypeError
from .registry import register_cleanser


def _text(c: Column, dtype: DataType, rule: str) -> Column:
    if isinstance(dtype, StringType):
        return c
    if isinstance(dtype, (ArrayType, MapType, StructType)):
        raise RuleTypeError(f"{rule} needs a scalar column, got {dtype.simpleString()}")
    return c.cast("string")


@register_cleanser("clean_trim", result_type=StringType())
def clean_trim(c: Column, dtype: DataType) -> Column:
    """Strip leading and trailing U+0020 only; tabs, newlines, NBSP stay."""
    return F.trim(_text(c, dtype, "clean_trim"))


@register_cleanser("clean_lowercase", result_type=StringType())
def clean_lowercase(c: Column, dtype: DataType) -> Column:
    return F.lower(_text(c, dtype, "clean_lowercase"))


@register_cleanser("clean_uppercase", result_type=StringType())
def clean_uppercase(c: Column, dtype: DataType) -> Column:
    return F.upper(_text(c, dtype, "clean_uppercase"))
