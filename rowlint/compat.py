"""DataFrame-level functions with the signatures of the original rule API.

The names and parameters here are fixed values.  Code written against ``check_not_null(df, column, rule_id)``-style calls
keeps working: each call runs a one-rule pipeline whose verdict is appended
to the incoming ``_dq_results`` map.  Chaining many of them copies the map
once per rule; for more than a handful of rules, put them in one
``Pipeline`` spec instead (one projection, one map).
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators import report
from .plans.compile import RESULTS_COL, append_results, quote, status_of
from .plans.pipeline import Pipeline


def _check(df: DataFrame, rule_id: str, rtype: str, column: str, **params: Any) -> DataFrame:
    rule = {"id": rule_id, "type": rtype, "column": column, **{k: v for k, v in params.items() if v is not None}}
    return Pipeline({"stages": [{"name": rtype, "type": "dq", "rules": [rule]}]}).run(df)


def _clean(df: DataFrame, rtype: str, column: str) -> DataFrame:
    return Pipeline({"stages": [{"name": rtype, "type": "cleanse", "rules": [{"type": rtype, "column": column}]}]}).run(df)


def check_not_null(df: DataFrame, column: str, rule_id: str) -> DataFrame:
    return _check(df, rule_id, "check_not_null", column)


def check_regex(df: DataFrame, column: str, pattern: str, rule_id: str) -> DataFrame:
    return _check(df, rule_id, "check_regex", column, pattern=pattern)


def check_min(df: DataFrame, column: str, value: float, rule_id: str) -> DataFrame:
    return _check(df, rule_id, "check_min", column, value=value)


def check_max(df: DataFrame, column: str, value: float, rule_id: str) -> DataFrame:
    return _check(df, rule_id, "check_max", column, value=value)


def check_range(df: DataFrame, column: str, min: float | None, max: float | None, rule_id: str) -> DataFrame:
    return _check(df, rule_id, "check_range", column, min=min, max=max)


def check_in_set(df: DataFrame, column: str, values: list, rule_id: str) -> DataFrame:
    return _check(df, rule_id, "check_in_set", column, values=list(values))


def check_length(df: DataFrame, column: str, min_len: int | None, max_len: int | None, rule_id: str) -> DataFrame:
    return _check(df, rule_id, "check_length", column, min_len=min_len, max_len=max_len)


def clean_trim(df: DataFrame, column: str) -> DataFrame:
    return _clean(df, "clean_trim", column)


def clean_lowercase(df: DataFrame, column: str) -> DataFrame:
    return _clean(df, "clean_lowercase", column)


def clean_uppercase(df: DataFrame, column: str) -> DataFrame:
    return _clean(df, "clean_uppercase", column)


def add_dq_result(df: DataFrame, rule_id: str, is_valid_col: Column) -> DataFrame:
    """Record ``is_valid_col`` (NULL is FAIL) under ``rule_id`` in the map."""
    entry = F.create_map(F.lit(str(rule_id)), status_of(F.coalesce(is_valid_col, F.lit(False))))
    if RESULTS_COL not in df.columns:
        return df.withColumn(RESULTS_COL, entry)
    prev = F.coalesce(F.col(quote(RESULTS_COL)), F.create_map().cast("map<string,string>"))
    return df.withColumn(RESULTS_COL, append_results(prev, entry, [str(rule_id)]))


def get_dq_summary(df: DataFrame) -> DataFrame:
    """``rule_id, n_pass, n_fail, n_rows, pass_rate`` from the result map."""
    return report.summary(df)
