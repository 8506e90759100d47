"""Reports over an annotated table that carries only the result map.

When the compiled pipeline is at hand, prefer its methods
(``CompiledPipeline.summary/flat/exploded``): they read the verdict columns
and never build or explode a map.  These functions serve tables written
earlier, or produced by several chained runs.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.compile import FAIL, PASS, RESULTS_COL, quote


def exploded(df: DataFrame, keys: Iterable[str] = (), results_col: str = RESULTS_COL) -> DataFrame:
    """One row per (row, rule): ``keys, rule_id, status``."""
    return df.select(*[F.col(quote(k)) for k in keys], F.explode(F.col(quote(results_col))).alias("rule_id", "status"))


def flat(df: DataFrame, keys: Iterable[str], rule_ids: Iterable[str], results_col: str = RESULTS_COL, prefix: str = "") -> DataFrame:
    """``keys`` then one column per rule id (NULL where a row has no verdict)."""
    m = F.col(quote(results_col))
    return df.select(*[F.col(quote(k)) for k in keys], *[m.getItem(i).alias(prefix + i) for i in rule_ids])


def summary(df: DataFrame, results_col: str = RESULTS_COL) -> DataFrame:
    """``rule_id, n_pass, n_fail, n_rows, pass_rate`` from the map alone.

    Explode then group by rule: partial aggregation leaves one row per rule
    per task before the shuffle, so the exchange is rules x tasks rows."""
    e = exploded(df, (), results_col)
    return (
        e.groupBy("rule_id")
        .agg(
            F.count_if(F.col("status") == PASS).alias("n_pass"),
            F.count_if(F.col("status") == FAIL).alias("n_fail"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .withColumn("pass_rate", F.try_divide(F.col("n_pass"), F.col("n_rows")))
    )


def rule_ids(df: DataFrame, results_col: str = RESULTS_COL) -> DataFrame:
    """The distinct rule ids present in a result map (a distributed distinct)."""
    return df.select(F.explode(F.map_keys(F.col(quote(results_col)))).alias("rule_id")).distinct()
