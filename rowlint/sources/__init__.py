"""Scans and sinks.

Reading: CSV with a header and every column as text (the form the sample
inputs take), or any Spark source.  Writing: the annotated rows, the clean /
quarantine split in one pass, and the report tables; these replace printed
previews, which cap rows and truncate cells.
"""

from __future__ import annotations

import tempfile
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.report import flat
from ..plans.compile import CompiledPipeline
from .dirty import dirty_customers


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Header row, every column nullable text, Spark's default parsing:
    an empty field is NULL, blanks and surrounding spaces are kept."""
    return spark.read.options(header=True, **options).csv(path)


def read_table(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    return spark.read.format(format).options(**options).load(path)


def spread(df: DataFrame, parallelism: int, keys: Iterable[str] = ()) -> DataFrame:
    """Rows dealt to ``parallelism`` partitions by one exchange: round-robin
    (even, whatever the keys) or hashed on ``keys`` (give unique keys).

    A Parquet row group is read by one task, so a file of one row group runs
    row-local checks in a single task.  Whether an exchange of the whole table
    is worth that is the caller's decision; nothing in the library calls this.
    """
    keys = list(keys)
    return df.repartition(parallelism, *keys) if keys else df.repartition(parallelism)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``.  Where the
    session names none, a local master gets a temporary one and a cluster is
    refused, since its machines share no temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="rowlint-")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """CSV that :func:`read_csv` reads back as it was, blanks around values included
    (NULL and empty text are both an empty field, which reads as NULL)."""
    df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="", **options).mode(mode).csv(path)


def write_annotated(run: CompiledPipeline, path: str, format: str = "parquet", mode: str = "overwrite",
                    partition_by: Iterable[str] | None = None) -> None:
    """The annotated rows, result map included (Parquet and ORC keep maps)."""
    w = run.annotated().write.format(format).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_split(run: CompiledPipeline, path: str, format: str = "parquet", mode: str = "overwrite",
                flag: str = "_dq_passed") -> None:
    """Clean and quarantined rows in ONE pass: partitioned by ``flag``
    (``_dq_passed=true`` / ``=false`` folders); no row is dropped."""
    tagged = run.with_failed_count("_dq_failed").withColumn(flag, F.col("_dq_failed") == 0)
    tagged.write.format(format).mode(mode).partitionBy(flag).save(path)


def write_reports(run: CompiledPipeline, path: str, keys: Iterable[str], format: str = "parquet",
                  mode: str = "overwrite") -> None:
    """``annotated/``, ``flat/`` and ``summary/`` tables under ``path``.

    The input is read and checked once: the summary is counted while the
    annotated rows are written, and ``flat`` is a projection of the written
    table (only its keys and the result map are read back)."""
    keys = list(keys)
    spark = run.staged.sparkSession
    rows, counts = run.observed()
    rows.write.format(format).mode(mode).save(f"{path}/annotated")
    got = counts.get
    n = got["_rows"]
    per_rule = [(r.id, got[r.id], n - got[r.id], n, got[r.id] / n if n else None) for r in run.rules]
    summary = spark.createDataFrame(per_rule, "rule_id string, n_pass long, n_fail long, n_rows long, pass_rate double")
    summary.coalesce(1).write.format(format).mode(mode).save(f"{path}/summary")
    back = spark.read.format(format).schema(rows.schema).load(f"{path}/annotated")
    flat(back, keys, run.rule_ids, run.results_col).write.format(format).mode(mode).save(f"{path}/flat")


__all__ = ["dirty_customers", "read_csv", "read_table", "shared_folder", "spread", "write_annotated", "write_csv", "write_reports", "write_split"]
