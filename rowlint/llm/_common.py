"""Helpers shared by the operators: scratch tables, row keys, splits."""

from __future__ import annotations

import tempfile
import uuid
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Where it is unset (tests, one machine) the context's checkpoint folder is
    used, and where there is none either, a new temporary one is set; a
    cluster without the setting is refused, since its machines share no
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rowlint-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return it reread.

    Cuts the lineage, so a lost executor costs a reread and not a recompute,
    and lets later readers take only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also maps other letters)."""
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, _LETTERS, _LETTERS.lower()))


def words(c: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def crc_mod(ids, m: int) -> np.ndarray:
    """crc32 of each id written as text, modulo ``m``; a null id counts as 0."""
    return np.array([zlib.crc32(str(int(i)).encode()) % m if i is not None and i == i else 0 for i in ids], np.int64)


def col(name: str) -> Column:
    """A column by its exact name, dots and back ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
