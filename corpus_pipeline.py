"""The corpus pipeline: five stages over ``documents``, each written and reread.

Stage by stage: toxic documents go; lines that an earlier document holds go;
of each group of near-duplicates the smallest ``doc_id`` stays; documents that
hold a benchmark item go; what is left is mixed to the target weights, with
``copies`` telling how often each chosen document is to be read.

The first four return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowlint.llm import decontam, line_dedup, mixing, near_dedup, toxicity
from rowlint.llm._common import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The chosen documents with ``copies``, ``domain`` and ``tokens``, always the computed ones;
    columns of these names that the documents bring are kept as ``input_copies`` and so on."""
    made = ["copies", "domain", "tokens"]
    kept = []
    for c in docs.columns:
        name = c
        while name in made or (name != c and name in docs.columns):
            name = f"input_{name}"
        kept.append(F.col("row").getField(c).alias(name))
    return mixing.mix(docs).select(*kept, *made)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

# a trained classifier is not SQL: tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``, each written to the shared folder and reread."""
    top = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{i}-{name}")
        docs = spark.read.parquet(f"{top}/{i}-{name}")
    return docs
