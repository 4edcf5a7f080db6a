"""The corpus pipeline: five stages from ``documents`` to a mixed corpus.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; ``run`` writes it as Parquet into the shared folder
(spark.checkpoint.dir) and reads it back as the next stage's docs. All stages
but the last return the columns of ``documents``.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from searchscore.llm import decontamination, line_dedup, mixing, quality_rules, simhash_dedup
from searchscore.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.keep_good(docs, "v2")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate on their source."""
    return line_dedup.drop_boilerplate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash_dedup.keep_one(docs, width=4, max_bits=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix."""
    return mixing.mix(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix)]

#: SimHash needs XXH64, which SQL lacks; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
