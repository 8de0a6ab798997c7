"""A corpus from raw documents to packed token sequences: five stages, each on all that its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridstone.llm import best_fit, decontaminate, jaccard_join, line_dedup, quality_rules
from gridstone.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines, and shorter runs of many words, go from the texts; n_chars follows the text."""
    return line_dedup.dedup_lines(docs, length_column="n_chars", long=line_dedup.LONG)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences."""
    return best_fit.pack(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontaminated), ("best-fit packing", packing)]

#: The near-duplicate stage's components and the packing can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of documents. Every stage's result is written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
