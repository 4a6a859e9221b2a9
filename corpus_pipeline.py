"""The corpus pipeline: rules, line dedup, near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns the documents it leaves, with the
columns of ``documents``; the last returns the encoded documents. :func:`run` writes
what a stage returns as Parquet in the shared folder and gives it to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsift.llm import bpe, line_dedup, mixing, near_dup, quality_rules
from rowsift.llm.common import documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality_rules.keep_good(docs, documents(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that five or more of them share (the last keeps them)."""
    return line_dedup.drop_lines(docs, line_dedup.build_state(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; repeats are rows of their own."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that was left, as digests of ids and decoded text."""
    return bpe.encode_table(spark, docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dup", near_duplicates), ("mixing", mixture), ("bpe", encode)]
#: Rules are learned and documents drawn by seeded hashes, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
