"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Every stage takes ``(spark, docs, sf_dir)`` and gives a frame that is written as Parquet and
reread as the next one's ``docs``. All but the last give the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newstide.llm.common import read_table
from newstide.llm.decontaminate import without_leaks
from newstide.llm.mixing import mixed_corpus
from newstide.llm.ngram_join import one_of_each
from newstide.llm.quality import keep_good
from newstide.llm.sharding import shard_digest
from newstide.workspace import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a fixed limit or lie far from their group go."""
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in 0.8 of their 5-word shingles, directly or by links, one stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain 0.8 of a benchmark item's shingles go."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixed_corpus(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes."""
    return shard_digest(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

# The robust estimates and the slot map have no equal in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
