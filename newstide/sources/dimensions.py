"""Company and sector keyword tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newstide.schemas import COMPANIES


def read_companies_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; the three columns are taken by position."""
    return spark.read.schema(COMPANIES).csv(path, header=True, enforceSchema=True)


def read_sectors_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide CSV: one column of keywords per sector, all text."""
    return spark.read.csv(path, header=True)
