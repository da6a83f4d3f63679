"""Articles from JSON, CSV and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newstide.schemas import ARTICLE_COLUMNS, RAW_ARTICLES, SCORED_ARTICLES
from newstide.sources.corrupt import good_rows, with_corrupt
from newstide.sources.json_arrays import split_json_rows
from newstide.sources.optional import or_none


def read_articles_json(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    """Ten text columns from JSON objects; other keys are ignored, absent ones NULL.

    ``multi_line`` reads files that hold one array of objects, each file in one task.
    For large inputs write one object per line and pass ``False``: such files split.
    Lists (authors, for instance) arrive as their JSON text. What is no JSON object is not
    an article: :func:`corrupt_records` gives it instead.
    """
    rows = with_corrupt(spark, path, RAW_ARTICLES, multi_line)
    return good_rows(rows, RAW_ARTICLES).select(*ARTICLE_COLUMNS)


def read_articles_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """:func:`read_articles_json` for large files of one array each, read by many tasks.

    Lists arrive as JSON text without the white space they have in the file.
    """
    rows = split_json_rows(spark, path, RAW_ARTICLES)
    return good_rows(rows, RAW_ARTICLES).select(*ARTICLE_COLUMNS)


def read_articles_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    """Headerless CSV with the ten article columns.

    Texts may hold line breaks inside quotes. Where every article is known to be one
    line, ``multi_line=False`` lets Spark split the files.
    """
    return spark.read.schema(RAW_ARTICLES).csv(path, header=False, multiLine=multi_line)


def read_scored_articles(spark: SparkSession, path: str) -> DataFrame | None:
    """Scored articles, or None when there are none."""
    articles = or_none(lambda: spark.read.schema(SCORED_ARTICLES).parquet(path))
    if articles is None or articles.isEmpty():
        return None
    return articles
