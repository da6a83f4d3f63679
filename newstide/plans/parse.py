"""Job: raw JSON to flat tables, articles as Parquet, prices as CSV."""

from __future__ import annotations

from pyspark.sql import SparkSession

from newstide.sources.articles import read_articles_json
from newstide.sources.prices import PriceLayout, read_prices_json
from newstide.sources.sinks import write_articles_csv, write_prices_csv


def parse_articles(
    spark: SparkSession, source: str, target: str, multi_line: bool = True, csv: str | None = None
) -> None:
    """Articles go on as Parquet, which splits; ``csv`` asks for a CSV export as well."""
    read_articles_json(spark, source, multi_line).write.parquet(target)
    if csv is not None:
        write_articles_csv(spark.read.parquet(target), csv)


def parse_prices(
    spark: SparkSession,
    source: str,
    target: str,
    layout: PriceLayout = PriceLayout(),
    multi_line: bool = True,
) -> None:
    write_prices_csv(read_prices_json(spark, source, layout, multi_line), target)
