"""Job: raw articles to scored articles with a month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newstide.functions.dates import add_time_period
from newstide.functions.sentiment import ENGLISH, Lexicon
from newstide.operators.scoring import add_sentiment
from newstide.schemas import RAW_ARTICLES
from newstide.sources.articles import read_articles_csv
from newstide.sources.sinks import write_scored_articles


def scored(articles: DataFrame, lexicon: Lexicon = ENGLISH) -> DataFrame:
    return add_time_period(add_sentiment(articles, lexicon))


def score_articles(
    spark: SparkSession, source: str, target: str, lexicon: Lexicon = ENGLISH, form: str = "parquet"
) -> None:
    """Score what :func:`parse_articles` wrote, or CSV if ``form`` says so."""
    if form not in ("parquet", "csv"):
        raise ValueError(f"form is 'parquet' or 'csv', not {form!r}")
    if form == "csv":
        articles = read_articles_csv(spark, source)
    else:
        articles = spark.read.schema(RAW_ARTICLES).parquet(source)
    write_scored_articles(scored(articles, lexicon), target)
