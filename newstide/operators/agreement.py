"""Agreement of sentiment and price per month, and its roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newstide.functions.agreement import sign_agreement
from newstide.workspace import stage


def _with_agreement(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "correlation", sign_agreement(F.col("sentiment"), F.col("stock_price_change"))
    )


def stock_agreement(mentions: DataFrame, prices: DataFrame) -> DataFrame:
    """Stock months with the price change of their symbol, NULL if there is none."""
    change = prices.select(
        F.col("symbol").alias("stock"), "time_period", "stock_price_change"
    )
    return _with_agreement(mentions.join(change, ["stock", "time_period"], "left"))


def sector_agreement(
    mentions: DataFrame, prices: DataFrame, sector_price: str = "per_symbol"
) -> DataFrame:
    """Sector months with the price changes of their category.

    ``per_symbol`` gives one row per symbol of the category; ``avg`` averages the
    category first and keeps one row per sector month, as the upserts need.
    """
    change = prices.select(
        F.col("category").alias("sector"), "time_period", "stock_price_change"
    )
    keys = ["sector", "time_period"]
    if sector_price == "avg":
        change = change.groupBy(*keys).agg(F.avg("stock_price_change").alias("stock_price_change"))
        return _with_agreement(mentions.join(change, keys, "left"))
    if sector_price != "per_symbol":
        raise ValueError(f"sector_price is 'per_symbol' or 'avg', not {sector_price!r}")
    # A left join keeps a crowded category on its right side, which cannot be split.
    # As an inner join plus the months without a price, either side can be. The mentions, a
    # row per sector and month, are used twice and therefore written once.
    mentions = stage(mentions, "sector-mentions")
    matched = change.join(mentions, keys).select(*mentions.columns, "stock_price_change")
    unmatched = mentions.join(change.select(*keys).distinct(), keys, "left_anti").select(
        *mentions.columns, F.lit(None).cast("double").alias("stock_price_change")
    )
    return _with_agreement(matched.union(unmatched))


def sector_rollup(agreement: DataFrame) -> DataFrame:
    """Articles and unweighted mean agreement per sector."""
    return agreement.groupBy("sector").agg(
        F.sum("number_of_articles").alias("number_of_articles"),
        F.avg("correlation").alias("corr"),
    )


def stock_rollup(agreement: DataFrame) -> DataFrame:
    """Name, articles and unweighted mean agreement per stock."""
    return agreement.groupBy("stock").agg(
        F.min("name").alias("name"),
        F.sum("number_of_articles").alias("number_of_articles"),
        F.avg("correlation").alias("corr"),
    )


def by_key_and_latest_month(df: DataFrame, key: str) -> DataFrame:
    """Report order: key ascending, newest month first."""
    return df.orderBy(F.col(key).asc(), F.col("time_period").desc())


def by_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.col(key).asc())
