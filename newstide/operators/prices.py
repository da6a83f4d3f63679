"""Company dimension and monthly price change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newstide.functions.dates import month_number, month_of_epoch
from newstide.functions.numbers import relative_change
from newstide.operators.keys import one_per_key


def company_dimension(companies: DataFrame) -> DataFrame:
    """One row per symbol: the smallest (companyname, category)."""
    return one_per_key(companies.select("stockname", "companyname", "category"), ["stockname"])


def join_companies(ticks: DataFrame, companies: DataFrame) -> DataFrame:
    """Distinct (timestamp, symbol, close) with company name and category if known.

    The join side is left to the optimizer, which broadcasts the dimension when its
    measured size allows.
    """
    distinct = ticks.select("timestamp", F.col("stockname").alias("symbol"), "close").distinct()
    dimension = company_dimension(companies).withColumnRenamed("stockname", "symbol")
    return distinct.join(dimension, "symbol", "left").select(
        "timestamp", "symbol", "close", "companyname", "category"
    )


def _usable(close: Column) -> Column:
    return (close > 0) & ~F.isnan(close)


def _first_and_last(ticks: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """First and last (timestamp, close) per month and key, for months with two or more ticks.

    The least and the greatest pair differ exactly when the group has two distinct
    pairs, so repeated ticks need no ``distinct`` of their own: one aggregation, whose
    partial results are all that is shuffled.
    """
    tick = F.struct(F.col("timestamp").alias("ts"), F.col("close").alias("px"))
    return (
        ticks
        .filter(_usable(F.col("close")) & F.col("timestamp").isNotNull())
        .groupBy(month_number(F.col("timestamp")).alias("_month"), *keys)
        .agg(F.min(tick).alias("lo"), F.max(tick).alias("hi"), *extra)
        .filter(F.col("lo") != F.col("hi"))
        .select(
            month_of_epoch(F.col("lo.ts")).alias("time_period"),
            *keys,
            F.col("lo.ts").alias("first_date"),
            F.col("lo.px").alias("first_value"),
            F.col("hi.ts").alias("last_date"),
            F.col("hi.px").alias("last_value"),
            *[F.col(c) for c in (["companyname"] if extra else [])],
        )
        .withColumn(
            "stock_price_change", relative_change(F.col("first_value"), F.col("last_value"))
        )
    )


def calculate_stock_price_change(ticks_with_companies: DataFrame) -> DataFrame:
    """Price change per (month, symbol, category) of the output of :func:`join_companies`."""
    return _first_and_last(
        ticks_with_companies,
        ["symbol", "category"],
        F.min("companyname").alias("companyname"),
    )


def monthly_price_change(ticks: DataFrame, companies: DataFrame) -> DataFrame:
    """Both steps at once: aggregate the ticks first, then join the far fewer months."""
    change = _first_and_last(
        ticks.select("timestamp", F.col("stockname").alias("symbol"), "close"), ["symbol"]
    )
    dimension = company_dimension(companies).withColumnRenamed("stockname", "symbol")
    return change.join(dimension, "symbol", "left").select(
        "time_period", "symbol", "category", "first_date", "first_value",
        "last_date", "last_value", "companyname", "stock_price_change",
    )
