"""Article dates and month periods, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def epoch_seconds(date: Column) -> Column:
    """Seconds since 1970 for ``...T...``, ``... ...`` or day-only dates, else NULL.

    Single pattern letters accept unpadded fields such as ``2020-1-2``. Needs the
    UTC session that ``newstide.prepare`` sets.
    """
    moment, day = F.substring(date, 1, 19), F.substring(date, 1, 10)

    def parsed_as(text: Column, layout: str, shape: str) -> Column:
        # The shape is tested first: a failing parse costs an exception per row.
        return F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout)))

    parsed = F.coalesce(
        parsed_as(moment, "yyyy-M-d'T'H:m:s", "^[0-9]+-[0-9]+-[0-9]+T[0-9]+:"),
        parsed_as(moment, "yyyy-M-d H:m:s", "^[0-9]+-[0-9]+-[0-9]+ [0-9]+:"),
        parsed_as(day, "yyyy-M-d", "^[0-9]+-[0-9]+-[0-9]+$"),
    )
    return F.unix_timestamp(parsed)


def month_of_epoch(seconds: Column) -> Column:
    """``yyyy-MM`` of an epoch second."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM")


def month_number(seconds: Column) -> Column:
    """Months since year 0, a cheap grouping key for :func:`month_of_epoch`."""
    day = F.timestamp_seconds(seconds).cast("date")
    return F.year(day) * 12 + F.month(day) - 1


def add_time_period(articles: DataFrame, date: str = "date") -> DataFrame:
    """Add ``unix`` and ``time_period`` from the date text."""
    return articles.withColumn("unix", epoch_seconds(F.col(date))).withColumn(
        "time_period", month_of_epoch(F.col("unix"))
    )
