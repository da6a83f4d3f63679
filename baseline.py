"""Time the straightforward form of some queries next to this library's form.

The straightforward forms use row-at-a-time Python functions, whole groups collected
into lists, one scan per sector, and conditionless joins with the text lower-cased per
pair. Both forms read the same tables and their row counts are compared.

    python baseline.py [folder [query ...]]
"""

from __future__ import annotations

import json
import re
import sys
import time
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from newstide import build_session
from newstide.checks import bindings as b
from newstide.functions.dates import add_time_period
from newstide.functions.text import article_text, clean_company_name
from newstide.operators import mentions as m
from newstide.operators.prices import company_dimension, join_companies, monthly_price_change
from newstide.operators.scoring import add_sentiment


def month_in_python(seconds):
    if seconds is None:
        return None
    return datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y-%m")


def date_in_python(date):
    for length, layout in ((19, "%Y-%m-%dT%H:%M:%S"), (19, "%Y-%m-%d %H:%M:%S"), (10, "%Y-%m-%d")):
        try:
            parsed = datetime.strptime(date[:length], layout)
        except (ValueError, TypeError):
            continue
        return int(parsed.replace(tzinfo=timezone.utc).timestamp())
    return None


def change_in_python(pairs):
    if len(pairs) < 2:
        return None
    ordered = sorted((p["timestamp"], p["close"]) for p in pairs)
    return (ordered[-1][1] - ordered[0][1]) / ordered[0][1]


def plain_dates(spark, folder):
    unix = F.udf(date_in_python, T.LongType())(F.col("date"))
    month = F.udf(month_in_python, T.StringType())
    news = b.raw_news(spark, folder).withColumn("unix", unix)
    return news.withColumn("time_period", month("unix")).select("doc_id", "unix", "time_period")


def own_dates(spark, folder):
    return add_time_period(b.raw_news(spark, folder)).select("doc_id", "unix", "time_period")


def month_of_symbol(ticks):
    """The ticks of one symbol and month as a pandas frame, in Python to one row or none."""
    pairs = ticks[["timestamp", "close"]].drop_duplicates().to_dict("records")
    change = change_in_python(pairs)
    keys = ticks[["time_period", "symbol", "category"]].head(1)
    return keys.assign(change=change) if change is not None else keys.iloc[:0].assign(change=0.0)


def plain_prices(spark, folder):
    months = join_companies(b.ticks(spark, folder), b.companies(spark, folder)).filter("close > 0")
    months = months.withColumn("time_period", F.udf(month_in_python)("timestamp"))
    return months.groupBy("symbol", "category", "time_period").applyInPandas(
        month_of_symbol, "time_period string, symbol string, category string, change double"
    )


def own_prices(spark, folder):
    return monthly_price_change(b.ticks(spark, folder), b.companies(spark, folder))


def held(column):
    needle = F.lower(column)
    tests = [F.lower(F.col(f)).contains(needle) for f in m.FIELDS]
    return reduce(lambda left, right: left | right, tests)


def plain_sectors(spark, folder):
    """One pass over the articles per keyword, then distinct texts per sector."""
    news = b.news(spark, folder)
    found = [
        news.filter(held(F.lit(row.keyword))).select(F.lit(row.sector).alias("sector"), *m.FIELDS)
        for row in m.sector_keywords(b.sectors(spark, folder)).collect()
    ]
    return reduce(DataFrame.unionAll, found).distinct().groupBy("sector").agg(F.count(F.lit(1)).alias("n"))


def own_sectors(spark, folder):
    found = m.sector_mentions(b.news(spark, folder), b.sectors(spark, folder))
    return found.groupBy("sector").agg(F.sum("number_of_articles").alias("n"))


def companies(spark, folder):
    return company_dimension(b.companies(spark, folder)).withColumnRenamed("stockname", "symbol")


def plain_stocks(spark, folder):
    named = companies(spark, folder).select("symbol", "companyname").distinct()
    pairs = b.news(spark, folder).crossJoin(named.filter(F.col("companyname").isNotNull()))
    cleaned = clean_company_name(F.col("companyname"))
    return (
        pairs.filter(held(cleaned) & (F.length(cleaned) > 0))
        .groupBy("symbol", "time_period")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("sentiment").alias("sentiment"))
    )


def own_stocks(spark, folder):
    return m.stock_mentions(b.news(spark, folder), companies(spark, folder))


def sentiment_in_python(text):
    """Sign and confidence of the sentence with the clearest words, the first of several."""
    best, sign = -1.0, 0
    for sentence in re.split(r"[.!?\n]+", re.sub(r"[^A-Za-z0-9 .!?\n]", "", text or "").lower()):
        if sentence.strip():
            words = sentence.split(" ")
            good = sum(w in b.LEXICON.positive for w in words)
            bad = sum(w in b.LEXICON.negative for w in words)
            clear = abs(good - bad) / (good + bad) if good + bad else 0.0
            if clear > best:
                best, sign = clear, (good > bad) - (good < bad)
    return sign * best if best >= 0 else None


def plain_sentiment(spark, folder):
    text = article_text(*[F.col(f) for f in m.FIELDS])
    scored = F.udf(sentiment_in_python, T.DoubleType())(text)
    return b.raw_news(spark, folder).select(*m.FIELDS, "date", scored.alias("sentiment"))


def own_sentiment(spark, folder):
    return add_sentiment(b.raw_news(spark, folder), b.LEXICON)


PAIRS = {
    "date_to_month": (plain_dates, own_dates),
    "monthly_price_change": (plain_prices, own_prices),
    "sentence_sentiment": (plain_sentiment, own_sentiment),
    "sector_mentions": (plain_sectors, own_sectors),
    "stock_mentions": (plain_stocks, own_stocks),
}


def timed(query, spark, folder):
    started = time.perf_counter()
    rows = query(spark, folder).collect()
    return len(rows), round(time.perf_counter() - started, 2)


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "baseline",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(own_prices, spark, folder)  # warm up the JVM
    for name in sys.argv[2:] or PAIRS:
        plain, own = PAIRS[name]
        own_rows, own_seconds = timed(own, spark, folder)
        plain_rows, plain_seconds = timed(plain, spark, folder)
        result = {
            "query": name, "plain_sec": plain_seconds, "own_sec": own_seconds,
            "ratio": round(plain_seconds / own_seconds, 2), "rows_equal": plain_rows == own_rows,
        }
        print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
