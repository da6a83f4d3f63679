"""Which companies and sectors the articles mention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from newstide.functions.dates import add_time_period
from newstide.functions.text import clean_company_name, plain_text, tokens_of
from newstide.operators.contains import DEFAULTS, ContainsLimits, contains_join
from newstide.operators.keys import row_digest
from newstide.operators.substrings import Lookup, with_labels
from newstide.workspace import stage

FIELDS = ["title", "text", "short_description"]


def company_needles(companies: DataFrame) -> DataFrame:
    """Distinct (symbol, companyname) with the text to look for; empty texts are dropped."""
    known = F.col("companyname").isNotNull() & (F.col("companyname") != "null")
    return (
        companies.filter(known)
        .select("symbol", "companyname", F.lower(clean_company_name(F.col("companyname"))).alias("needle"))
        .distinct()
        .filter(F.length("needle") > 0)
    )


def stock_mentions(
    articles: DataFrame, companies: DataFrame, limits: ContainsLimits = DEFAULTS
) -> DataFrame:
    """Articles per (stock, month) naming the company, with their mean sentiment.

    Companies sharing a cleaned name share one search: pairs are counted per name
    and month in the task that finds them, and only those counts meet the companies.
    """
    named = company_needles(companies)
    hits = contains_join(
        articles.select(*FIELDS, "time_period", "sentiment"),
        named.select("needle").distinct(),
        FIELDS,
        "needle",
        limits,
        keep=["time_period", "sentiment"],
    )
    per_needle = hits.groupBy("needle", "time_period").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("sentiment").alias("total"),
        F.count("sentiment").alias("scored"),
    )
    return (
        per_needle.join(named, "needle")
        .groupBy(F.col("symbol").alias("stock"), "time_period")
        .agg(
            F.sum("n").alias("number_of_articles"),
            F.min("companyname").alias("name"),
            F.try_divide(F.sum("total"), F.sum("scored")).alias("sentiment"),
        )
    )


def sector_keywords(sectors: DataFrame) -> DataFrame:
    """Wide keyword table (one column per sector) as distinct (sector, keyword)."""
    long = sectors.unpivot([], [F.col(f"`{c}`") for c in sectors.columns], "sector", "keyword")
    return long.filter(F.col("keyword").isNotNull() & (F.col("keyword") != "")).distinct()


def _per_sector(articles: DataFrame, keywords: DataFrame, limits: ContainsLimits) -> DataFrame:
    """Count distinct articles per (sector, month), in one search for all keywords.

    The same text on several dates counts once per sector, under its smallest
    (time_period, date, sentiment). Copies meet by digest before the search, so each text is
    searched once, and what is found needs no further move to be told apart.
    """
    keyed = articles.select(
        *FIELDS, "time_period", "date", "sentiment", row_digest(articles, FIELDS).alias("_digest")
    )
    texts = keyed.groupBy("_digest").agg(
        F.min(F.struct("time_period", "date", "sentiment")).alias("_article"),
        *[F.first(f).alias(f) for f in FIELDS],
    )
    hits = contains_join(texts, keywords, FIELDS, "keyword", limits)
    return (
        hits.select("sector", "_digest", "_article")
        .distinct()
        .groupBy("sector", F.col("_article.time_period").alias("time_period"))
        .agg(
            F.count(F.lit(1)).alias("number_of_articles"),
            F.avg("_article.sentiment").alias("sentiment"),
        )
    )


def sector_mentions(
    articles: DataFrame, sectors: DataFrame, limits: ContainsLimits = DEFAULTS
) -> DataFrame:
    """Distinct articles per (sector, month) holding a keyword, with mean sentiment."""
    return _per_sector(articles, sector_keywords(sectors), limits)


def search_for_sector(
    articles: DataFrame, sectors: DataFrame, sector: str, limits: ContainsLimits = DEFAULTS
) -> DataFrame:
    """:func:`sector_mentions` for one column of the keyword table."""
    return _per_sector(articles, sector_keywords(sectors.select(f"`{sector}`")), limits)


def _explode_and_count(df: DataFrame, array: str, name: str) -> DataFrame:
    return (
        # The outer form spares the optimizer's size test, which would build the array twice.
        df.select(F.explode_outer(array).alias(name), "time_period", "sentiment")
        .filter(F.col(name).isNotNull())
        .groupBy(name, "time_period")
        .agg(
            F.count(F.lit(1)).alias("number_of_articles"), F.avg("sentiment").alias("sentiment")
        )
    )


def explode_stocks_and_aggregate(articles: DataFrame) -> DataFrame:
    """Articles per (stock, month) from the array column ``stocks``."""
    return _explode_and_count(articles, "stocks", "stock")


def explode_sectors_and_aggregate(articles: DataFrame) -> DataFrame:
    """Articles per (sector, month) from the array column ``sectors``."""
    return _explode_and_count(articles, "sectors", "sector")


def _token_parts(tokens: DataFrame, parts: DataFrame, limits: ContainsLimits) -> DataFrame:
    """(token, part): which parts lie inside which of the distinct tokens."""
    vocabulary = tokens.select("token").distinct()
    inside = contains_join(vocabulary, parts, ["token"], "part", limits)
    # The empty part lies in every token; the empty token, which every text is given, tells it.
    empty = parts.filter(F.col("part") == "").select(F.lit("").alias("token"), "part")
    return stage(inside.unionByName(empty), "token-parts")


def _string_bytes(df: DataFrame, limits: ContainsLimits) -> int:
    """Measured size of a table of strings, once in memory."""
    size = reduce(lambda a, b: a + b, [F.octet_length(c) for c in df.columns]) + F.lit(limits.row_overhead_bytes)
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def _sized(df: DataFrame, limits: ContainsLimits) -> DataFrame:
    """``df`` marked for broadcast if its measured strings fit, as it is otherwise."""
    return F.broadcast(df) if _string_bytes(df, limits) <= limits.broadcast_bytes else df


def add_stocks_sectors_sentiment(
    articles: DataFrame,
    names: DataFrame,
    sectors: DataFrame,
    sentiment: Column | None = None,
    limits: ContainsLimits = DEFAULTS,
) -> DataFrame:
    """Per article the arrays of company names and sectors its tokens contain.

    A name is found if it lies inside one token, a sector if every part of one of its
    keywords, split at spaces, lies inside some token. ``names`` holds ``companyname``,
    ``sectors`` is the wide keyword table. The score is the given column, by default the
    constant 0.5 for any text.

    No token holds a space, so a part lies inside some token if it lies in the plain text: names
    and parts are broadcast by their measured size, every text is searched once for all of them
    and nothing is shuffled. Larger dictionaries meet the articles by token.
    """
    plain = plain_text(*[F.col(f) for f in FIELDS])
    dated = add_time_period(articles)
    score = sentiment if sentiment is not None else F.when(plain.isNotNull(), F.lit(0.5))
    # Tokens are lower-case ASCII letters and digits: nothing else lies inside one.
    possible = F.col("part").rlike("^[a-z0-9]*$")
    wanted_names = names.select(F.lower("companyname").alias("part"), F.col("companyname").alias("stock")).filter(possible)
    wanted_names = stage(wanted_names.distinct(), "names")
    keywords = sector_keywords(sectors).withColumn("parts", F.array_distinct(F.split(F.lower("keyword"), " ", -1)))
    keywords = stage(keywords, "keywords")
    output = ["title", "unix", "time_period", "stocks", "sectors", "sentiment"]

    whole = keywords.select("sector", "keyword", F.array_join("parts", " ").alias("parts"))
    if _string_bytes(wanted_names, limits) + _string_bytes(whole, limits) <= limits.broadcast_bytes:
        text = F.when(plain.isNotNull(), F.array(plain)).otherwise(F.array().cast("array<string>"))
        base = dated.select("title", "unix", "time_period", score.alias("sentiment"), text.alias("_texts"))
        stocks = Lookup([(row["stock"], [row["part"]]) for row in wanted_names.collect()], limits.gram)
        named = Lookup([(row["sector"], row["parts"]) for row in keywords.collect()], limits.gram)
        return with_labels(base, "_texts", T.StringType(), stocks=stocks, sectors=named).select(*output)

    base = dated.select(
        "title", "unix", "time_period", score.alias("sentiment"), row_digest(dated, FIELDS).alias("_digest")
    )
    # One article at a time holds its tokens; a text of spaces has the empty token as well.
    listed = F.array_union(tokens_of(plain), F.array(F.lit("")))
    tokens = stage(
        articles.select(row_digest(articles, FIELDS).alias("_digest"), F.explode_outer(listed).alias("token"))
        .filter(F.col("token").isNotNull()),
        "tokens",
    )
    wanted_parts = keywords.select("sector", "keyword", F.size("parts").alias("n"), F.explode("parts").alias("part"))
    wanted_parts = stage(wanted_parts, "keyword-parts")

    parts = wanted_names.select("part").union(wanted_parts.select("part").filter(possible)).distinct()
    found = _sized(_token_parts(tokens, parts, limits), limits)
    # Copies of a text and repeated tokens collapse before the parts move.
    met = stage(tokens.join(found, "token").select("_digest", "part").distinct(), "article-parts")
    stocks = (
        met.join(_sized(wanted_names, limits), "part").groupBy("_digest").agg(F.array_sort(F.collect_set("stock")).alias("stocks"))
    )
    whole = met.join(wanted_parts, "part").groupBy("_digest", "sector", "keyword").agg(
        F.count(F.lit(1)).alias("found"), F.min("n").alias("n")
    )
    named = whole.filter("found = n").groupBy("_digest").agg(F.array_sort(F.collect_set("sector")).alias("sectors"))
    none = F.array().cast("array<string>")
    return (
        base.join(stocks, "_digest", "left")
        .join(named, "_digest", "left")
        .select(
            "title", "unix", "time_period",
            F.coalesce("stocks", none).alias("stocks"), F.coalesce("sectors", none).alias("sectors"), "sentiment",
        )
    )
