"""Every registered query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newstide.checks import bindings as b
from newstide.checks.bindings import with_views
from newstide.functions import numbers, price_arrays, text
from newstide.functions.agreement import product_sign, sign_agreement
from newstide.functions.dates import add_time_period
from newstide.operators import mentions as m
from newstide.operators import upsert as u
from newstide.operators.agreement import (
    by_key,
    by_key_and_latest_month,
    sector_agreement,
    sector_rollup,
    stock_agreement,
    stock_rollup,
)
from newstide.operators.contains import contains_join
from newstide.operators.keys import new_articles
from newstide.operators.prices import (
    calculate_stock_price_change,
    company_dimension,
    join_companies,
    monthly_price_change,
)
from newstide.operators.scoring import add_sentiment
from newstide.plans.analyse import ResultTables, analyse
from newstide.plans.export import FOLDERS, export_tables
from newstide.schemas import ARTICLE_COLUMNS, RAW_ARTICLES, RAW_TICKS
from newstide.sources import sinks
from newstide.sources.articles import (
    read_articles_array,
    read_articles_csv,
    read_articles_json,
    read_scored_articles,
)
from newstide.sources.corrupt import corrupt_records
from newstide.sources.dimensions import read_companies_csv, read_sectors_csv
from newstide.sources.prices import read_prices_array, read_prices_csv, read_prices_json
from newstide.sources.tables import StoredTable
from newstide.streaming.arrivals import analyse_arrivals
from newstide.workspace import fresh_path, spread

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None):
    def register(query: Query) -> Query:
        CHECKS[query.__name__] = Check(query, sql)
        return query

    return register


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- prices --------------------------------------------------------------------------

_PRICE_OUT = """SELECT time_period, symbol, category, first_date, first_value, last_date,
  last_value, companyname, round(stock_price_change, 6) AS stock_price_change FROM prices"""
_PRICE_VIEWS = ["ticks", "companies", "dimension", "prices"]


def _prices(spark: SparkSession, folder: str) -> DataFrame:
    return monthly_price_change(b.ticks(spark, folder), b.companies(spark, folder))


@check(with_views(_PRICE_VIEWS, _PRICE_OUT))
def monthly_prices(spark, folder):
    return by_key_and_latest_month(_rounded(_prices(spark, folder), "stock_price_change"), "symbol")


@check(with_views(_PRICE_VIEWS, _PRICE_OUT))
def price_change_of_joined_ticks(spark, folder):
    joined = join_companies(b.ticks(spark, folder), b.companies(spark, folder))
    return _rounded(calculate_stock_price_change(joined), "stock_price_change")


@check(
    with_views(
        ["ticks", "companies", "dimension"],
        """SELECT timestamp, symbol, close, companyname, category
           FROM (SELECT DISTINCT timestamp, stockname AS symbol, close FROM ticks)
           LEFT JOIN dimension USING (symbol)""",
    )
)
def price_company_join(spark, folder):
    return join_companies(b.ticks(spark, folder), b.companies(spark, folder))


@check(
    with_views(
        ["companies", "dimension"],
        "SELECT symbol AS stockname, companyname, category FROM dimension",
    )
)
def company_rows_by_symbol(spark, folder):
    return company_dimension(b.companies(spark, folder))


# --- scalar expressions --------------------------------------------------------------


@check(
    r"""WITH parts AS (
      SELECT event_id, raw, which FROM (
        SELECT event_id, unnest([props, regexp_extract(props, '[0-9]+'), CAST(value AS VARCHAR),
                 event_type]) AS raw, unnest([1, 2, 3, 4]) AS which FROM events))
    SELECT event_id, which,
      CASE WHEN regexp_matches(raw, '^[0-9]+$') THEN CAST(raw AS BIGINT) ELSE 0 END AS whole,
      CASE WHEN regexp_matches(raw, '^-?[0-9.]+$') THEN CAST(raw AS DOUBLE) ELSE 0 END AS number
    FROM parts"""
)
def number_or_default(spark, folder):
    parts = b.table(spark, folder, "events").select(
        "event_id",
        F.posexplode(
            F.array(
                F.col("props"),
                F.regexp_extract("props", "[0-9]+", 0),
                F.col("value").cast("string"),
                F.col("event_type"),
            )
        ).alias("at", "raw"),
    )
    return parts.select(
        "event_id",
        (F.col("at") + 1).alias("which"),
        numbers.long_or_zero(F.col("raw")).alias("whole"),
        numbers.double_or_zero(F.col("raw")).alias("number"),
    )


@check(with_views(["raw_news", "news"], "SELECT doc_id, date, unix, time_period FROM news"))
def date_to_epoch_month(spark, folder):
    dated = add_time_period(b.raw_news(spark, folder))
    return dated.select("doc_id", "date", "unix", "time_period")


@check(
    r"""SELECT page_id,
      replace(replace(html, '"', ''), '\', '') AS unquoted,
      trim(replace(url, '/', ','), ',') AS no_commas,
      trim(',' || html || ',,', ',') AS no_edges FROM pages"""
)
def strip_clean_text(spark, folder):
    html = F.col("html")
    return b.table(spark, folder, "pages").select(
        "page_id",
        text.strip_quotes(html).alias("unquoted"),
        text.strip_commas(F.translate("url", "/", ",")).alias("no_commas"),
        text.strip_commas(F.concat(F.lit(","), html, F.lit(",,"))).alias("no_edges"),
    )


@check(
    with_views(
        ["companies"],
        f"SELECT stockname, companyname, CASE {b._CLEAN} ELSE companyname END AS cleaned FROM companies",
    )
)
def clean_company_names(spark, folder):
    return b.companies(spark, folder).select(
        "stockname", "companyname", text.clean_company_name(F.col("companyname")).alias("cleaned")
    )


_SQL_TOKENS = """list_concat(
  list_transform(string_split(coalesce(title, ''), ' '), lambda w: lower(regexp_replace(w, '[^A-Za-z0-9]', '', 'g'))),
  list_transform(string_split(coalesce(text, ''), ' '), lambda w: lower(regexp_replace(w, '[^A-Za-z0-9]', '', 'g'))),
  CASE WHEN short_description IS NULL THEN [] ELSE list_transform(string_split(short_description, ' '),
    lambda w: lower(regexp_replace(w, '[^A-Za-z0-9]', '', 'g'))) END)"""


@check(
    with_views(
        ["raw_news"],
        f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
            FROM (SELECT doc_id, {_SQL_TOKENS} AS t FROM raw_news)""",
    )
)
def tokenize_articles(spark, folder):
    tokens = text.tokenize(*[F.col(f) for f in m.FIELDS])
    return b.raw_news(spark, folder).select(
        "doc_id",
        F.size(tokens).alias("n_tokens"),
        F.array_join(tokens, " ").alias("tokens"),
    )


@check(
    with_views(
        ["raw_news", "scores"],
        """SELECT doc_id, title, text, short_description, date, round(score, 6) AS sentiment
           FROM raw_news JOIN scores USING (doc_id)""",
    )
)
def sentence_sentiment(spark, folder):
    keep = ["doc_id", "title", "text", "short_description", "date"]
    scored = add_sentiment(b.raw_news(spark, folder), b.LEXICON, keep=keep)
    return _rounded(scored, "sentiment")


# --- mentions ------------------------------------------------------------------------

_STOCK_VIEWS = _PRICE_VIEWS + ["needles", "raw_news", "news"]
_SECTOR_VIEWS = _PRICE_VIEWS + ["raw_news", "news", "keywords"]


def _named_companies(spark, folder) -> DataFrame:
    return company_dimension(b.companies(spark, folder)).withColumnRenamed("stockname", "symbol")


def _stock_months(spark, folder, articles: DataFrame) -> DataFrame:
    found = m.stock_mentions(articles, _named_companies(spark, folder))
    return stock_agreement(found, _prices(spark, folder))


def _sector_months(spark, folder, articles: DataFrame, price: str) -> DataFrame:
    found = m.sector_mentions(articles, b.sectors(spark, folder))
    return sector_agreement(found, _prices(spark, folder), price)


@check(
    with_views(
        _STOCK_VIEWS,
        """SELECT stock, time_period, number_of_articles, name, round(sentiment, 6) AS sentiment
           FROM months""",
        b.months_of_stocks("news", "months"),
    )
)
def stock_mentions(spark, folder):
    found = m.stock_mentions(b.news(spark, folder), _named_companies(spark, folder))
    return by_key_and_latest_month(_rounded(found, "sentiment"), "stock")


@check(
    with_views(
        ["raw_news", "news", "keywords"],
        "SELECT sector, time_period, number_of_articles, round(sentiment, 6) AS sentiment FROM found",
        b.sector_counts("news", "found"),
    )
)
def sector_mentions(spark, folder):
    found = m.sector_mentions(b.news(spark, folder), b.sectors(spark, folder))
    return by_key_and_latest_month(_rounded(found, "sentiment"), "sector")


@check(
    with_views(
        ["raw_news", "news", "keywords"],
        """SELECT sector, time_period, number_of_articles, round(sentiment, 6) AS sentiment
           FROM found""",
        b.sector_counts("news", "found"),
    )
)
def single_sector_union(spark, folder):
    articles, keywords = b.news(spark, folder), b.sectors(spark, folder)
    found = [m.search_for_sector(articles, keywords, sector) for sector in b.SECTORS]
    return _rounded(reduce(DataFrame.union, found), "sentiment")


_PAIRS_SQL = with_views(
    ["companies", "dimension", "needles", "raw_news"],
    """SELECT n.doc_id, c.symbol FROM raw_news n JOIN needles c
         ON contains(lower(coalesce(n.title, '')), c.needle)
         OR contains(lower(coalesce(n.text, '')), c.needle)
         OR contains(lower(coalesce(n.short_description, '')), c.needle)""",
)


def _pairs(spark, folder, plan: str) -> DataFrame:
    return contains_join(
        b.raw_news(spark, folder).select("doc_id", *m.FIELDS),
        m.company_needles(_named_companies(spark, folder)),
        m.FIELDS,
        "needle",
        plan=plan,
    ).select("doc_id", "symbol")


@check(_PAIRS_SQL)
def contains_join_by_gram(spark, folder):
    return _pairs(spark, folder, "grams")


@check(_PAIRS_SQL)
def contains_join_by_nested_loop(spark, folder):
    return _pairs(spark, folder, "nested_loop")


@check(_PAIRS_SQL)
def contains_join_by_shuffle(spark, folder):
    return _pairs(spark, folder, "shuffle")


# --- agreement -----------------------------------------------------------------------

_STOCK_OUT = """stock, time_period, number_of_articles, name, round(sentiment, 6) AS sentiment,
  round(stock_price_change, 6) AS stock_price_change, round(correlation, 6) AS correlation"""
_SECTOR_OUT = """sector, time_period, number_of_articles, round(sentiment, 6) AS sentiment,
  round(stock_price_change, 6) AS stock_price_change, round(correlation, 6) AS correlation"""
_MONTH_VALUES = ["sentiment", "stock_price_change", "correlation"]


@check(
    with_views(
        _STOCK_VIEWS, f"SELECT {_STOCK_OUT} FROM months", b.months_of_stocks("news", "months")
    )
)
def stock_month_agreement(spark, folder):
    months = _stock_months(spark, folder, b.news(spark, folder))
    return _rounded(months, *_MONTH_VALUES).select(
        "stock", "time_period", "number_of_articles", "name", *_MONTH_VALUES
    )


def _sector_sql(averaged: bool, body: str) -> str:
    return with_views(
        _SECTOR_VIEWS,
        body,
        b.sector_counts("news", "found"),
        b.months_of_sectors("found", "months", averaged),
    )


@check(_sector_sql(False, f"SELECT {_SECTOR_OUT} FROM months"))
def sector_agreement_per_symbol(spark, folder):
    months = _sector_months(spark, folder, b.news(spark, folder), "per_symbol")
    return _rounded(months, *_MONTH_VALUES)


@check(_sector_sql(True, f"SELECT {_SECTOR_OUT} FROM months"))
def sector_agreement_avg(spark, folder):
    months = _sector_months(spark, folder, b.news(spark, folder), "avg")
    return _rounded(months, *_MONTH_VALUES)


_STOCK_TOTALS = """SELECT stock, min(name) AS name,
  CAST(sum(number_of_articles) AS BIGINT) AS number_of_articles, {corr} AS corr
  FROM {months} GROUP BY stock"""
_SECTOR_TOTALS = """SELECT sector,
  CAST(sum(number_of_articles) AS BIGINT) AS number_of_articles, {corr} AS corr
  FROM {months} GROUP BY sector"""
_ROUNDED_CORR = "round(avg(correlation), 6)"


@check(
    with_views(
        _STOCK_VIEWS,
        _STOCK_TOTALS.format(corr=_ROUNDED_CORR, months="months"),
        b.months_of_stocks("news", "months"),
    )
)
def stock_totals(spark, folder):
    totals = stock_rollup(_stock_months(spark, folder, b.news(spark, folder)))
    return by_key(_rounded(totals, "corr"), "stock")


@check(_sector_sql(False, _SECTOR_TOTALS.format(corr=_ROUNDED_CORR, months="months")))
def sector_totals(spark, folder):
    months = _sector_months(spark, folder, b.news(spark, folder), "per_symbol")
    return by_key(_rounded(sector_rollup(months), "corr"), "sector")


@check(
    """SELECT event_id, d.doc_id, CASE WHEN s * p IS NULL THEN NULL WHEN s * p > 0 THEN 1.0 ELSE 0.0 END
         AS product_sign,
         CASE WHEN s > 0 AND p > 0 THEN 1.0 WHEN s < 0 AND p < 0 THEN -1.0 ELSE 0.0 END AS agreement
       FROM (SELECT event_id, value - 20 AS p FROM events) e
       LEFT JOIN (SELECT doc_id, CASE WHEN quality IS NOT NULL THEN quality - toxic - 0.5 END AS s
             FROM documents LEFT JOIN labels USING (doc_id)) d ON d.doc_id = e.event_id"""
)
def sign_functions(spark, folder):
    labels = b.table(spark, folder, "documents").select("doc_id").join(
        b.table(spark, folder, "labels"), "doc_id", "left"
    )
    s = F.col("quality") - F.col("toxic") - F.lit(0.5)
    p = F.col("value") - 20
    joined = b.table(spark, folder, "events").join(labels, F.col("doc_id") == F.col("event_id"), "left")
    return joined.select(
        "event_id", "doc_id", product_sign(s, p).alias("product_sign"),
        sign_agreement(s, p).alias("agreement"),
    )


# --- new rows and upserts ------------------------------------------------------------

_BATCH_VIEWS = ["raw_news", "news", "first_batch", "second_batch"]
_STOCK_BATCHES = [
    b.months_of_stocks("first_batch", "stored"),
    b.months_of_stocks("second_batch", "arriving"),
]
_SECTOR_BATCHES = [
    b.sector_counts("first_batch", "found_first"),
    b.sector_counts("second_batch", "found_second"),
    b.months_of_sectors("found_first", "stored", True),
    b.months_of_sectors("found_second", "arriving", True),
]


def _batches(spark, folder) -> tuple[DataFrame, DataFrame]:
    stored = b.first_batch(spark, folder)
    return stored, new_articles(b.full_delivery(spark, folder), stored)


def _merged(key: list[str], kept: list[str], weighted: str, replaced: list[str], stored: str, arriving: str) -> str:
    same = " AND ".join(f"s.{k} IS NOT DISTINCT FROM a.{k}" for k in key)
    columns = [f"coalesce(s.{k}, a.{k}) AS {k}" for k in key]
    columns += [f"CASE WHEN s.here THEN s.{c} ELSE a.{c} END AS {c}" for c in kept]
    columns += [f"CASE WHEN a.here THEN a.{c} ELSE s.{c} END AS {c}" for c in replaced]
    columns.append(
        "coalesce(s.number_of_articles, 0) + coalesce(a.number_of_articles, 0) AS number_of_articles"
    )
    columns.append(
        f"""CASE WHEN s.here AND a.here
            THEN (a.{weighted} * a.number_of_articles + s.{weighted} * s.number_of_articles)
                 / (s.number_of_articles + a.number_of_articles)
            WHEN s.here THEN s.{weighted} ELSE a.{weighted} END AS {weighted}"""
    )
    return f"""merged AS (SELECT {', '.join(columns)}
      FROM (SELECT *, true AS here FROM {stored}) s
      FULL JOIN (SELECT *, true AS here FROM {arriving}) a ON {same})"""


_MERGED_STOCKS = _merged(
    ["stock", "time_period"], ["name", "stock_price_change"], "correlation", ["sentiment"],
    "stored", "arriving",
)
_MERGED_SECTORS = _merged(
    ["sector", "time_period"], ["stock_price_change"], "correlation", ["sentiment"],
    "stored", "arriving",
)


@check(
    with_views(
        _BATCH_VIEWS,
        "SELECT title, text, short_description, date, sentiment, unix, time_period FROM second_batch",
    )
)
def articles_not_stored(spark, folder):
    return _batches(spark, folder)[1]


_STOCK_MERGE_SQL = with_views(
    _PRICE_VIEWS + ["needles"] + _BATCH_VIEWS,
    f"SELECT {_STOCK_OUT} FROM merged",
    *_STOCK_BATCHES,
    _MERGED_STOCKS,
)


@check(_STOCK_MERGE_SQL)
def upsert_stock_months(spark, folder):
    stored, arriving = [_stock_months(spark, folder, batch) for batch in _batches(spark, folder)]
    return _rounded(u.upsert_stock_agreement(stored, arriving), *_MONTH_VALUES)


_SECTOR_MERGE_SQL = with_views(
    _PRICE_VIEWS + ["keywords"] + _BATCH_VIEWS,
    f"SELECT {_SECTOR_OUT} FROM merged",
    *_SECTOR_BATCHES,
    _MERGED_SECTORS,
)


@check(_SECTOR_MERGE_SQL)
def upsert_sector_months(spark, folder):
    stored, arriving = [
        _sector_months(spark, folder, batch, "avg") for batch in _batches(spark, folder)
    ]
    return _rounded(u.upsert_sector_agreement(stored, arriving), *_MONTH_VALUES)


@check(
    with_views(
        _PRICE_VIEWS + ["needles"] + _BATCH_VIEWS,
        "SELECT stock, name, number_of_articles, round(corr, 6) AS corr FROM merged",
        *_STOCK_BATCHES,
        f"total_stored AS ({_STOCK_TOTALS.format(corr='avg(correlation)', months='stored')})",
        f"total_arriving AS ({_STOCK_TOTALS.format(corr='avg(correlation)', months='arriving')})",
        _merged(["stock"], ["name"], "corr", [], "total_stored", "total_arriving"),
    )
)
def upsert_stock_totals(spark, folder):
    stored, arriving = [
        stock_rollup(_stock_months(spark, folder, batch)) for batch in _batches(spark, folder)
    ]
    return _rounded(u.upsert_stock_rollup(stored, arriving), "corr")


@check(
    with_views(
        _PRICE_VIEWS + ["keywords"] + _BATCH_VIEWS,
        "SELECT sector, number_of_articles, round(corr, 6) AS corr FROM merged",
        *_SECTOR_BATCHES,
        f"total_stored AS ({_SECTOR_TOTALS.format(corr='avg(correlation)', months='stored')})",
        f"total_arriving AS ({_SECTOR_TOTALS.format(corr='avg(correlation)', months='arriving')})",
        _merged(["sector"], [], "corr", [], "total_stored", "total_arriving"),
    )
)
def upsert_sector_totals(spark, folder):
    stored, arriving = [
        sector_rollup(_sector_months(spark, folder, batch, "avg"))
        for batch in _batches(spark, folder)
    ]
    return _rounded(u.upsert_sector_rollup(stored, arriving), "corr")


_RETURNED = "(SELECT l_shipdate, l_suppkey, l_extendedprice, l_quantity FROM lineitem WHERE l_returnflag = 'R')"


@check(
    with_views(
        _PRICE_VIEWS,
        _PRICE_OUT.replace("FROM prices", "FROM stored UNION ALL ")
        + _PRICE_OUT
        + """ WHERE NOT EXISTS (SELECT 1 FROM stored s
               WHERE s.symbol = prices.symbol AND s.time_period = prices.time_period)""",
        b.VIEWS["ticks"].replace("ticks AS", "returned AS").replace("FROM lineitem", f"FROM {_RETURNED}"),
        b.VIEWS["prices"].replace("prices AS", "stored AS", 1).replace("FROM ticks", "FROM returned"),
    )
)
def insert_new_prices(spark, folder):
    companies = b.companies(spark, folder)
    returned = b.table(spark, folder, "lineitem").filter("l_returnflag = 'R'").select(
        F.unix_timestamp("l_shipdate").alias("timestamp"),
        F.col("l_suppkey").cast("string").alias("stockname"),
        F.col("l_extendedprice").alias("close"),
    )
    stored = monthly_price_change(returned, companies)
    full = stored.union(u.new_prices(stored, _prices(spark, folder)))
    return _rounded(full, "stock_price_change")


_NEWS_OUT = "title, text, short_description, date, sentiment, unix, time_period"


@check(
    with_views(
        _BATCH_VIEWS,
        f"""SELECT {_NEWS_OUT} FROM first_batch UNION ALL
            SELECT {_NEWS_OUT} FROM (
              SELECT *, row_number() OVER (PARTITION BY title, text, date ORDER BY
                short_description NULLS FIRST, sentiment NULLS FIRST, unix NULLS FIRST) AS nth
              FROM second_batch a WHERE NOT EXISTS (SELECT 1 FROM first_batch s
                WHERE s.title IS NOT DISTINCT FROM a.title AND s.text IS NOT DISTINCT FROM a.text
                  AND s.date IS NOT DISTINCT FROM a.date)) WHERE nth = 1""",
    )
)
def insert_new_articles(spark, folder):
    stored, arriving = _batches(spark, folder)
    return stored.union(u.unseen_articles(stored, arriving))


# --- arrays --------------------------------------------------------------------------


def _matched(spark, folder) -> DataFrame:
    names = b.companies(spark, folder).select(
        text.clean_company_name(F.col("companyname")).alias("companyname")
    )
    return m.add_stocks_sectors_sentiment(
        b.raw_news(spark, folder),
        names,
        b.sectors(spark, folder),
        (F.col("n_chars") % 3 - 1) * F.lit(0.5),
    )


_ARRAY_VIEWS = ["companies", "raw_news", "news", "keywords"]
_TOKENS_CTE = f"tokens AS (SELECT doc_id, {_SQL_TOKENS} AS t FROM raw_news)"
_STOCK_HITS = f"""stock_hits AS (SELECT DISTINCT doc_id, name FROM tokens, (
    SELECT DISTINCT CASE {b._CLEAN} ELSE companyname END AS name FROM companies) c
  WHERE name IS NOT NULL AND len(list_filter(t, lambda w: contains(w, lower(name)))) > 0)"""
_SECTOR_HITS = """sector_hits AS (SELECT DISTINCT doc_id, sector FROM tokens, keywords
  WHERE len(list_filter(string_split(lower(keyword), ' '),
    lambda p: len(list_filter(t, lambda w: contains(w, p))) = 0)) = 0)"""


@check(
    with_views(
        _ARRAY_VIEWS,
        """SELECT title, unix, time_period, sentiment, coalesce(s.joined, '') AS stocks,
             coalesce(k.joined, '') AS sectors
           FROM news LEFT JOIN (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS joined
                                FROM stock_hits GROUP BY doc_id) s USING (doc_id)
           LEFT JOIN (SELECT doc_id, string_agg(sector, ',' ORDER BY sector) AS joined
                      FROM sector_hits GROUP BY doc_id) k USING (doc_id)""",
        _TOKENS_CTE, _STOCK_HITS, _SECTOR_HITS,
    )
)
def array_matches(spark, folder):
    return _matched(spark, folder).select(
        "title", "unix", "time_period", "sentiment",
        F.array_join("stocks", ",").alias("stocks"),
        F.array_join("sectors", ",").alias("sectors"),
    )


def _array_counts(hits: str, column: str, out: str) -> str:
    return with_views(
        _ARRAY_VIEWS,
        f"""SELECT {column} AS {out}, time_period, count(*) AS number_of_articles,
              round(avg(sentiment), 6) AS sentiment
            FROM news JOIN {hits} USING (doc_id) GROUP BY ALL""",
        _TOKENS_CTE, _STOCK_HITS, _SECTOR_HITS,
    )


@check(_array_counts("stock_hits", "name", "stock"))
def exploded_stocks(spark, folder):
    return _rounded(m.explode_stocks_and_aggregate(_matched(spark, folder)), "sentiment")


@check(_array_counts("sector_hits", "sector", "sector"))
def exploded_sectors(spark, folder):
    return _rounded(m.explode_sectors_and_aggregate(_matched(spark, folder)), "sentiment")


_WORD_LENGTHS = """SELECT doc_id, list_transform(
  string_split(lower(regexp_replace(text, '[^A-Za-z0-9 ]', '', 'g')), ' '),
  lambda w: length(w)::DOUBLE) AS a FROM documents"""


def _lengths(documents: DataFrame) -> DataFrame:
    """Every document as a price series: the lengths of its words, 0 for an empty one."""
    lengths = F.transform(text.tokenize(F.col("text")), lambda w: F.length(w).cast("double"))
    return documents.withColumn("a", lengths).drop("text")


def _length_arrays(spark, folder) -> DataFrame:
    return _lengths(spread(b.table(spark, folder, "documents").select("doc_id", "text")))


@check(
    f"""WITH arrays AS ({_WORD_LENGTHS}),
    ends AS (SELECT doc_id, a, len(a) AS n,
        list_filter(range(1, len(a) + 1), lambda i: a[i] <> 0)[1] AS i,
        list_filter(range(2, len(a) + 1), lambda i: a[i] <> 0)[-1] AS j FROM arrays)
    SELECT doc_id,
      CASE WHEN n <= 1 THEN 0 ELSE coalesce(a[i], 0) END AS first_value,
      CASE WHEN n <= 1 THEN 0 ELSE coalesce(a[j], 0) END AS last_value,
      CASE WHEN n > 1 THEN coalesce(i, 1) * 60 END AS first_date,
      CASE WHEN n > 1 THEN coalesce(j, n) * 60 END AS last_date,
      round(CASE WHEN n <= 1 OR a[coalesce(i, 1)] = 0 AND a[coalesce(j, n)] = 0 THEN 0
        ELSE (a[coalesce(j, n)] - a[coalesce(i, 1)]) / a[coalesce(i, 1)] END, 6) AS change
    FROM ends"""
)
def array_price_change(spark, folder):
    arrays = _length_arrays(spark, folder)
    stamped = arrays.withColumn(
        "stamps", F.transform("a", lambda _, i: (i + 1).cast("bigint") * 60)
    )
    a, stamps = F.col("a"), F.col("stamps")
    return stamped.select(
        "doc_id",
        price_arrays.first_value(a).alias("first_value"),
        price_arrays.last_value(a).alias("last_value"),
        price_arrays.first_date(a, stamps).alias("first_date"),
        price_arrays.last_date(a, stamps).alias("last_date"),
        F.round(price_arrays.price_change(a), 6).alias("change"),
    )


# --- sources and sinks ---------------------------------------------------------------


def _ten_columns(spark, folder) -> DataFrame:
    return b.raw_news(spark, folder).select(
        "title",
        F.concat(F.lit("http://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        "date",
        F.array("lang", "source").alias("authors"),
        F.col("source").alias("publisher"),
        "short_description",
        "text",
        F.col("lang").alias("category"),
        F.col("doc_id").cast("string").alias("stock"),
        F.lit(None).cast("string").alias("country"),
    )


_TEN_SQL = with_views(
    ["raw_news"],
    """SELECT title, 'http://news.example/' || doc_id AS url, date,
         '["' || lang || '","' || source || '"]' AS authors, source AS publisher,
         short_description, text, lang AS category, CAST(doc_id AS VARCHAR) AS stock,
         CAST(NULL AS VARCHAR) AS country FROM raw_news""",
)


@check(_TEN_SQL)
def article_json_source(spark, folder):
    path = fresh_path(spark, "articles-json")
    _ten_columns(spark, folder).write.json(path)
    return read_articles_json(spark, path, multi_line=False)


@check(_TEN_SQL)
def article_array_source(spark, folder):
    """Files that hold one array of articles each."""
    path = fresh_path(spark, "articles-array")
    rows = F.to_json(F.collect_list(F.struct("*")), {"ignoreNullFields": "false"})
    hundred = F.floor(F.col("stock").cast("long") / 100)
    _ten_columns(spark, folder).groupBy(hundred).agg(rows.alias("value")).select("value").write.option(
        "maxRecordsPerFile", 1
    ).text(path)
    return read_articles_json(spark, path)


def _array_files(spark, objects: DataFrame) -> str:
    """Files of one JSON array each, of the objects in a column ``o``, by their column ``file``."""
    path = fresh_path(spark, "json-arrays")
    rows = F.concat(F.lit("[\n "), F.array_join(F.collect_list(F.to_json("o", {"ignoreNullFields": "false"})), ",\n "), F.lit("\n]"))
    arrays = objects.groupBy("file").agg(rows.alias("value")).select("value")
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    return path


@check(_TEN_SQL)
def article_split_array_source(spark, folder):
    """Files of one array each, which several tasks may share."""
    rows = _ten_columns(spark, folder)
    path = _array_files(spark, rows.select(F.floor(F.col("stock").cast("long") / 500).alias("file"), F.struct("*").alias("o")))
    return read_articles_array(spark, path)


@check("SELECT doc_id % 10 = 0 AS corrupt, count(*) AS n FROM documents GROUP BY ALL")
def corrupt_records_counted(spark, folder):
    """Every tenth line is cut off; good rows and corrupt ones are both counted."""
    path = fresh_path(spark, "articles-cut")
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("title"), "text"))
    cut = F.when(F.col("doc_id") % 10 == 0, F.substring(line, 1, 12)).otherwise(line)
    spread(b.table(spark, folder, "documents")).select(cut.alias("value")).write.text(path)
    good = read_articles_json(spark, path, multi_line=False).select(F.lit(False).alias("corrupt"))
    bad = corrupt_records(spark, path, RAW_ARTICLES, multi_line=False).select(F.lit(True).alias("corrupt"))
    return good.union(bad).groupBy("corrupt").agg(F.count(F.lit(1)).alias("n"))


@check(_TEN_SQL)
def article_csv_roundtrip(spark, folder):
    path = fresh_path(spark, "articles-csv")
    flat = _ten_columns(spark, folder).withColumn("authors", F.to_json("authors"))
    sinks.write_articles_csv(flat, path)
    return read_articles_csv(spark, path).select(*ARTICLE_COLUMNS)


_QUOTES_SQL = f"""WITH arrays AS ({_WORD_LENGTHS}),
  quotes AS (SELECT 'D' || doc_id AS stockname, a[i] AS v, i, len(a) AS n
             FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM arrays))
  SELECT stockname, count(*) AS n_ticks, min(i) * 3600 AS first_ts, max(i) * 3600 AS last_ts,
         CAST(sum(v) AS DOUBLE) AS sum_open, CAST(sum(v) * 2 AS DOUBLE) AS sum_close,
         CAST(sum(CASE WHEN i < n THEN v * 1000 ELSE 0 END) AS BIGINT) AS sum_volume,
         max(v) + 1 AS high, min(v) AS low
  FROM quotes GROUP BY stockname"""


def _price_documents(arrays: DataFrame) -> DataFrame:
    """Price documents of word lengths ``a``, in place of ``doc_id`` and ``a``."""
    a = F.col("a")
    quote = F.struct(
        a.alias("open"),
        # JSON null inside the array where there is no price.
        F.transform(a, lambda x: F.when(x != 0, x * 2)).alias("close"),
        # One value short of the time stamps.
        F.slice(
            F.transform(a, lambda x: (x * 1000).cast("bigint")), F.lit(1), F.size(a) - 1
        ).alias("volume"),
        F.transform(a, lambda x: x + 1).alias("high"),
        a.alias("low"),
    )
    result = F.struct(
        F.struct(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("symbol")).alias("meta"),
        F.transform(a, lambda _, i: (i + 1).cast("bigint") * 3600).alias("timestamp"),
        F.struct(F.array(quote).alias("quote")).alias("indicators"),
    )
    chart = F.struct(F.array(result).alias("result")).alias("chart")
    return arrays.select(chart, *[c for c in arrays.columns if c not in ("doc_id", "a")])


def _quote_summary(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("stockname").agg(
        F.count(F.lit(1)).alias("n_ticks"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.sum("open").alias("sum_open"),
        F.sum("close").alias("sum_close"),
        F.sum("volume").alias("sum_volume"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
    )


@check(_QUOTES_SQL)
def price_json_source(spark, folder):
    path = fresh_path(spark, "prices-json")
    _price_documents(_length_arrays(spark, folder)).write.json(path)
    return _quote_summary(read_prices_json(spark, path, multi_line=False))


@check(_QUOTES_SQL)
def price_split_array_source(spark, folder):
    # Texts are dealt out to their files before the series, four times as large, are made of them.
    texts = b.table(spark, folder, "documents").select("doc_id", "text", F.floor(F.col("doc_id") / 500).alias("file"))
    documents = _price_documents(_lengths(texts.repartition("file")))
    path = _array_files(spark, documents.select("file", F.struct("chart").alias("o")))
    return _quote_summary(read_prices_array(spark, path))


@check(_QUOTES_SQL)
def price_csv_roundtrip(spark, folder):
    source, target = fresh_path(spark, "prices-json"), fresh_path(spark, "prices-csv")
    # Digits: compressed, both take a third of the disk or less.
    _price_documents(_length_arrays(spark, folder)).write.json(source, compression="lz4")
    ticks = read_prices_json(spark, source, multi_line=False)
    sinks.write_prices_csv(ticks, target, compression="lz4")
    return _quote_summary(read_prices_csv(spark, target).select(*RAW_TICKS.names))


@check(with_views(["companies"], "SELECT stockname, companyname, category FROM companies"))
def company_csv_scan(spark, folder):
    path = fresh_path(spark, "companies-csv")
    sinks.export_csv(b.companies(spark, folder), path)
    return read_companies_csv(spark, path)


@check(with_views(["keywords"], "SELECT sector, keyword FROM keywords"))
def sector_keyword_scan(spark, folder):
    path = fresh_path(spark, "sectors-csv")
    sinks.export_csv(b.sectors(spark, folder), path)
    return m.sector_keywords(read_sectors_csv(spark, path))


_NEWS_SQL = with_views(["raw_news", "news"], f"SELECT {_NEWS_OUT} FROM news")


@check(_NEWS_SQL)
def scored_article_parquet(spark, folder):
    path = fresh_path(spark, "news")
    sinks.write_scored_articles(b.full_delivery(spark, folder), path)
    return read_scored_articles(spark, path)


@check(with_views(_PRICE_VIEWS, _PRICE_OUT))
def stored_price_table(spark, folder):
    prices = _prices(spark, folder)
    table = StoredTable(spark, fresh_path(spark, "stock"), prices.schema, append_only=True)
    current, _ = table.open_or_create(prices)
    return _rounded(current, "stock_price_change")


# --- jobs ----------------------------------------------------------------------------


def _two_batches(spark, folder) -> ResultTables:
    tables = ResultTables(spark, fresh_path(spark, "results"))
    sectors, companies = b.sectors(spark, folder), b.companies(spark, folder)
    analyse(tables, sectors, companies, b.first_batch(spark, folder), b.ticks(spark, folder))
    analyse(tables, sectors, companies, b.full_delivery(spark, folder))
    return tables


# The job takes company names from the stored price table, so a company without a
# month of prices is not searched for.
_JOB_VIEWS = {
    **b.VIEWS,
    "needles": b.VIEWS["needles"].replace("FROM dimension WHERE", "FROM prices WHERE"),
}


@check(
    "WITH "
    + ",\n".join(
        [_JOB_VIEWS[v] for v in _PRICE_VIEWS + ["needles"] + _BATCH_VIEWS]
        + _STOCK_BATCHES
        + [_MERGED_STOCKS]
    )
    + f"\nSELECT {_STOCK_OUT} FROM merged"
)
def two_batch_stock_months(spark, folder):
    tables = _two_batches(spark, folder)
    return _rounded(tables.current()["stock_corr"], *_MONTH_VALUES)


class _Lost(ResultTables):
    """Tables of a run that is lost after everything but the last step."""

    def complete(self, *_):
        raise RuntimeError("lost")


@check(
    "WITH "
    + ",\n".join(
        [_JOB_VIEWS[v] for v in _PRICE_VIEWS + ["needles"] + _BATCH_VIEWS]
        + _STOCK_BATCHES
        + [_MERGED_STOCKS]
    )
    + f"\nSELECT {_STOCK_OUT} FROM merged"
)
def restarted_stock_months(spark, folder):
    root = fresh_path(spark, "results")
    tables = ResultTables(spark, root)
    sectors, companies, ticks = b.sectors(spark, folder), b.companies(spark, folder), b.ticks(spark, folder)
    analyse(tables, sectors, companies, b.first_batch(spark, folder), ticks)
    try:
        analyse(_Lost(spark, root), sectors, companies, b.full_delivery(spark, folder))
    except RuntimeError:
        pass
    analyse(tables, sectors, companies, ticks=ticks)
    analyse(tables, sectors, companies, b.full_delivery(spark, folder))
    return _rounded(tables.current()["stock_corr"], *_MONTH_VALUES)


_DOUBLED = f"""doubled AS (
  SELECT {', '.join(b.NEWS_COLUMNS)} FROM news UNION
  SELECT {', '.join("coalesce(short_description, '') || ' again'" if c == "short_description" else c
                    for c in b.NEWS_COLUMNS)} FROM news)"""


@check(
    "WITH "
    + ",\n".join(
        [_JOB_VIEWS[v] for v in _PRICE_VIEWS + ["needles", "raw_news", "news"]]
        + [_DOUBLED, b.months_of_stocks("doubled", "months")]
    )
    + f"\nSELECT {_STOCK_OUT} FROM months"
)
def redelivered_stock_months(spark, folder):
    tables = ResultTables(spark, fresh_path(spark, "results"))
    sectors, companies = b.sectors(spark, folder), b.companies(spark, folder)
    news = b.full_delivery(spark, folder)
    again = F.concat(F.coalesce("short_description", F.lit("")), F.lit(" again"))
    delivery = news.union(news.withColumn("short_description", again))
    analyse(tables, sectors, companies, delivery, b.ticks(spark, folder))
    for _ in range(2):
        analyse(tables, sectors, companies, delivery)
    return _rounded(tables.current()["stock_corr"], *_MONTH_VALUES)


@check(_SECTOR_MERGE_SQL)
def two_batch_sector_export(spark, folder):
    tables = _two_batches(spark, folder)
    target = fresh_path(spark, "export")
    export_tables(tables, target, show=False)
    exported = spark.read.schema(tables.sector_corr.schema).csv(
        f"{target}/sector_correlation", header=True
    )
    return _rounded(exported, *_MONTH_VALUES)


def _export_part(table: str, source: str, **columns: str) -> str:
    """SELECT of one table in the shape all six have here; columns not given are NULL."""
    shape = {
        "key": "VARCHAR", "time_period": "VARCHAR", "label": "VARCHAR", "extra": "VARCHAR", "n": "BIGINT",
        "first": "DOUBLE", "second": "DOUBLE", "third": "DOUBLE",
    }
    value = {
        c: f"round({columns[c]}, 6)" if kind == "DOUBLE" and c in columns else columns.get(c, "NULL")
        for c, kind in shape.items()
    }
    parts = ", ".join(f"CAST({value[c]} AS {kind.replace('VARCHAR', 'STRING')}) AS {c}" for c, kind in shape.items())
    return f"SELECT '{table}' AS table_name, {parts} FROM {source}"


def _export_parts(sources: dict[str, str]) -> str:
    months = {"n": "number_of_articles", "first": "sentiment", "second": "stock_price_change", "third": "correlation"}
    totals = {"n": "number_of_articles", "first": "corr"}
    shapes = {
        "stock_corr": {"key": "stock", "time_period": "time_period", "label": "name", **months},
        "sector_corr": {"key": "sector", "time_period": "time_period", **months},
        "stock_grouped": {"key": "stock", "label": "name", **totals},
        "sector_grouped": {"key": "sector", **totals},
        "stock": {
            "key": "symbol", "time_period": "time_period", "label": "companyname", "extra": "category",
            "n": "first_date + last_date", "first": "first_value", "second": "last_value", "third": "stock_price_change",
        },
        "news": {
            "key": "title", "time_period": "time_period", "label": "date",
            "extra": "md5(concat(coalesce(text, '-'), '|', coalesce(short_description, '-')))",
            "n": "unix", "first": "sentiment",
        },
    }
    return " UNION ALL ".join(_export_part(name, sources[name], **columns) for name, columns in shapes.items())


def _first_of_key(source: str) -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title, text, date ORDER BY
        short_description NULLS FIRST, sentiment NULLS FIRST, unix NULLS FIRST) AS nth FROM {source}) WHERE nth = 1)"""


_EXPORT_SQL = (
    "WITH "
    + ",\n".join(
        [_JOB_VIEWS[v] for v in _PRICE_VIEWS + ["needles", "keywords"] + _BATCH_VIEWS]
        + [
            b.months_of_stocks("first_batch", "stocks_1"),
            b.months_of_stocks("second_batch", "stocks_2"),
            b.sector_counts("first_batch", "found_1"),
            b.sector_counts("second_batch", "found_2"),
            b.months_of_sectors("found_1", "sectors_1", True),
            b.months_of_sectors("found_2", "sectors_2", True),
        ]
        + [
            f"{kind}_totals_{i} AS ({form.format(corr='avg(correlation)', months=f'{kind}s_{i}')})"
            for kind, form in (("stock", _STOCK_TOTALS), ("sector", _SECTOR_TOTALS))
            for i in (1, 2)
        ]
        + [
            _merged(key, kept, weighted, replaced, f"{name}_1", f"{name}_2").replace("merged AS", f"{out} AS", 1)
            for out, name, key, kept, weighted, replaced in (
                ("stock_corr", "stocks", ["stock", "time_period"], ["name", "stock_price_change"], "correlation", ["sentiment"]),
                ("sector_corr", "sectors", ["sector", "time_period"], ["stock_price_change"], "correlation", ["sentiment"]),
                ("stock_grouped", "stock_totals", ["stock"], ["name"], "corr", []),
                ("sector_grouped", "sector_totals", ["sector"], [], "corr", []),
            )
        ]
        + [
            f"""stored_news AS (SELECT * FROM {_first_of_key('first_batch')} UNION ALL
              SELECT * FROM {_first_of_key("""(SELECT * FROM second_batch a WHERE NOT EXISTS (SELECT 1 FROM first_batch s
                WHERE s.title IS NOT DISTINCT FROM a.title AND s.text IS NOT DISTINCT FROM a.text
                  AND s.date IS NOT DISTINCT FROM a.date))""")})"""
        ]
    )
    + "\n"
    + _export_parts(
        {
            "stock_corr": "stock_corr", "sector_corr": "sector_corr", "stock_grouped": "stock_grouped",
            "sector_grouped": "sector_grouped", "stock": "prices", "news": "stored_news",
        }
    )
)


@check(_EXPORT_SQL)
def two_batch_exports(spark, folder):
    """All six exports, read back from their files."""
    tables = _two_batches(spark, folder)
    target = fresh_path(spark, "export")
    export_tables(tables, target, show=False)
    sources = {}
    for name, exported in FOLDERS.items():
        read = spark.read.schema(getattr(tables, name).schema).csv(f"{target}/{exported}", header=True, multiLine=True)
        sources[name] = f"export_{name}"
        read.createOrReplaceTempView(sources[name])
    return spark.sql(_export_parts(sources))


@check(
    with_views(
        _PRICE_VIEWS + ["raw_news", "news", "keywords"],
        f"SELECT {_SECTOR_OUT} FROM months",
        b.sector_counts("news", "found"),
        b.months_of_sectors("found", "months", True),
    )
)
def streamed_sector_months(spark, folder):
    arrivals = fresh_path(spark, "arrivals")
    sinks.write_scored_articles(b.full_delivery(spark, folder), arrivals)
    tables = ResultTables(spark, fresh_path(spark, "results"))
    analyse_arrivals(
        spark,
        arrivals,
        fresh_path(spark, "stream"),
        tables,
        b.sectors(spark, folder),
        b.companies(spark, folder),
        b.ticks(spark, folder),
        files_per_batch=100_000,
    )
    return _rounded(tables.current()["sector_corr"], *_MONTH_VALUES)
