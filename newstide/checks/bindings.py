"""The given tables seen as articles, ticks, companies and sector keywords.

Each view is stated twice, for Spark and as a common table expression for the SQL
check. All rows and whole texts are searched; names of companies and sector keywords are made
of the first words of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newstide.functions.dates import add_time_period
from newstide.functions.sentiment import Lexicon
from newstide.session import prepare
from newstide.functions.text import LEGAL_FORMS
from newstide.workspace import spread

# The sector names of the keyword table.
SECTORS = [
    "Information Technology", "Health Care", "Financials", "Consumer Discretionary",
    "Communication Services", "Industrials", "Consumer Staples", "Energy",
    "Utilities", "Real Estate", "Materials",
]
FORMS = ["Inc.", "Incorporated", "Corp.", "Corporation", "Ltd.", "Limited", ""]

# Words that are frequent in the given documents.
LEXICON = Lexicon(
    positive=("that", "with", "is", "thing", "und", "que", "la"),
    negative=("was", "but", "are", "from", "der", "les", "en"),
)

FIRST_BATCH_CHARS = 1500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# --- ticks: a supplier is a stock, a shipped line item is a trade ------------------


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "lineitem")).select(
        F.unix_timestamp("l_shipdate").alias("timestamp"),
        F.col("l_suppkey").cast("string").alias("stockname"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
    )


# --- companies: named after the first words of a document --------------------------


def companies(spark: SparkSession, folder: str) -> DataFrame:
    words = table(spark, folder, "documents").select(
        "doc_id",
        F.regexp_extract("text", "([A-Za-z]+)", 1).alias("w1"),
        F.regexp_extract("text", "[A-Za-z]+[^A-Za-z]+([A-Za-z]+)", 1).alias("w2"),
    )
    supplier = table(spark, folder, "supplier")
    form = _pick(FORMS, F.col("s_nationkey") % 7)
    words_used = F.when(F.col("s_nationkey") % 3 == 0, F.concat_ws(" ", "w1", "w2")).otherwise(
        F.col("w1")
    )
    listed = F.col("s_acctbal") >= 0
    named = supplier.join(words, F.col("doc_id") == F.col("s_suppkey"), "left").select(
        F.col("s_suppkey").cast("string").alias("stockname"),
        F.when(listed, F.trim(F.concat(words_used, F.lit(" "), form))).alias("companyname"),
        F.when(listed, _pick(SECTORS, F.col("s_nationkey") % 11)).alias("category"),
    )
    # Every company a second time under a longer name, as a doubled dimension row.
    return named.union(
        named.select(
            "stockname", F.concat("companyname", F.lit(" Holdings")).alias("companyname"), "category"
        )
    )


# --- news: a document is an article -------------------------------------------------


def _date() -> Column:
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("doc_id") % 2400).cast("int"))
    plain = F.date_format(day, "yyyy-MM-dd")
    unpadded = F.concat_ws("-", F.year(day), F.month(day), F.dayofmonth(day))
    kind = F.col("doc_id") % 4
    return (
        F.when(kind == 0, F.concat(plain, F.lit("T10:11:12Z")))
        .when(kind == 1, F.concat(plain, F.lit(" 23:59:59")))
        .when(kind == 2, plain)
        .when(F.col("lang") == "de", F.lit("undated"))
        .otherwise(unpadded)
    )


def raw_news(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents")).select(
        "doc_id",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        "text",
        F.when(F.col("lang") == "en", F.split_part("text", F.lit("\n"), F.lit(-1))).alias(
            "short_description"
        ),
        _date().alias("date"),
        "n_chars",
        "source",
        "lang",
    )


NEWS_COLUMNS = [
    "title", "text", "short_description", "date", "sentiment", "unix", "time_period",
]


def news(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with a stand-in score, so that the searches are timed without the scorer."""
    dated = add_time_period(raw_news(spark, folder))
    return dated.withColumn("sentiment", (F.col("n_chars") % 3 - 1) * F.lit(0.5))


def first_batch(spark: SparkSession, folder: str) -> DataFrame:
    chosen = news(spark, folder).filter(F.col("n_chars") <= FIRST_BATCH_CHARS)
    return chosen.select(*NEWS_COLUMNS).distinct()


def full_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """The second delivery: every article, those of the first batch again included."""
    return news(spark, folder).select(*NEWS_COLUMNS)


# --- sector keywords: the first words of the benchmark items ------------------------


def sectors(spark: SparkSession, folder: str) -> DataFrame:
    w1 = F.regexp_extract("text", "([A-Za-z]+)", 1)
    w2 = F.regexp_extract("text", "[A-Za-z]+[^A-Za-z]+([A-Za-z]+)", 1)
    return (
        table(spark, folder, "benchmark")
        .select(
            F.floor(F.col("item_id") / len(SECTORS)).alias("line"),
            _pick(SECTORS, F.col("item_id") % len(SECTORS)).alias("sector"),
            F.when(F.col("item_id") % 3 == 2, F.concat_ws(" ", w1, w2)).otherwise(w1).alias(
                "keyword"
            ),
        )
        .groupBy("line")
        .pivot("sector", SECTORS)
        .agg(F.min("keyword"))
        .drop("line")
    )


# --- the same as SQL ----------------------------------------------------------------

_CLEAN = "\n".join(
    f"WHEN contains(lower(companyname), '{mark}')"
    f" THEN trim(regexp_replace(companyname, '{pattern}', '', 'g'))"
    for mark, pattern in LEGAL_FORMS
)

PARSED_DATE = """epoch(COALESCE(
    try_strptime(substr(date, 1, 19), '%Y-%m-%dT%H:%M:%S'),
    try_strptime(substr(date, 1, 19), '%Y-%m-%d %H:%M:%S'),
    try_strptime(substr(date, 1, 10), '%Y-%m-%d')))::BIGINT"""


def month_sql(epoch: str) -> str:
    return f"strftime(make_timestamp(({epoch}) * 1000000), '%Y-%m')"


def words_in(text: str, words: tuple[str, ...]) -> str:
    return f"len(list_filter(string_split({text}, ' '), lambda x: x IN ({_sql_list(words)})))"


def months_of_stocks(batch: str, out: str) -> str:
    return f"""{out} AS (
      SELECT m.stock, m.time_period, m.number_of_articles, m.name, m.sentiment,
             p.stock_price_change,
             CASE WHEN m.sentiment > 0 AND p.stock_price_change > 0 THEN 1.0::DOUBLE
                  WHEN m.sentiment < 0 AND p.stock_price_change < 0 THEN -1.0::DOUBLE
                  ELSE 0.0::DOUBLE END AS correlation
      FROM (SELECT c.symbol AS stock, n.time_period, count(*) AS number_of_articles,
                   min(c.companyname) AS name, avg(n.sentiment) AS sentiment
            FROM {batch} n JOIN needles c
              ON contains(lower(coalesce(n.title, '')), c.needle)
              OR contains(lower(coalesce(n.text, '')), c.needle)
              OR contains(lower(coalesce(n.short_description, '')), c.needle)
            GROUP BY ALL) m
      LEFT JOIN prices p ON p.symbol = m.stock AND p.time_period = m.time_period)"""


def sector_counts(batch: str, out: str) -> str:
    return f"""{out} AS (
      SELECT sector, time_period, count(*) AS number_of_articles, avg(sentiment) AS sentiment
      FROM (SELECT k.sector, n.time_period, n.sentiment,
                   row_number() OVER (
                     PARTITION BY k.sector, n.title, n.text, n.short_description
                     ORDER BY n.time_period NULLS FIRST, n.date NULLS FIRST,
                              n.sentiment NULLS FIRST) AS nth
            FROM {batch} n JOIN keywords k
              ON contains(lower(coalesce(n.title, '')), lower(k.keyword))
              OR contains(lower(coalesce(n.text, '')), lower(k.keyword))
              OR contains(lower(coalesce(n.short_description, '')), lower(k.keyword)))
      WHERE nth = 1 GROUP BY ALL)"""


def months_of_sectors(counts: str, out: str, averaged: bool) -> str:
    change = (
        """(SELECT time_period, category, avg(stock_price_change) AS stock_price_change
            FROM prices GROUP BY ALL)"""
        if averaged
        else "prices"
    )
    return f"""{out} AS (
      SELECT m.sector, m.time_period, m.number_of_articles, m.sentiment, p.stock_price_change,
             CASE WHEN m.sentiment > 0 AND p.stock_price_change > 0 THEN 1.0::DOUBLE
                  WHEN m.sentiment < 0 AND p.stock_price_change < 0 THEN -1.0::DOUBLE
                  ELSE 0.0::DOUBLE END AS correlation
      FROM {counts} m LEFT JOIN {change} p
        ON p.category = m.sector AND p.time_period = m.time_period)"""


VIEWS = {
    "ticks": """ticks AS (
      SELECT epoch(l_shipdate)::BIGINT AS timestamp, CAST(l_suppkey AS VARCHAR) AS stockname,
             l_extendedprice AS close, CAST(l_quantity AS BIGINT) AS volume FROM lineitem)""",
    "companies": f"""companies AS (
      WITH named AS (
        SELECT CAST(s_suppkey AS VARCHAR) AS stockname,
          CASE WHEN s_acctbal >= 0 THEN trim(
            CASE WHEN s_nationkey % 3 = 0 THEN w1 || ' ' || w2 ELSE w1 END || ' ' ||
            list_extract([{_sql_list(FORMS)}], s_nationkey % 7 + 1)) END AS companyname,
          CASE WHEN s_acctbal >= 0
            THEN list_extract([{_sql_list(SECTORS)}], s_nationkey % 11 + 1) END AS category
        FROM supplier LEFT JOIN (
          SELECT doc_id, regexp_extract(text, '([A-Za-z]+)', 1) AS w1,
                 regexp_extract(text, '[A-Za-z]+[^A-Za-z]+([A-Za-z]+)', 1) AS w2
          FROM documents) ON doc_id = s_suppkey)
      SELECT * FROM named UNION ALL
      SELECT stockname, companyname || ' Holdings', category FROM named)""",
    "dimension": """dimension AS (
      SELECT stockname AS symbol, companyname, category FROM (
        SELECT *, row_number() OVER (PARTITION BY stockname
          ORDER BY companyname NULLS FIRST, category NULLS FIRST) AS nth FROM companies)
      WHERE nth = 1)""",
    "prices": f"""prices AS (
      WITH months AS (
        SELECT {month_sql('timestamp')} AS time_period, stockname AS symbol,
               min(struct_pack(ts := timestamp, px := close)) AS lo,
               max(struct_pack(ts := timestamp, px := close)) AS hi
        FROM (SELECT DISTINCT timestamp, stockname, close FROM ticks WHERE close > 0)
        GROUP BY 1, 2 HAVING count(*) > 1)
      SELECT time_period, symbol, category, lo.ts AS first_date, lo.px AS first_value,
             hi.ts AS last_date, hi.px AS last_value, companyname,
             (hi.px - lo.px) / lo.px AS stock_price_change
      FROM months LEFT JOIN dimension USING (symbol))""",
    "needles": f"""needles AS (
      SELECT * FROM (
        SELECT DISTINCT symbol, companyname,
               lower(CASE {_CLEAN} ELSE companyname END) AS needle
        FROM dimension WHERE companyname <> 'null')
      WHERE needle <> '')""",
    "raw_news": """raw_news AS (
      SELECT doc_id, split_part(text, chr(10), 1) AS title, text,
        CASE WHEN lang = 'en' THEN split_part(text, chr(10), -1) END AS short_description,
        CASE WHEN doc_id % 4 = 0 THEN strftime(d, '%Y-%m-%d') || 'T10:11:12Z'
             WHEN doc_id % 4 = 1 THEN strftime(d, '%Y-%m-%d') || ' 23:59:59'
             WHEN doc_id % 4 = 2 THEN strftime(d, '%Y-%m-%d')
             WHEN lang = 'de' THEN 'undated'
             ELSE year(d) || '-' || month(d) || '-' || day(d) END AS date,
        n_chars, source, lang
      FROM (SELECT *, DATE '1995-01-01' + CAST(doc_id % 2400 AS INTEGER) AS d FROM documents))""",
    "news": f"""news AS (
      SELECT *, {month_sql('unix')} AS time_period FROM (
        SELECT *, {PARSED_DATE} AS unix, (n_chars % 3 - 1) * 0.5::DOUBLE AS sentiment
        FROM raw_news))""",
    "first_batch": f"""first_batch AS (
      SELECT DISTINCT {', '.join(NEWS_COLUMNS)} FROM news WHERE n_chars <= {FIRST_BATCH_CHARS})""",
    "second_batch": f"""second_batch AS (
      SELECT {', '.join(NEWS_COLUMNS)} FROM news EXCEPT SELECT * FROM first_batch)""",
    "keywords": f"""keywords AS (
      SELECT DISTINCT list_extract([{_sql_list(SECTORS)}], CAST(item_id % 11 + 1 AS INTEGER)) AS sector,
             CASE WHEN item_id % 3 = 2
               THEN regexp_extract(text, '([A-Za-z]+)', 1) || ' ' ||
                    regexp_extract(text, '[A-Za-z]+[^A-Za-z]+([A-Za-z]+)', 1)
               ELSE regexp_extract(text, '([A-Za-z]+)', 1) END AS keyword
      FROM benchmark)""",
    "scores": f"""scores AS (
      WITH sentences AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(regexp_replace(
                 concat_ws('. ', title, text, short_description),
                 '[^A-Za-z0-9 .!?\\n]', '', 'g')), '[.!?\\n]+'), lambda s: trim(s) <> '') AS ss
        FROM raw_news),
      hits AS (
        SELECT doc_id, pos, {words_in('s', LEXICON.positive)} AS p,
               {words_in('s', LEXICON.negative)} AS n
        FROM (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM sentences)),
      ranked AS (
        SELECT doc_id, sign(p - n) AS label,
               CASE WHEN p + n > 0 THEN abs(p - n) / (p + n)::DOUBLE ELSE 0 END AS confidence,
               row_number() OVER (PARTITION BY doc_id ORDER BY
                 CASE WHEN p + n > 0 THEN abs(p - n) / (p + n)::DOUBLE ELSE 0 END DESC, pos) AS nth
        FROM hits)
      SELECT doc_id, label * confidence AS score FROM ranked WHERE nth = 1)""",
}


def with_views(views: list[str], body: str, *extra: str) -> str:
    """SQL text: the named views in the given order, further expressions, the query."""
    return "WITH " + ",\n".join([VIEWS[v] for v in views] + list(extra)) + "\n" + body
