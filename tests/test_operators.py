import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newstide.operators import agreement, upsert
from newstide.operators.contains import ContainsLimits, contains_join
from newstide.operators.keys import FilterLimits, digests, new_articles, one_per_key, possibly_among, rows_not_among
from newstide.operators.mentions import (
    add_stocks_sectors_sentiment,
    explode_sectors_and_aggregate,
    explode_stocks_and_aggregate,
    search_for_sector,
    sector_mentions,
    stock_mentions,
)
from newstide.operators.prices import calculate_stock_price_change, join_companies, monthly_price_change
from newstide.operators.scoring import add_sentiment
from newstide.operators.substrings import CodeFilter, Lookup, bitmap_sizes, gram_code, may_hold, probes, with_anchors, with_bitmap

NEWS = "title string, text string, short_description string, date string, sentiment double, unix bigint, time_period string"


def article(title, text, short=None, date="2020-01-01", sentiment=0.5, month="2020-01"):
    return (title, text, short, date, sentiment, 0, month)


# --- containment ----------------------------------------------------------------


def random_words(seed, n, longest, letters="abAé "):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("plan", ["nested_loop", "grams", "shuffle"])
@pytest.mark.parametrize(
    "limits",
    [
        ContainsLimits(),
        ContainsLimits(gram=3, nested_loop_entries=2),
        ContainsLimits(gram=5, classes=((6, 3, 3), (1, 1, 1)), grams_per_text=2),
    ],
)
def test_contains_join_equals_brute_force(spark, rows, plan, limits):
    texts = random_words(1, 60, 40)
    articles = [(i, t if i % 7 else None, texts[-1 - i][:9]) for i, t in enumerate(texts)]
    needles = [(i, w) for i, w in enumerate(random_words(2, 60, 7) + ["", None])]
    joined = contains_join(
        spark.createDataFrame(articles, "id int, a string, b string"),
        spark.createDataFrame(needles, "word int, needle string"),
        ["a", "b"], "needle", limits, plan,
    )
    assert joined.columns == ["id", "a", "b", "word", "needle"]
    expected = sorted(
        (i, w)
        for (i, *fields), (w, needle) in itertools.product(articles, needles)
        if needle and any(needle.lower() in f.lower() for f in fields if f is not None)
    )
    assert rows(joined, "id", "word") == expected
    assert expected


def test_no_match_across_fields(spark, rows):
    articles = spark.createDataFrame([(1, "north", "star rises")], "id int, a string, b string")
    words = spark.createDataFrame([("northstar",), ("north s",), ("NORTH",), ("star ri",)], "needle string")
    for plan in ("nested_loop", "grams", "shuffle"):
        found = contains_join(articles, words, ["a", "b"], "needle", plan=plan)
        assert rows(found, "needle") == [("NORTH",), ("star ri",)]


def test_one_text_in_most_rows(spark, rows):
    """A third of all rows alike and a needle in nearly all of them: nothing is lost."""
    articles = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "same words for all").otherwise(F.concat(F.lit("words "), "id")).alias("t")
    )
    words = spark.createDataFrame([("words",), ("same words",), ("ds 17",)], "needle string")
    found = contains_join(articles, words, ["t"], "needle", plan="grams").groupBy("needle").count()
    expected = [str(i).startswith("17") and i % 3 != 0 for i in range(3000)]
    assert rows(found) == [("ds 17", sum(expected)), ("same words", 1000), ("words", 3000)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_dictionary_is_shuffled_and_articles_are_read_once(spark, rows, tmp_path):
    """Whatever the dictionary, the search holds no read of the articles' own files: they were
    written once, with row numbers, and it reads that copy for n-grams and for the test."""
    path, limits = str(tmp_path / "articles"), ContainsLimits(broadcast_bytes=1000, nested_loop_entries=5)
    texts = random_words(3, 200, 60, "abcde ")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").write.parquet(path)
    scans = []
    for n in (90, 600):  # entries of all lengths in both
        needles = random_words(n, n, 9, "abcde ")
        words = spark.createDataFrame([(w, i % 7) for i, w in enumerate(needles)], "needle string, extra int")
        found = contains_join(spark.read.parquet(path), words, ["t"], "needle", limits)
        plan = plan_of(found)
        assert path not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        scans.append(plan.count("FileScan"))
        expected = sorted((i, w, k % 7) for i, t in enumerate(texts) for k, w in enumerate(needles) if w and w in t)
        assert rows(found, "id", "needle", "extra") == expected
    assert scans[0] == scans[1]


def test_grams_are_compared_where_they_are_found(spark, rows):
    """No text is searched again per candidate, and entries that share a needle share its search."""
    texts = random_words(5, 60, 80, "abé ") + ["aé" * 40, ""]
    articles = spark.createDataFrame([(i, t, t[:9]) for i, t in enumerate(texts)], "id int, t string, start string")
    needles = [w for w in random_words(6, 40, 14, "abé ") + ["aé" * 9] if w]
    words = spark.createDataFrame([(w, k) for w in needles for k in range(3)], "needle string, k int")
    found = contains_join(articles, words, ["t", "start"], "needle", plan="grams", keep=["id"])
    plan = plan_of(found)
    assert "MapInArrow" in plan and "_lower" not in plan
    assert found.columns == ["id", "needle", "k"]
    assert rows(found) == sorted((i, w, k) for i, t in enumerate(texts) for w in needles for k in range(3) if w in t)


def test_nested_loop_tests_each_needle_once(spark, rows):
    articles = spark.createDataFrame([(1, "Some text", "some"), (2, "none", None)], "id int, a string, b string")
    words = spark.createDataFrame([("some", "x"), ("SOME", "y"), ("some", "z"), ("text", "t")], "needle string, name string")
    found = contains_join(articles, words, ["a", "b"], "needle", plan="nested_loop")
    assert "HashAggregate(keys=[_needle" in plan_of(found).split("NestedLoop", 1)[1]
    assert rows(found, "id", "name") == [(1, "t"), (1, "x"), (1, "y"), (1, "z")]


def test_nested_loop_looks_at_bitmaps_first(spark, rows):
    """Pairs that share no n-gram are told apart without a search of the text, whatever the lengths."""
    rng = random.Random(8)
    texts = random_words(7, 40, 60, "abcdé ") + ["", "x" * 9000 + "needle é" + "y" * 9000]
    needles = sorted({t[i : i + n] for n in range(1, 20) for t in texts for i in [rng.randrange(40)]} | {"needle é", "zz", "x" * 30})
    articles = spark.createDataFrame([(i, t, t[3:9] + "é") for i, t in enumerate(texts)], "id int, t string, u string")
    words = spark.createDataFrame([(w,) for w in needles if w], "needle string")
    found = contains_join(articles, words, ["t", "u"], "needle", plan="nested_loop", keep=["id"])
    join = plan_of(found).split("BroadcastNestedLoopJoin", 1)[1].split("\n", 1)[0]
    assert join.index("_bitmap") < join.index("Contains(")
    expected = sorted((i, w) for i, t in enumerate(texts) for w in needles if w and (w in t or w in t[3:9] + "é"))
    assert rows(found) == expected


def test_bitmaps_tell_most_pairs_apart(spark):
    texts = [" ".join(random_words(i, 300, 8, "abcdefghijklmnop")) for i in range(20)]
    needles = random_words(99, 400, 12, "abcdefghijklmnop")
    needles = sorted({w for w in needles if len(w) > 4})
    sizes = bitmap_sizes([len(w) for w in needles])
    marked = with_bitmap(spark.createDataFrame([(i, [t]) for i, t in enumerate(texts)], "id int, t array<string>"), "t", sizes, "bitmap", 4096)
    looked = probes(F.col("needle"), sizes)
    words = spark.createDataFrame([(w,) for w in needles], "needle string")
    passed = marked.crossJoin(words).filter(may_hold(F.col("bitmap"), looked)).select("id", "needle").collect()
    held = {(i, w) for i, t in enumerate(texts) for w in needles if w in t}
    assert held <= {tuple(r) for r in passed} and len(passed) < len(held) + len(texts) * len(needles) // 50


def test_shuffled_index_lists_only_what_needles_are_filed_under(spark, rows):
    texts = ["one needle here, nothing else", "no such word in a long text " * 50, "needles néedle"]
    articles = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    words = spark.createDataFrame([("needle", 1), ("NEEDLE", 2), ("néedle", 3), ("needless", 4)], "needle string, k int")
    found = contains_join(articles, words, ["t"], "needle", plan="shuffle")
    plan = plan_of(found)
    assert "regexp_extract_all" not in plan and plan.count("MapInArrow") == 2
    assert rows(found, "id", "k") == [(0, 1), (0, 2), (2, 1), (2, 2), (2, 3)]
    codes = spark.createDataFrame([("needle",)], "w string").select(gram_code(F.col("w"), F.lit(1), 6)).first()[0]
    known = CodeFilter(1 << 15, [(0, np.packbits(np.arange(1 << 15) == codes % (1 << 15), bitorder="little").tobytes())], 1 << 15)
    listed = with_anchors(articles.select("id", F.array("t").alias("t")), "t", [(6, 1)], known, "codes")
    assert {r["id"]: r["codes"] for r in listed.collect()} == {0: [codes], 1: [], 2: [codes]}


def test_some_dozen_entries_are_found_in_one_pass(spark, rows):
    """Beyond a few entries a text is searched once for all of them, not once for each."""
    texts = random_words(11, 50, 60, "abcdé ") + ["", "ab", "a"]
    needles = sorted({w for w in random_words(12, 120, 9, "abcdé ") if w} | {"a", "é", "ab", "abc"})
    assert 32 < len(needles) < 200
    articles = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = contains_join(articles, spark.createDataFrame([(w,) for w in needles], "needle string"), ["t"], "needle", keep=["id"])
    assert "NestedLoop" not in plan_of(found)
    assert rows(found) == sorted((i, w) for i, t in enumerate(texts) for w in needles if w in t)


def test_lookup_passes_by_places_no_needle_starts_at():
    needles = ["a", "bc", "bcd", "é", "xyzxyzxyz", "q\0", "zz"]
    texts = [["abc", "bcd"], ["", "é"], ["xyzxyzxyzxyz"], ["q"], ["b", "c"], ["z", "z"], ["zzq", "\0"], ["q\0"]]
    lookup = Lookup([(n, [n]) for n in needles])
    found = lookup.search(pa.array(texts), pa.string()).to_pylist()
    assert found == [sorted((n for n in needles if any(n in t for t in row)), key=str.encode) for row in texts]
    led = np.flatnonzero(lookup.lead)
    starts = {n.encode()[:3] for n in needles}
    assert all(any(int(i).to_bytes(3, "little").startswith(s) for s in starts) for i in led[:: max(1, len(led) // 500)])


def test_no_entries_no_pairs(spark):
    articles = spark.createDataFrame([("x",)], "t string")
    for plan in ("nested_loop", "grams", "shuffle"):
        none = contains_join(articles, spark.createDataFrame([("",), (None,)], "needle string"), ["t"], "needle", plan=plan)
        assert none.columns == ["t", "needle"] and none.count() == 0


# --- mentions -------------------------------------------------------------------


def test_stock_mentions(spark, rows):
    news = spark.createDataFrame(
        [
            article("Apple pie", "x", sentiment=1.0),
            article("pineapple", None, None, sentiment=-0.5),
            article("pineapple", None, None, sentiment=-0.5),
            article("ACME inc. rises", "apple", month="2020-02"),
            article(None, None, "APPLE", month=None, sentiment=None),
            article("other", "other"),
        ],
        NEWS,
    )
    companies = spark.createDataFrame(
        [("A", "Apple Inc."), ("A2", "apple corp."), ("B", "ACME INC."), ("N", "null"), ("E", "Inc."), ("Z", None),
         ("A", "Apple Inc.")],
        "symbol string, companyname string",
    )
    found = rows(stock_mentions(news, companies), "stock", "time_period", "number_of_articles", "name", "sentiment")
    # the case-sensitive removal leaves 'apple corp.' as it is, so A2 is not found
    assert found == [
        ("A", None, 1, "Apple Inc.", None),
        ("A", "2020-01", 3, "Apple Inc.", 0.0),
        ("A", "2020-02", 1, "Apple Inc.", 0.5),
        ("B", "2020-02", 1, "ACME INC.", 0.5),
    ]


def test_two_names_of_one_symbol_count_twice(spark, rows):
    news = spark.createDataFrame([article("Apple", "pear")], NEWS)
    companies = spark.createDataFrame(
        [("A", "Apple Inc."), ("A", "Pear Inc.")], "symbol string, companyname string"
    )
    assert rows(stock_mentions(news, companies), "stock", "number_of_articles", "name") == [("A", 2, "Apple Inc.")]


def test_sector_mentions(spark, rows):
    news = spark.createDataFrame(
        [
            article("oil and drug", "t", sentiment=1.0, date="2020-03-01", month="2020-03"),
            article("oil and drug", "t", sentiment=0.0, date="2020-02-01", month="2020-02"),
            article("oil", "OILY crude", sentiment=0.5, month="2020-02"),
            article("none", "none"),
        ],
        NEWS,
    )
    sectors = spark.createDataFrame(
        [("drug", "Oil"), (None, "crude")], "`Health Care` string, Energy string"
    )
    found = sector_mentions(news, sectors)
    columns = ["sector", "time_period", "number_of_articles", "sentiment"]
    # copies count once, in their earliest month; two keywords of one sector count once
    assert rows(found, *columns) == [("Energy", "2020-02", 2, 0.25), ("Health Care", "2020-02", 1, 0.0)]
    assert rows(search_for_sector(news, sectors, "Health Care"), *columns) == [("Health Care", "2020-02", 1, 0.0)]


def test_array_forms(spark, rows):
    news = spark.createDataFrame(
        [article("Apple tree", "oil", date="2020-01-05"), article("nothing", None, date="bad")], NEWS
    )
    names = spark.createDataFrame([("Apple",), ("Pear",), ("Tree Co",), (None,)], "companyname string")
    sectors = spark.createDataFrame([("oil",), ("apple oil",)], "Energy string")
    for limits in (ContainsLimits(), ContainsLimits(broadcast_bytes=0)):
        found = add_stocks_sectors_sentiment(news, names, sectors, limits=limits)
        assert rows(found, "title", "time_period", "stocks", "sectors", "sentiment") == [
            ("Apple tree", "2020-01", ["Apple"], ["Energy"], 0.5),
            ("nothing", None, [], [], 0.5),
        ]
    # Only a dictionary too large to broadcast has the articles moved, and their tokens written.
    assert "Exchange" in plan_of(found)
    assert "Exchange" not in plan_of(add_stocks_sectors_sentiment(news, names, sectors))
    assert rows(explode_stocks_and_aggregate(found)) == [("Apple", "2020-01", 1, 0.5)]
    assert rows(explode_sectors_and_aggregate(found)) == [("Energy", "2020-01", 1, 0.5)]


def test_arrays_of_awkward_texts(spark, rows):
    """Copies, no text at all, spaces only, empty parts, parts inside tokens, repeated parts."""
    news = spark.createDataFrame(
        [article("Pineapple, oil!", None, date="2020-01-05")] * 2 + [article(None, None, date=None), article("  ", "", date="bad")], NEWS
    )
    names = spark.createDataFrame([("apple",), ("Apple",), ("",), ("a b",), ("né",)], "companyname string")
    sectors = spark.createDataFrame(
        [("oil  pine", "oil oil", "gas oil"), ("x", " ", "é")], "Double string, Empty string, Never string"
    )
    found = add_stocks_sectors_sentiment(news, names, sectors)
    assert rows(found, "title", "stocks", "sectors", "sentiment") == [
        (None, [], [], None),
        ("  ", [""], ["Empty"], 0.5),
        ("Pineapple, oil!", ["", "Apple", "apple"], ["Double", "Empty"], 0.5),
        ("Pineapple, oil!", ["", "Apple", "apple"], ["Double", "Empty"], 0.5),
    ]
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan


def test_sector_search_reads_each_text_once(spark):
    """Copies meet by digest below the search."""
    news = spark.createDataFrame([article("oil", "t")] * 3, NEWS)
    sectors = spark.createDataFrame([("oil",)], "Energy string")
    plan = plan_of(sector_mentions(news, sectors))
    above, below = plan.split("NestedLoop", 1)
    assert above.count("Exchange") == 1  # of counts per sector and month
    assert "first(title" in below and below.count("Exchange hashpartitioning(_digest") == 1


def test_articles_without_sentences_vanish(spark, rows):
    news = spark.createDataFrame([article("Good gains", "x", date="d"), article("", None), article(None, "?!")], NEWS)
    assert rows(add_sentiment(news), "title", "date", "sentiment") == [("Good gains", "d", 1.0)]


# --- prices ---------------------------------------------------------------------

JAN, FEB = 1577923200, 1580601600


def test_price_change(spark, rows):
    ticks = spark.createDataFrame(
        [
            (JAN + 60, "A", 3.0), (JAN, "A", 2.0), (JAN, "A", 2.0), (JAN + 30, "A", 9.0),
            (FEB, "A", 5.0), (FEB, "A", 5.0),  # one distinct tick: no change
            (JAN, "B", 4.0), (JAN, "B", 1.0),  # same moment: lowest first, highest last
            (JAN, "C", 0.0), (JAN + 1, "C", None), (JAN + 2, "C", math.nan), (JAN + 3, "C", -1.0), (JAN + 4, "C", 1.0),
            (None, "D", 1.0), (None, "D", 2.0),
        ],
        "timestamp bigint, stockname string, close double",
    )
    companies = spark.createDataFrame(
        [("A", "Apple", "Tech"), ("A", "Aardvark", "Zoo"), ("X", "Xeno", "Tech")],
        "stockname string, companyname string, category string",
    )
    columns = ["time_period", "symbol", "category", "first_date", "first_value", "last_date", "last_value", "companyname", "stock_price_change"]
    expected = [
        ("2020-01", "A", "Zoo", JAN, 2.0, JAN + 60, 3.0, "Aardvark", 0.5),
        ("2020-01", "B", None, JAN, 1.0, JAN, 4.0, None, 3.0),
    ]
    key = lambda found: sorted(found, key=lambda r: r[1])
    joined = join_companies(ticks, companies)
    assert key(tuple(r) for r in calculate_stock_price_change(joined).select(*columns).collect()) == expected
    assert key(tuple(r) for r in monthly_price_change(ticks, companies).select(*columns).collect()) == expected
    assert joined.count() == 13


# --- agreement ------------------------------------------------------------------


def test_agreement_and_rollups(spark, rows):
    sectors = spark.createDataFrame(
        [("Tech", "2020-01", 10, 0.5), ("Tech", "2020-02", 4, -0.5), ("Zoo", "2020-01", 1, 0.5)],
        "sector string, time_period string, number_of_articles bigint, sentiment double",
    )
    prices = spark.createDataFrame(
        [("2020-01", "A", "Tech", 0.3), ("2020-01", "B", "Tech", -0.1), ("2020-02", "A", "Tech", -0.2), ("2020-01", "Q", None, 1.0)],
        "time_period string, symbol string, category string, stock_price_change double",
    )
    per_symbol = agreement.sector_agreement(sectors, prices)
    assert rows(per_symbol, "sector", "time_period", "number_of_articles", "stock_price_change", "correlation") == [
        ("Tech", "2020-01", 10, -0.1, 0.0), ("Tech", "2020-01", 10, 0.3, 1.0),
        ("Tech", "2020-02", 4, -0.2, -1.0), ("Zoo", "2020-01", 1, None, 0.0),
    ]
    assert rows(agreement.sector_rollup(per_symbol)) == [("Tech", 24, 0.0), ("Zoo", 1, 0.0)]
    averaged = agreement.sector_agreement(sectors, prices, "avg")
    assert rows(averaged, "sector", "time_period", "correlation") == [
        ("Tech", "2020-01", 1.0), ("Tech", "2020-02", -1.0), ("Zoo", "2020-01", 0.0),
    ]
    with pytest.raises(ValueError):
        agreement.sector_agreement(sectors, prices, "median")

    stocks = spark.createDataFrame(
        [("A", "2020-01", 2, "Apple", 0.1), ("A", "2020-02", 3, "Apple", 0.1), ("Z", "2020-01", 1, "Zed", -1.0)],
        "stock string, time_period string, number_of_articles bigint, name string, sentiment double",
    )
    months = agreement.stock_agreement(stocks, prices)
    assert rows(months, "stock", "time_period", "stock_price_change", "correlation") == [
        ("A", "2020-01", 0.3, 1.0), ("A", "2020-02", -0.2, 0.0), ("Z", "2020-01", None, 0.0),
    ]
    assert rows(agreement.stock_rollup(months)) == [("A", "Apple", 5, 0.5), ("Z", "Zed", 1, 0.0)]
    latest = agreement.by_key_and_latest_month(months, "stock").select("stock", "time_period").collect()
    assert [tuple(r) for r in latest] == [("A", "2020-02"), ("A", "2020-01"), ("Z", "2020-01")]


# --- keys and upserts -------------------------------------------------------------


def test_new_articles_is_except_distinct(spark, rows):
    stored = spark.createDataFrame([article("a", "b"), article(None, None), article("m", "n", sentiment=0.0)], NEWS)
    batch = spark.createDataFrame(
        [article("a", "b"), article(None, None), article("a", "b", sentiment=0.1), article("ab", ""), article("ab", ""),
         article("ab", None), article("m", "n", sentiment=-0.0)],
        NEWS,
    )
    assert rows(new_articles(batch, stored)) == rows(batch.subtract(stored))
    assert new_articles(batch, stored).count() == 3


def test_history_is_filtered_where_it_is_read(spark, rows, tmp_path):
    """Known digests meet the batch's bits before any exchange; nothing known is missed."""
    known, batch = spark.range(0, 20_000, numPartitions=4), spark.range(19_900, 20_200, numPartitions=2)
    digests(known, ["id"]).write.parquet(str(tmp_path / "known"))
    stored = spark.read.parquet(str(tmp_path / "known"))
    fresh = rows_not_among(batch, stored, ["id"], prefilter=True)
    assert rows(fresh) == [(i,) for i in range(20_000, 20_200)]
    passed = possibly_among(stored, digests(batch, ["id"]))
    assert "Exchange hashpartitioning" not in plan_of(passed)
    assert 100 <= passed.count() < 400
    crowded = possibly_among(stored, digests(batch, ["id"]), FilterLimits(bits_per_row=1, most_bytes=1))
    assert 100 <= crowded.count()
    assert rows_not_among(batch, stored.limit(0), ["id"], prefilter=True).count() == 300
    assert rows_not_among(batch.limit(0), stored, ["id"], prefilter=True).count() == 0


def test_one_per_key(spark, rows):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 1), (None, "x", 0)], "k int, v string, w int")
    assert rows(one_per_key(df, ["k"])) == [(None, "x", 0), (1, "a", 1)]


MONTHS = "stock string, time_period string, number_of_articles bigint, name string, sentiment double, stock_price_change double, correlation double"


def test_upsert_months(spark, rows):
    stored = spark.createDataFrame(
        [("A", "2020-01", 1, "Apple", 0.1, 0.5, 1.0), ("A", None, 2, "Apple", 0.1, None, 0.0), ("B", "2020-01", 1, "Bee", 0.1, 0.5, 1.0)],
        MONTHS,
    )
    update = spark.createDataFrame(
        [("A", "2020-01", 3, "Renamed", -0.7, 0.9, 0.0), ("A", None, 2, "Apple", 0.4, None, 1.0), ("C", "2020-01", 5, "Sea", 0.2, 0.1, 1.0)],
        MONTHS,
    )
    expected = [
        ("A", None, 4, "Apple", 0.4, None, 0.5),
        ("A", "2020-01", 4, "Apple", -0.7, 0.5, 0.25),
        ("B", "2020-01", 1, "Bee", 0.1, 0.5, 1.0),
        ("C", "2020-01", 5, "Sea", 0.2, 0.1, 1.0),
    ]
    assert rows(upsert.upsert_stock_agreement(stored, update)) == expected
    with pytest.raises(Exception, match="several update rows for key"):
        upsert.upsert_stock_agreement(stored, update.union(update)).collect()


def test_upsert_totals(spark, rows):
    schema = "sector string, number_of_articles bigint, corr double"
    stored = spark.createDataFrame([("Tech", 1, 1.0), ("Zoo", 1, 0.0)], schema)
    update = spark.createDataFrame([("Tech", 3, 0.0), ("Oil", 2, -1.0)], schema)
    assert rows(upsert.upsert_sector_rollup(stored, update)) == [("Oil", 2, -1.0), ("Tech", 4, 0.25), ("Zoo", 1, 0.0)]


def test_unseen_articles(spark, rows):
    stored = spark.createDataFrame([article(None, "t", date="d"), article("a", "b", date="d")], NEWS)
    update = spark.createDataFrame(
        [article(None, "t", "other", date="d"), article("a", "b", date="e"), article("a", "b", "short", date="e")], NEWS
    )
    assert rows(upsert.unseen_articles(stored, update), "title", "date", "short_description") == [("a", "e", None)]
