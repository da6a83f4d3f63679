import math

import pytest
from pyspark.sql import functions as F

from newstide.functions import numbers, price_arrays, text
from newstide.functions.agreement import product_sign, sign_agreement
from newstide.functions.dates import epoch_seconds, month_of_epoch
from newstide.functions.sentiment import Lexicon, sentence_scores, signed_confidence, strongest


def evaluate(spark, schema, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_number_or_default(spark):
    inputs = ["12", " -7 ", "1.5", "1e3", "9999999999", "abc", "", None, "1.0d", "inf", "99999999999999999999"]
    got = evaluate(
        spark, "s string", [(v,) for v in inputs],
        numbers.long_or_zero(F.col("s")), numbers.double_or_zero(F.col("s")),
    )
    assert [g[0] for g in got] == [12, -7, 0, 0, 9999999999, 0, 0, 0, 0, 0, 0]
    assert [g[1] for g in got] == [12.0, -7.0, 1.5, 1000.0, 9999999999.0, 0.0, 0.0, 0.0, 0.0, math.inf, 1e20]
    [(nan,)] = evaluate(spark, "s string", [("nan",)], numbers.double_or_zero(F.col("s")))
    assert math.isnan(nan)


@pytest.mark.parametrize(
    "date, month, seconds",
    [
        ("2020-12-12T10:11:12Z", "2020-12", 1607767872),
        ("2020-12-12 10:11:12", "2020-12", 1607767872),
        ("2020-12-12", "2020-12", 1607731200),
        ("2020-1-2", "2020-01", 1577923200),
        ("2021-01-01T00:00:00Z", "2021-01", 1609459200),
        ("2020-12-31 23:59:59.999", "2020-12", 1609459199),
        ("2020-12-12Tnoon", "2020-12", 1607731200),
        ("2021-02-30", None, None),
        ("yesterday", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_dates(spark, date, month, seconds):
    unix = epoch_seconds(F.col("d"))
    assert evaluate(spark, "d string", [(date,)], unix, month_of_epoch(unix)) == [(seconds, month)]


def test_strip(spark):
    got = evaluate(
        spark, "s string", [('"ti\\tle"',), (",,a,b,",)],
        text.strip_quotes(F.col("s")), text.strip_commas(F.col("s")),
    )
    assert got == [("title", '"ti\\tle"'), (",,a,b,", "a,b")]


@pytest.mark.parametrize(
    "name, cleaned, strict",
    [
        ("Apple Inc.", "Apple", "Apple"),
        ("ACME INC.", "ACME INC.", "ACME"),
        ("Incyte Inc.", "te", "Incyte"),
        ("Incyte Corp.", "Incyte", "Incyte"),
        ("Foo Corporation", "Foo", "Foo"),
        ("Foo Limited", "Foo", "Foo"),
        ("Inc.", "", "Inc."),
        ("Queux", "Queux", "Queux"),
        (None, None, None),
    ],
)
def test_company_names(spark, name, cleaned, strict):
    got = evaluate(
        spark, "n string", [(name,)],
        text.clean_company_name(F.col("n")), text.clean_company_name_strict(F.col("n")),
    )
    assert got == [(cleaned, strict)]


def test_tokens(spark):
    data = [("A b-C", "d  é,e", None), (None, None, None)]
    got = evaluate(
        spark, "a string, b string, c string", data,
        text.tokenize(F.col("a"), F.col("b"), F.col("c")),
        text.article_text(F.col("a"), F.col("b"), F.col("c")),
    )
    assert got == [(["a", "bc", "d", "", "e"], "A b-C. d  é,e"), (None, "")]


def test_array_matches(spark):
    plain = text.plain_text(F.col("t"))
    names = F.array(*[F.lit(n) for n in ["Apple", "pear", "two words", "PINE", "Apple"]])
    keywords = F.array(
        *[
            F.struct(F.lit(s).alias("sector"), F.lit(k).alias("keyword"))
            for s, k in [("Food", "apple tree"), ("Food", "pine"), ("Wood", "tree oak"), ("Any", "app")]
        ]
    )
    got = evaluate(
        spark, "t string", [("Pineapple, trees!",), (None,)],
        text.names_in_text(plain, names), text.sectors_in_text(plain, keywords),
    )
    assert got == [(["Apple", "PINE"], ["Any", "Food"]), ([], [])]


def test_agreement(spark):
    data = [(0.5, 0.1), (-0.5, -0.1), (0.5, -0.1), (0.0, 0.1), (None, 0.1), (0.5, None)]
    got = evaluate(
        spark, "s double, p double", data,
        sign_agreement(F.col("s"), F.col("p")), product_sign(F.col("s"), F.col("p")),
    )
    assert got == [(1.0, 1.0), (-1.0, 1.0), (0.0, 0.0), (0.0, 0.0), (0.0, None), (0.0, None)]


@pytest.mark.parametrize(
    "prices, expected",
    [
        ([5.0, 0.0, 0.0], (5.0, 0.0, 1, 3, -1.0)),
        ([0.0, 2.0, 3.0, 0.0], (2.0, 3.0, 2, 3, 0.5)),
        ([0.0, 0.0], (0.0, 0.0, 1, 2, 0.0)),
        ([7.0], (0.0, 0.0, None, None, 0.0)),
        ([], (0.0, 0.0, None, None, 0.0)),
        ([4.0, 1.0], (4.0, 1.0, 1, 2, -0.75)),
        (None, (None, None, None, None, None)),
    ],
)
def test_price_arrays(spark, prices, expected):
    stamps = None if prices is None else list(range(1, len(prices) + 1))
    p, t = F.col("p"), F.col("t")
    got = evaluate(
        spark, "p array<double>, t array<bigint>", [(prices, stamps)],
        price_arrays.first_value(p), price_arrays.last_value(p),
        price_arrays.first_date(p, t), price_arrays.last_date(p, t), price_arrays.price_change(p),
    )
    assert got == [expected]


LEXICON = Lexicon(positive=("good", "up"), negative=("bad",))


@pytest.mark.parametrize(
    "article, best",
    [
        # confidence 1/3 against 1: the second sentence wins
        ("Good good bad. Bad news! Fine", (1.0, -1, "negative")),
        # a tie goes to the earliest sentence
        ("Up. Bad.", (1.0, 0, "positive")),
        ("nothing here. nor here", (0.0, 0, "na")),
        ("", None),
        (" ... \n", None),
        # words only, not parts of words
        ("goodness upward", (0.0, 0, "na")),
    ],
)
def test_sentence_scores(spark, article, best):
    [(got,)] = evaluate(spark, "t string", [(article,)], strongest(sentence_scores(F.col("t"), LEXICON)))
    assert (tuple(got) if got else None) == best


def test_confidence_is_compared_as_a_number(spark):
    scores = F.expr(
        "array(struct('positive' as result, '9E-2' as confidence, 0 as pos),"
        " struct('negative' as result, '0.5' as confidence, 1 as pos))"
    )
    best = strongest(scores)
    got = evaluate(
        spark, "x int", [(1,)], best["result"], signed_confidence(best["result"], best["confidence"])
    )
    assert got == [("negative", -0.5)]
