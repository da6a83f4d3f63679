import json

from newstide.operators.contains import ContainsLimits
from newstide.plans.analyse import ResultTables, analyse, analyse_files
from newstide.plans.export import FOLDERS, export_tables
from newstide.plans.parse import parse_articles, parse_prices
from newstide.plans.score import score_articles
from newstide.schemas import COMPANIES, RAW_TICKS, SCORED_ARTICLES
from newstide.streaming.arrivals import analyse_arrivals

JAN = 1577923200


def write_inputs(folder, articles, closes):
    news, prices = folder / "news", folder / "prices"
    news.mkdir(parents=True)
    prices.mkdir()
    (news / "n.json").write_text(json.dumps(articles, indent=2))
    for symbol, close in closes.items():
        n = len(close)
        body = {
            "chart": {
                "result": [
                    {
                        "meta": {"symbol": symbol},
                        "timestamp": [JAN + 3600 * i for i in range(n)],
                        "indicators": {
                            "quote": [{"open": close, "close": close, "volume": [1] * n, "high": close, "low": close}]
                        },
                    }
                ]
            }
        }
        (prices / f"{symbol}.json").write_text(json.dumps(body))


def run(spark, base, name, articles, closes):
    folder = base / name
    write_inputs(folder, articles, closes)
    parse_articles(spark, str(folder / "news"), str(folder / "raw.parquet"))
    parse_prices(spark, str(folder / "prices"), str(folder / "stocks.csv"))
    score_articles(spark, str(folder / "raw.parquet"), str(folder / "news.parquet"))
    return analyse_files(
        spark, str(base / "results"), str(folder / "news.parquet"), str(folder / "stocks.csv"),
        str(base / "sectors.csv"), str(base / "companies.csv"),
    )


def test_parse_score_analyse_export_twice(spark, tmp_path, rows):
    (tmp_path / "sectors.csv").write_text("Tech,Energy\nphone,oil\napp,\n")
    (tmp_path / "companies.csv").write_text("Stockname,Companyname,Category\nA,Apple Inc.,Tech\nE,Exoil Corp.,Energy\n")
    one = [
        {"title": "Apple phone", "text": "Strong gains.\nMore to come.", "date": "2020-01-03", "short_description": "s"},
        {"title": "Exoil spill", "text": "Loss, a bad crash", "date": "2020-01-04T01:02:03Z"},
    ]
    outcome = run(spark, tmp_path, "first", one, {"A": [10, 12], "E": [5, 4]})
    assert (outcome.batch, outcome.new_articles) == (1, True)
    tables = ResultTables(spark, str(tmp_path / "results"))
    now = tables.current()
    assert rows(now["stock_corr"]) == [
        ("A", "2020-01", 1, "Apple Inc.", 1.0, 0.2, 1.0),
        ("E", "2020-01", 1, "Exoil Corp.", -1.0, -0.2, -1.0),
    ]
    # 'app' is in 'Apple', and the two keywords of Tech count once
    assert rows(now["sector_corr"]) == [
        ("Energy", "2020-01", 1, -1.0, -0.2, -1.0), ("Tech", "2020-01", 1, 1.0, 0.2, 1.0),
    ]

    # second delivery: one old article, one new, a price month that is already known
    two = one[:1] + [{"title": "Apple falls", "text": "Weak", "date": "2020-01-09"}]
    outcome = run(spark, tmp_path, "second", two, {"A": [1, 100], "F": [1, 2]})
    assert (outcome.batch, outcome.new_articles) == (2, True)
    now = tables.current()
    assert rows(now["stock_corr"]) == [
        ("A", "2020-01", 2, "Apple Inc.", -1.0, 0.2, 0.5),
        ("E", "2020-01", 1, "Exoil Corp.", -1.0, -0.2, -1.0),
    ]
    assert rows(now["stock_grouped"]) == [("A", "Apple Inc.", 2, 0.5), ("E", "Exoil Corp.", 1, -1.0)]
    assert rows(now["sector_grouped"]) == [("Energy", 1, -1.0), ("Tech", 2, 0.5)]
    assert rows(now["stock"], "symbol", "stock_price_change") == [("A", 0.2), ("E", -0.2), ("F", 1.0)]
    assert now["news"].count() == 3

    # the same delivery again changes nothing
    before = {name: rows(df) for name, df in now.items()}
    outcome = run(spark, tmp_path, "third", two, {"A": [1, 100]})
    assert (outcome.batch, outcome.new_articles) == (3, False)
    assert {name: rows(df) for name, df in tables.current().items()} == before

    export_tables(tables, str(tmp_path / "export"))
    for name, folder in FOLDERS.items():
        schema = tables.current()[name].schema
        back = spark.read.schema(schema).csv(str(tmp_path / "export" / folder), header=True, multiLine=True)
        assert rows(back) == before[name]


SECTORS = [("oil",)], "Energy string"
COMPANY = [("A", "Apple Inc.", "Energy")]


def article(title, text="oil", month="2020-01"):
    return (title, text, None, "2020-01-02", 0.5, JAN, month)


def inputs(spark, *titles):
    return (
        spark.createDataFrame(*SECTORS),
        spark.createDataFrame(COMPANY, COMPANIES),
        spark.createDataFrame([article(t) for t in titles], SCORED_ARTICLES),
        spark.createDataFrame(
            [(JAN, "A", 1.0, 1.0, 1, 1.0, 1.0), (JAN + 1, "A", 2.0, 2.0, 1, 2.0, 2.0)], RAW_TICKS
        ),
    )


def test_either_input_may_be_absent(spark, tmp_path, rows):
    sectors, companies, articles, ticks = inputs(spark, "Apple")
    tables = ResultTables(spark, str(tmp_path / "r"))
    assert analyse(tables, sectors, companies) is None
    # no prices given and none stored
    assert analyse(tables, sectors, companies, articles=articles) is None
    assert tables.last_batch() == 0
    assert analyse(tables, sectors, companies, ticks=ticks).new_articles is False
    assert rows(tables.current()["stock"], "symbol") == [("A",)]
    assert analyse(tables, sectors, companies, articles=articles).new_articles is True
    assert rows(tables.current()["stock_corr"], "stock", "number_of_articles") == [("A", 1)]
    assert tables.last_batch() == 2


def test_a_batch_that_broke_off_is_run_again(spark, tmp_path, rows, monkeypatch):
    sectors, companies, articles, ticks = inputs(spark, "Apple")
    tables = ResultTables(spark, str(tmp_path / "r"))
    analyse(tables, sectors, companies, articles, ticks)
    more = spark.createDataFrame([article("Apple again")], SCORED_ARTICLES)

    import newstide.plans.analyse as job

    def breaks(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(job.ResultTables, "complete", breaks)
        try:
            analyse(tables, sectors, companies, more, ticks)
        except RuntimeError:
            pass
    # the four agreement tables were written, but the batch is not complete
    assert tables.stock_corr.versions() == [1, 2]
    assert rows(tables.current()["stock_corr"], "number_of_articles") == [(1,)]
    analyse(tables, sectors, companies, more)
    assert rows(tables.current()["stock_corr"], "number_of_articles") == [(2,)]
    assert rows(tables.current()["stock"], "symbol") == [("A",)]


def test_leftovers_do_not_count_after_a_batch_of_prices(spark, tmp_path, rows, monkeypatch):
    sectors, companies, articles, ticks = inputs(spark, "Apple")
    tables = ResultTables(spark, str(tmp_path / "r"))
    analyse(tables, sectors, companies, ticks=ticks)

    def breaks(*_):
        raise RuntimeError("lost")

    later = spark.createDataFrame(
        [(JAN + 40 * 86400, "A", 1.0, 1.0, 1, 1.0, 1.0), (JAN + 41 * 86400, "A", 3.0, 3.0, 1, 3.0, 3.0)], RAW_TICKS
    )
    with monkeypatch.context() as patch:
        patch.setattr(ResultTables, "complete", breaks)
        try:
            analyse(tables, sectors, companies, articles, later)
        except RuntimeError:
            pass
    analyse(tables, sectors, companies, ticks=ticks)
    assert rows(tables.current()["stock"], "time_period") == [("2020-01",)]
    analyse(tables, sectors, companies, articles)
    assert rows(tables.current()["stock_corr"], "number_of_articles") == [(1,)]


def test_rows_of_one_key_are_counted_once_over_deliveries(spark, tmp_path, rows):
    sectors, companies, _, ticks = inputs(spark, "Apple")
    tables = ResultTables(spark, str(tmp_path / "r"))
    one = article("Apple")
    delivery = spark.createDataFrame([one, (*one[:2], "other", *one[3:])], SCORED_ARTICLES)
    for _ in range(3):
        analyse(tables, sectors, companies, delivery, ticks)
        assert rows(tables.current()["stock_corr"], "number_of_articles") == [(2,)]
    assert tables.current()["news"].count() == 1


def test_folders_of_keyed_tables_stay_few(spark, tmp_path):
    sectors, companies, _, ticks = inputs(spark, "Apple")
    tables = ResultTables(spark, str(tmp_path / "r"))
    for i in range(4):
        analyse(tables, sectors, companies, spark.createDataFrame([article(f"Apple {i}")], SCORED_ARTICLES), ticks)
    assert tables.stock_corr.versions() == [3, 4]
    assert len(tables.news.versions()) == 4


def test_search_plans_give_the_same_tables(spark, tmp_path, rows):
    sectors, companies, articles, ticks = inputs(spark, "Apple", "pineapple", "none")
    results = []
    for i, limits in enumerate([ContainsLimits(), ContainsLimits(nested_loop_entries=0, gram=3)]):
        tables = ResultTables(spark, str(tmp_path / str(i)))
        analyse(tables, sectors, companies, articles, ticks, limits)
        results.append({name: rows(df) for name, df in tables.current().items()})
    assert results[0] == results[1]
    assert len(results[0]["news"]) == 3


def test_arriving_files(spark, tmp_path, rows):
    sectors, companies, articles, ticks = inputs(spark, "Apple", "Apple two")
    arrivals = str(tmp_path / "arrivals")
    tables = ResultTables(spark, str(tmp_path / "r"))
    articles.limit(1).write.parquet(arrivals)

    def fold(prices):
        analyse_arrivals(spark, arrivals, str(tmp_path / "ck"), tables, sectors, companies, prices)
        return rows(tables.current()["stock_corr"], "stock", "number_of_articles")

    assert fold(ticks) == [("A", 1)]
    articles.write.mode("append").parquet(arrivals)  # holds the first article again
    assert fold(None) == [("A", 2)]
    assert fold(None) == [("A", 2)]


def test_a_batch_the_stream_delivers_again_is_not_searched(spark, tmp_path, rows, monkeypatch):
    """The run is lost after the tables are complete and before the stream knows it."""
    import newstide.plans.analyse as job
    import newstide.streaming.arrivals as arrivals

    sectors, companies, articles, ticks = inputs(spark, "Apple", "Apple two")
    folder, tables = str(tmp_path / "arrivals"), ResultTables(spark, str(tmp_path / "r"))
    articles.write.parquet(folder)
    whole = arrivals.analyse

    def lost_afterwards(*args, **named):
        outcome = whole(*args, **named)
        if "articles" in named:
            raise RuntimeError("lost")
        return outcome

    def fold(prices):
        analyse_arrivals(spark, folder, str(tmp_path / "ck"), tables, sectors, companies, prices)

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "analyse", lost_afterwards)
        try:
            fold(ticks)
        except Exception as error:
            assert "lost" in str(error)
    before = tables.last_batch()
    assert rows(tables.current()["stock_corr"], "number_of_articles") == [(2,)]

    def no_search(*_):
        raise AssertionError("searched again")

    with monkeypatch.context() as patch:
        patch.setattr(job, "stock_mentions", no_search)
        patch.setattr(job, "rows_not_among", no_search)
        fold(None)
    assert tables.last_batch() == before
    assert tables.delivered((str(tmp_path / "ck"), 0)) and not tables.delivered((str(tmp_path / "ck"), 1))
    spark.createDataFrame([article("Apple three")], SCORED_ARTICLES).write.mode("append").parquet(folder)
    fold(None)
    assert rows(tables.current()["stock_corr"], "number_of_articles") == [(3,)]
