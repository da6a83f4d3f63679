import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newstide.functions.numbers import double_or_zero, long_or_zero, plain_numbers
from newstide.operators.mentions import sector_keywords
from newstide.schemas import ARTICLE_COLUMNS, RAW_ARTICLES, SCORED_ARTICLES
from newstide.sources.articles import read_articles_array, read_articles_csv, read_articles_json, read_scored_articles
from newstide.sources import json_arrays
from newstide.sources.corrupt import corrupt_records
from newstide.sources.json_arrays import json_objects
from newstide.sources.dimensions import read_companies_csv, read_sectors_csv
from newstide.sources.optional import or_none
from newstide.sources.prices import PriceLayout, price_schema, read_prices_array, read_prices_csv, read_prices_json
from newstide.sources.sinks import write_articles_csv, write_prices_csv
from newstide.operators.upsert import upsert
from newstide.sources.tables import StoredTable


def test_articles_from_json_arrays(spark, tmp_path, rows):
    articles = [
        {"title": 'He said "no", twice', "date": "2020-01-02", "text": "a\nb", "authors": ["x", "y"], "other": {"title": "inner"}},
        {"title": None, "url": "u"},
    ]
    (tmp_path / "news.json").write_text(json.dumps(articles, indent=2))
    read = read_articles_json(spark, str(tmp_path / "news.json"))
    assert read.columns == ARTICLE_COLUMNS
    assert rows(read, "title", "url", "date", "text") == [
        (None, "u", None, None),
        ('He said "no", twice', None, "2020-01-02", "a\nb"),
    ]
    lists = [r.authors and json.loads(r.authors) for r in read.collect()]
    assert lists == [["x", "y"], None]
    write_articles_csv(read, str(tmp_path / "csv"))
    assert rows(read_articles_csv(spark, str(tmp_path / "csv"))) == rows(read)


def price_file(symbol, **series):
    stamps = series.pop("timestamp")
    return {
        "chart": {
            "result": [
                {"meta": {"symbol": symbol, "currency": "X"}, "timestamp": stamps, "indicators": {"quote": [series]}}
            ]
        }
    }


def test_prices_from_json(spark, tmp_path, rows):
    folder = tmp_path / "json"
    folder.mkdir()
    whole = price_file(
        "AAA", timestamp=[10, 20, 30], open=[1, None, 3.5], close=[2, "x"], volume=[5000000000, 1.5, 7],
        high=[1, 2, 3], low=[1, 2, 3, 4],
    )
    (folder / "a.json").write_text(json.dumps(whole, indent=1))
    (folder / "b.json").write_text(json.dumps(price_file("BBB", timestamp=[10], open=[1], close=[2])))
    (folder / "c.json").write_text(json.dumps(whole, indent=1)[:150])
    ticks = read_prices_json(spark, str(folder))
    expected = [
        (10, "AAA", 1.0, 2.0, 5000000000, 1.0, 1.0),
        (20, "AAA", 0.0, 0.0, 0, 2.0, 2.0),
        (30, "AAA", 3.5, 0.0, 7, 3.0, 3.0),
    ]
    columns = ["timestamp", "stockname", "open", "close", "volume", "high", "low"]
    assert rows(ticks, *columns) == expected
    write_prices_csv(ticks, str(tmp_path / "csv"))
    assert rows(read_prices_csv(spark, str(tmp_path / "csv")), *columns) == expected


def test_corrupt_records_are_given_and_not_read_as_rows(spark, tmp_path, rows):
    lines = [json.dumps({"title": "a"}), '{"title": "b", "te', json.dumps({"text": "c"})]
    (tmp_path / "n.json").write_text("\n".join(lines))
    path = str(tmp_path / "n.json")
    assert rows(read_articles_json(spark, path, multi_line=False), "title", "text") == [(None, "c"), ("a", None)]
    bad = corrupt_records(spark, path, RAW_ARTICLES, multi_line=False)
    assert rows(bad, "record") == [(lines[1],)] and bad.count() == 1

    folder = tmp_path / "prices"
    folder.mkdir()
    whole = json.dumps(price_file("AAA", timestamp=[10], open=[1], close=[2], low=[1]))
    (folder / "a.json").write_text(whole)
    (folder / "b.json").write_text(whole[:40])
    bad = corrupt_records(spark, str(folder), price_schema())
    assert [r.file.rsplit("/", 1)[-1] for r in bad.collect()] == ["b.json"]
    assert read_prices_json(spark, str(folder)).count() == 1


def test_price_layout_is_a_parameter(spark, tmp_path, rows):
    line = {"data": [{"name": "Z", "t": [1, 2], "q": [{"close": [3, 4], "low": [1, 1]}]}]}
    (tmp_path / "p.json").write_text(json.dumps(line))
    layout = PriceLayout(results="data", symbol="name", timestamps="t", quotes="q")
    ticks = read_prices_json(spark, str(tmp_path / "p.json"), layout)
    assert rows(ticks, "stockname", "timestamp", "close", "open") == [("Z", 1, 3.0, 0.0), ("Z", 2, 4.0, 0.0)]


def test_absent_inputs(spark, tmp_path):
    assert read_prices_csv(spark, str(tmp_path / "none")) is None
    assert read_scored_articles(spark, str(tmp_path / "none")) is None
    spark.createDataFrame([], SCORED_ARTICLES).write.parquet(str(tmp_path / "empty"))
    assert read_scored_articles(spark, str(tmp_path / "empty")) is None
    with pytest.raises(AnalysisException):
        or_none(lambda: spark.range(1).select("no_such_column"))


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that a small file is read by many tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("97b", "1b", "64")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path, rows, small_splits):
    rng = random.Random(7)
    odd = ["}", "{", "[", "]", '"', "\\", "\\\\", ",", "\n", " ", "x", "é", "},{", '\\"', ":"]
    files = {}
    for name, indent in (("one", None), ("two", 2), ("three", None)):
        files[name] = [
            {"title": "".join(rng.choice(odd) for _ in range(rng.randrange(40))), "text": f"{name} {i}",
             "authors": rng.choice([None, ["a}", {"b": "]"}], []]), "other": {"deep": [{"title": "}"}]}}
            for i in range(rng.randrange(40, 90))
        ]
        (tmp_path / f"{name}.json").write_text(json.dumps(files[name], indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "empty.json").write_text("[ ]\n")
    (tmp_path / "single.json").write_text("\ufeff" + '{"title": "alone {", "text": "s", "other": {"a": {}}}\n', encoding="utf-8")
    source = str(tmp_path / "*.json")
    found = read_articles_array(spark, source)
    expected = sorted([(a["title"], a["text"]) for f in files.values() for a in f] + [("alone {", "s")])
    assert rows(found, "title", "text") == expected
    whole = read_articles_json(spark, source).filter("title IS NOT NULL OR text IS NOT NULL")
    others = [c for c in ARTICLE_COLUMNS if c != "authors"]
    assert rows(found, *others) == rows(whole, *others)
    # lists come as JSON text, here without the white space of the file
    authors = lambda df: sorted(repr((r.text, r.authors and json.loads(r.authors))) for r in df.collect())
    assert authors(found) == authors(whole)
    assert json_objects(spark, source).filter("NOT whole").count() == 0
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "one.json")).rdd.getNumPartitions() > 5


def test_a_cut_array_tells_what_is_broken(spark, tmp_path, rows, small_splits):
    text = json.dumps([{"title": f"t{i}", "text": "x" * 50} for i in range(20)])
    (tmp_path / "cut.json").write_text(text[:-30])
    found = json_objects(spark, str(tmp_path))
    assert found.filter("whole").count() == 19
    (rest,) = found.filter("NOT whole").collect()
    assert rest.record.startswith('{"title": "t19"') and text.endswith(rest.record + text[-30:])
    assert rows(read_articles_array(spark, str(tmp_path)), "title") == sorted((f"t{i}",) for i in range(19))
    (tmp_path / "cut.json").write_text('[1, {"title": "kept"}, "s", {"title": "t"}]')
    assert rows(read_articles_array(spark, str(tmp_path)), "title") == []


def test_price_documents_in_one_array(spark, tmp_path, rows, small_splits):
    def document(symbol):
        quote = {s: [1.0, 2.0, 3.0] for s in ("open", "close", "volume", "high", "low")}
        return {"chart": {"result": [{"meta": {"symbol": symbol}, "timestamp": [1, 2, 3], "indicators": {"quote": [quote]}}]}}

    (tmp_path / "all.json").write_text(json.dumps([document(f"S{i}") for i in range(30)]))
    (tmp_path / "one.json").write_text(json.dumps(document("T")))
    found = read_prices_array(spark, str(tmp_path))
    assert found.count() == 93
    assert rows(found.filter("stockname = 'T'"), "timestamp", "close") == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_dimensions(spark, tmp_path, rows):
    (tmp_path / "companies.csv").write_text("Stockname,Companyname,Category\nA,Apple Inc.,Tech\nB,,\n")
    assert rows(read_companies_csv(spark, str(tmp_path / "companies.csv"))) == [
        ("A", "Apple Inc.", "Tech"), ("B", None, None),
    ]
    (tmp_path / "sectors.csv").write_text("Health Care,Energy\ndrug,oil\nclinic,\n007,oil\n")
    keywords = sector_keywords(read_sectors_csv(spark, str(tmp_path / "sectors.csv")))
    assert rows(keywords) == [
        ("Energy", "oil"), ("Health Care", "007"), ("Health Care", "clinic"), ("Health Care", "drug"),
    ]


def test_stored_tables(spark, tmp_path, rows):
    one, two = spark.range(1, 3), spark.range(5, 6)
    for append_only, after in ((False, [(5,)]), (True, [(1,), (2,), (5,)])):
        table = StoredTable(spark, str(tmp_path / f"t{append_only}"), one.schema, append_only)
        assert table.open_or_none() is None
        assert rows(table.open_or_empty()) == []
        first, created = table.open_or_create(one)
        assert created and rows(first) == [(1,), (2,)]
        assert table.open_or_create(two)[1] is False
        table.publish(two, 2)
        assert table.versions() == [1, 2]
        assert rows(table.open_or_none()) == after
        assert rows(table.open_or_none(up_to=1)) == [(1,), (2,)]
        # a folder whose job did not finish does not count
        (tmp_path / f"t{append_only}" / "v=000003-lost").mkdir()
        assert table.versions() == [1, 2]


def test_fifty_batches_stay_few_folders(spark, tmp_path, rows):
    table = StoredTable(spark, str(tmp_path / "t"), spark.range(1).schema, append_only=True, most_folders=4)
    for version in range(1, 51):
        table.publish(spark.range(version, version + 1, numPartitions=1), version)
        if version == 30:
            older = table.open_or_none()
        if version == 31:
            table.drop_superseded(version)
            # whoever holds the list before goes on reading
            assert rows(older) == [(i,) for i in range(1, 31)]
        table.drop_superseded(version)
        assert len(table.latest().folders) <= 4
    assert rows(table.open_or_none()) == [(i,) for i in range(1, 51)]
    live = {f for v in table.versions()[-2:] for f, _, _ in table.listed(v).folders}
    assert {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v=")} == live


def test_an_update_of_one_key_rewrites_one_part(spark, tmp_path, rows):
    schema = "k string, n bigint"
    table = StoredTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, keys=("k",), shards=8)
    table.publish(spark.createDataFrame([(str(i), i) for i in range(100)] + [(None, -1)], schema), 1)
    before = set(table.latest().folders)
    assert len(before) == 8

    def merge(stored, update):
        return upsert(stored, update, ["k"], {"n": "arriving.n + stored.n"})

    table.upsert(spark.createDataFrame([("7", 1000)], schema), 2, merge)
    after = set(table.latest().folders)
    assert len(before - after) == len(after - before) == 1
    expected = {**{str(i): i for i in range(100)}, None: -1, "7": 1007}
    assert {r.k: r.n for r in table.open_or_none().collect()} == expected
    table.upsert(spark.createDataFrame([(None, 5), ("new", 3)], schema), 3, merge)
    assert {r.k: r.n for r in table.open_or_none().collect()} == {**expected, None: 4, "new": 3}
    assert {r.k: r.n for r in table.open_or_none(up_to=2).collect()} == expected
    table.drop_superseded(3)
    assert table.versions() == [2, 3] and table.open_or_none(up_to=2).count() == 101
    # an empty update takes everything over
    table.upsert(spark.createDataFrame([], schema), 4, merge)
    assert set(table.latest().folders) == set(table.listed(3).folders)


def test_price_values_are_read_alike_in_plain_and_odd_series(spark):
    """A series of plain numbers is tested as a whole; one odd value sends it to the pattern."""
    values = ["5", "1.5", "1,2", "1E2", "+7", "-3", ".", "", "1.2.3", "9" * 30, "--1"]
    odd = [*values, "0x1p3", "2d", " 4 ", "7\n", "nan", "٣"]
    rows = spark.createDataFrame([(0, values), (1, odd), (2, ["12\n"]), (3, [None, "4"]), (4, []), (5, None)], "i int, v array<string>")
    for kind, read in (("bigint", long_or_zero), ("double", double_or_zero)):
        plain = plain_numbers(F.col("v"), kind)
        each = rows.select("i", plain.alias("plain"), F.explode("v").alias("x"))
        found = each.select("i", "plain", read(F.col("x")).alias("a"), read(F.col("x"), F.col("plain")).alias("b"))
        assert found.filter("NOT (a <=> b)").count() == 0
        assert {r.i for r in found.filter("plain").collect()} == ({3} if kind == "bigint" else {0, 3})


def test_price_rows_are_parsed_and_zipped_once(spark, tmp_path):
    path = tmp_path / "prices.json"
    path.write_text('[{"chart": {"result": [{"meta": {"symbol": "A"}, "timestamp": [1, 2], "indicators": {"quote": [{"low": [3]}]}}]}}]')
    found = read_prices_array(spark, str(path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("arrays_zip") == 1
    assert "cast(chart" not in plan and "cast(row" not in plan
    assert [(r.timestamp, r.low) for r in found.orderBy("timestamp").collect()] == [(1, 3.0), (2, 0.0)]


def test_objects_within_a_block_are_neither_moved_nor_written(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(json_arrays, "stage", lambda df, label: staged.append(df.collect()) or spark.createDataFrame(staged[-1], df.schema))
    texts = ["plain", 'quote " and } brace', "back\\slash\\", "[{", ""]
    objects = [{"title": texts[i % 5], "text": str(i)} for i in range(300)]
    (tmp_path / "one.json").write_text(json.dumps(objects))
    found = json_objects(spark, str(tmp_path))
    assert sorted(int(json.loads(r.record)["text"]) for r in found.collect()) == list(range(300))
    assert [len(rows) for rows in staged] == [2]  # of the file's one block, what ends first and what is left
    inner = found._jdf.queryExecution().optimizedPlan().toString().split("Union", 1)[1].split("MapInArrow", 1)[0]
    assert "Window" not in inner and "Aggregate" not in inner


def test_price_csv_may_be_compressed(spark, tmp_path, rows):
    ticks = spark.range(5000).selectExpr(
        "id * 60 AS timestamp", "'S' || id % 7 AS stockname", "id / 4 AS open", "CAST(id AS DOUBLE) AS close",
        "id AS volume", "1.5D AS high", "0D AS low",
    )
    sizes = {}
    for codec in (None, "lz4"):
        path = tmp_path / f"ticks-{codec}"
        write_prices_csv(ticks, str(path), compression=codec)
        assert rows(read_prices_csv(spark, str(path))) == rows(ticks)
        sizes[codec] = sum(f.stat().st_size for f in path.glob("part-*"))
    assert 3 * sizes["lz4"] < 2 * sizes[None]
