import json
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import TINY, rows_of
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import queries
from marketspark import fixed_values as fv
from marketspark import schemas
from marketspark.functions.text import cik_of
from marketspark.operators import filters as fl
from marketspark.operators import projections as pj
from marketspark.operators import ranking as rk
from marketspark.operators import windows as wn
from marketspark.sources import readers, scratch, writers


@pytest.fixture
def bulk(tmp_path):
    folder = tmp_path / "bulk"
    (folder / "deep").mkdir(parents=True)
    (folder / "aapl.us.txt").write_text("Date,Open,High,Low,Close,Volume,OpenInt\n1984-09-07,0.42388,0.42902,0.41874,0.42388,23220030,0\n1984-09-10,0.42388,0.42516,0.41366,0.42134,18022532,0\n")
    (folder / "deep" / "xom.csv").write_text(' VOL ,Close,Date\n100,"2.5",2000-01-03\n200,oops,2000-01-04\n300,3.5,someday\n')
    (folder / "nodate.csv").write_text("Open,Close\n1,2\n")
    (folder / "empty.txt").write_text("")
    (folder / "headeronly.txt").write_text("Date,Open,High,Low,Close,Volume,OpenInt\n")
    (folder / "readme.md").write_text("Date,Close\n2000-01-03,1\n")
    return str(folder)


def test_bulk_csv(spark, bulk):
    rows = rows_of(readers.read_bulk_csv(spark, bulk, "bulk").drop("ingested_at"), "ticker", "date")
    assert [(row["ticker"], row["date"].date()) for row in rows] == [
        ("AAPL.US", date(1984, 9, 7)), ("AAPL.US", date(1984, 9, 10)), ("XOM", date(2000, 1, 3)), ("XOM", date(2000, 1, 4)),
    ]
    assert rows[0]["volume"] == 23220030.0 and rows[0]["open_interest"] == 0.0 and rows[0]["high"] == 0.42902
    assert (rows[2]["close"], rows[2]["volume"], rows[2]["open"]) == (2.5, 100.0, None)
    assert rows[3]["close"] is None
    assert {row["source"] for row in rows} == {"bulk"}


def test_bulk_csv_opens_files_once(spark, bulk):
    """The headers and the rows come from lines that one scan of the landed files has stored."""
    rows = readers.read_bulk_csv(spark, bulk, "bulk")
    assert not [name for name in rows.inputFiles() if name.endswith((".csv", ".txt"))]
    assert len(rows_of(rows)) == 4


def test_bulk_csv_long_file(spark, tmp_path):
    """A file of many splits: one header, lines that look like it are data, and all rows are there."""
    (tmp_path / "a.csv").write_text("Close,Date\n" + "".join(f"{k},2020-01-{k % 28 + 1:02}\n" for k in range(40000)) + "Close,Date\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = readers.read_bulk_csv(spark, str(tmp_path), "bulk")
        assert [tuple(row) for row in rows.agg(F.count("date"), F.sum("close"), F.count("*")).collect()] == [(40000, 799980000.0, 40000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_bulk_csv_quotes(spark, tmp_path):
    folder = tmp_path / "quoted"
    folder.mkdir()
    (folder / "a.csv").write_text('Date,Open,High,Low,Close,Volume,Open Interest\n2020-01-03,"1,000.5",2000,0.5,"1500.25",10,7\n2020-01-04,"say ""x""",1,2," 3 ",4,5\n')
    rows = rows_of(readers.read_bulk_csv(spark, str(folder), "bulk"), "date")
    assert [rows[0][name] for name in ("open", "high", "low", "close", "volume", "open_interest")] == [None, 2000.0, 0.5, 1500.25, 10.0, 7.0]
    assert [rows[1][name] for name in ("open", "high", "low", "close", "volume")] == [None, 1.0, 2.0, 3.0, 4.0]


def test_bulk_csv_first_files(spark, bulk):
    assert {row["ticker"] for row in rows_of(readers.read_bulk_csv(spark, bulk, "bulk", limit_files=1))} == {"AAPL.US"}


def test_bulk_csv_odd_files(spark, tmp_path):
    """Data that looks like a header is data; blank lines first, short and long lines, another order, a byte order mark."""
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "a.csv").write_text("\n  \nDate,Close,Kind\n2020-01-03,1,date\n2020-01-04,2\n2020-01-05,3,x,y,z\n")
    (folder / "b.csv").write_text("\ufeffClose,Date,A,B,C,D\n4,2020-01-03,,,,\ndate,date,date,date,date,date\n", encoding="utf-8")
    rows = rows_of(readers.read_bulk_csv(spark, str(folder), "bulk"), "ticker", "date")
    assert [(row["ticker"], row["date"].day, row["close"]) for row in rows] == [("A", 3, 1.0), ("A", 4, 2.0), ("A", 5, 3.0), ("B", 3, 4.0)]


def test_bulk_csv_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Note,Date,Close\n"two\nlines, ""quoted""",2020-01-03,1\r\nplain,2020-01-04,2\r\n')
    rows = rows_of(readers.read_bulk_csv(spark, str(tmp_path), "bulk", quoted_breaks=True), "date")
    assert [(row["date"].day, row["close"]) for row in rows] == [(3, 1.0), (4, 2.0)]


def test_files_in_lists_empty_files(spark, bulk, tmp_path):
    (tmp_path / "bulk" / "odd name+%.csv").write_text("")
    rows = {Path(row["path"]).name: row["bytes"] for row in rows_of(readers.files_in(spark, bulk, "*.{csv,txt}"))}
    assert rows["empty.txt"] == 0 and rows["odd name+%.csv"] == 0 and rows["nodate.csv"] == 15 and len(rows) == 6


def test_land(spark, tmp_path):
    """One file for each key, header first, in the folders of ``partitionBy``; tasks write it, so there are no checksums beside it."""
    folder = str(tmp_path / "landed")
    rows = [("T1", 0, 1, "b"), ("T1", 0, 0, "head"), ("T1", 0, 1, "a"), ("T1", 1, 1, "c"), ("T2", None, 1, "d"), (None, 1, 1, '"two\nlines"')]
    queries._land(spark.createDataFrame(rows, "ticker string, half int, place int, value string"), folder, ["ticker", "half"], "csv")
    found = {str(file.parent.relative_to(folder)): file.read_text() for file in Path(folder).rglob("*") if file.is_file()}
    none = "__HIVE_DEFAULT_PARTITION__"
    assert found == {
        "ticker=T1/half=0": "head\na\nb\n", "ticker=T1/half=1": "c\n", f"ticker=T2/half={none}": "d\n", f"ticker={none}/half=1": '"two\nlines"\n',
    }
    assert len([file for file in Path(folder).rglob("*") if file.is_file()]) == 4


def test_files_in_scans_once(spark, bulk, capsys):
    readers.files_in(spark, bulk, "*.{csv,txt}").explain()
    assert capsys.readouterr().out.count("FileScan binaryFile") == 1


def test_load_summary(spark, bulk, tmp_path):
    written = str(tmp_path / "bronze")
    writers.write_bronze_prices(readers.read_bulk_csv(spark, bulk, "bulk", with_file=True), written)
    (row,) = rows_of(readers.load_summary(spark, readers.read_layer(spark, written), bulk, written))
    assert (row["converted"], row["skipped"], row["total_rows"]) == (2, 3, 4)
    assert row["written_bytes"] > 0
    assert row["savings_pct"] == round((1 - row["written_bytes"] / row["raw_bytes"]) * 100, 2)


def test_load_summary_of_equal_names(spark, tmp_path):
    """Two files of one ticker are two files, and their rows count once."""
    raw = tmp_path / "raw"
    for name, rows in (("a/x.csv", 1), ("b/x.csv", 2), ("y.txt", 1)):
        (raw / name).parent.mkdir(parents=True, exist_ok=True)
        (raw / name).write_text("Date,Close\n" + "".join(f"2020-01-0{k + 1},1\n" for k in range(rows)))
    rows = readers.read_bulk_csv(spark, str(raw), "bulk", with_file=True)
    (row,) = rows_of(readers.load_summary(spark, rows, str(raw), str(raw)))
    assert (row["converted"], row["skipped"], row["total_rows"]) == (3, 0, 4)


def test_news_json(spark, tmp_path):
    article = {"title": "T", "description": None, "url": "u", "source": {"name": None}, "publishedAt": "2024-01-01", "content": "c"}
    lines = [
        {"ticker": "A", "status": "ok", "articles": [article, {"title": "only"}]},
        {"ticker": "B", "status": "error", "articles": [article]},
        {"ticker": "C", "status": "ok", "articles": []},
        {"ticker": "D", "status": "ok"},
    ]
    (tmp_path / "news.json").write_text("\n".join(json.dumps(line) for line in lines))
    rows = rows_of(readers.read_news_json(spark, str(tmp_path)), "title")
    assert rows == [
        {"ticker": "A", "title": "T", "description": "", "url": "u", "source": "", "published_at": "2024-01-01", "content": "c"},
        {"ticker": "A", "title": "only", "description": "", "url": "", "source": "", "published_at": "", "content": ""},
    ]


def test_filings_json(spark, tmp_path):
    def hit(n):
        return {"_source": {"entity_name": "E", "file_date": f"2024-01-{n:02}", "accession_no": f"00001-{n}"} | ({"form_type": "10-K/A"} if n == 2 else {})}

    lines = [
        {"ticker": "A", "form": "10-K", "status": 200, "hits": {"hits": [hit(n) for n in range(1, 9)]}},
        {"ticker": "B", "form": "10-Q", "status": 500, "hits": {"hits": [hit(1)]}},
        {"ticker": "C", "form": "10-Q", "status": 200},
    ]
    (tmp_path / "filings.json").write_text("\n".join(json.dumps(line) for line in lines))
    assert readers.read_filings_json(spark, str(tmp_path)).count() == 8
    rows = rows_of(readers.read_filings_json(spark, str(tmp_path), 5), "position")
    assert [row["file_date"][-1] for row in rows] == ["1", "2", "3", "4", "5"]
    assert [row["form_type"] for row in rows] == ["10-K", "10-K/A", "10-K", "10-K", "10-K"]
    assert {row["period_of_report"] for row in rows} == {""}


def test_cik(spark):
    numbers = spark.createDataFrame([("0000320193-23-000106",), ("12-3",), ("0000",), (None,)], "n string")
    assert [row[0] for row in numbers.select(cik_of(F.col("n"))).collect()] == ["320193", "12", "", None]


def test_run_dated_write_keeps_the_schema_of_no_rows(spark, tmp_path):
    folder = str(tmp_path / "news")
    writers.write_run_dated(spark.createDataFrame([], schemas.NEWS), folder, "2024-01-01")
    empty = spark.read.parquet(folder)
    assert empty.isEmpty() and empty.columns == [*schemas.NEWS.names, "date"]
    rows = spark.createDataFrame([("A", "t", "", "u", "s", "p", "c")], schemas.NEWS)
    writers.write_run_dated(rows, folder, "2024-01-02")
    writers.write_run_dated(rows, folder, "2024-01-02")  # a rerun replaces its own date only
    assert spark.read.parquet(folder).count() == 1


def test_silver_replaces_only_the_years_present(spark, make_bars, tmp_path):
    folder = str(tmp_path / "silver")
    writers.write_silver(make_bars({"A": [1.0, 2.0]}, datetime(2022, 12, 31)), folder)
    writers.write_silver(make_bars({"A": [9.0]}, datetime(2023, 5, 1)), folder)
    rows = rows_of(readers.read_layer(spark, folder), "date")
    assert [(row["year"], row["close"]) for row in rows] == [(2022, 1.0), (2023, 9.0)]
    assert len(list(Path(folder, "year=2022").glob("*.parquet"))) == 1


def test_year_bounds_prune_folders(spark, make_bars, tmp_path):
    folder = str(tmp_path / "silver")
    writers.write_silver(make_bars({"A": [1.0] * 800}, datetime(2021, 1, 1)), folder)
    some = fl.between_dates(readers.read_layer(spark, folder), "2022-03-01", "2022-12-31")
    assert some.count() == 306
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2022-03-01T00:00)" in plan and "LessThan(date,2023-01-01T00:00)" in plan
    assert "year#" in some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("]")[0]
    assert fl.in_years(readers.read_layer(spark, folder), [2021, 2022]).count() == 730


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_day_range_is_inclusive(spark, kind):
    days = spark.createDataFrame([(f"2024-01-0{n}",) for n in range(1, 8)], "d string").select(F.col("d").cast(kind).alias("date"))
    assert fl.between_dates(days, "2024-01-02", "2024-01-05").count() == 4
    assert fl.between_dates(days, start=date(2024, 1, 6)).count() == 2
    assert fl.between_dates(days).count() == 7


def test_written_years(spark, make_bars, tmp_path):
    folder = str(tmp_path / "silver")
    writers.write_silver(make_bars({"A": [1.0] * 400}, datetime(2023, 1, 1)), folder)
    rows = rows_of(readers.written_years(spark, folder), "year")
    assert [(row["year"], row["rows"], row["files"]) for row in rows] == [(2023, 365, 1), (2024, 35, 1)]
    assert all(row["bytes"] > 0 for row in rows)


def test_gold_is_partitioned_by_source(spark, make_bars, tmp_path):
    folder = str(tmp_path / "gold")
    writers.write_gold(make_bars({"A": [1.0]}).withColumn("data_source", F.lit("feed")), folder)
    writers.write_gold(make_bars({"A": [1.0, 2.0]}).withColumn("data_source", F.lit("feed")), folder)
    assert Path(folder, "data_source=feed").is_dir()
    assert spark.read.parquet(folder).count() == 2


def test_csv_summary(spark, tmp_path):
    folder = str(tmp_path / "csv")
    writers.write_csv_summary(spark.createDataFrame([("A", 1), ("B", 2)], "ticker string, total int").repartition(3), folder, [F.col("total").desc()])
    (file,) = Path(folder).glob("*.csv")
    assert file.read_text().split() == ["ticker,total", "B,2", "A,1"]


def test_materialize(spark):
    one = spark.range(3)
    assert writers.materialize(one, "m_view").count() == 3
    assert writers.materialize(one, "m_table", "table").count() == 3
    assert readers.read_table(spark, "m_table").count() == 3
    with pytest.raises(ValueError):
        writers.materialize(one, "m", "cube")


def test_footprint(spark, tmp_path):
    (tmp_path / "a").write_text("12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b").write_text("123")
    assert rows_of(readers.footprint(spark, {"x": str(tmp_path)})) == [{"dataset": "x", "files": 2, "bytes": 8}]


def test_normalise_prices(spark):
    feed = spark.createDataFrame([("2024-01-02", 1.0, 2.0, 7)], ["Date", "Close", "Adj Close", "Volume"])
    out = pj.normalise_prices(feed, "feed", F.lit("AAPL"))
    assert out.columns == ["date", "ticker", "close", "volume", "source", "ingested_at"]
    assert out.first()["date"] == datetime(2024, 1, 2)


def test_universe_filter(spark):
    rows = spark.createDataFrame([("AAPL",), ("ZZZ",), (None,)], "ticker string")
    assert [row.ticker for row in fl.in_universe(rows).collect()] == ["AAPL"]
    assert [row.ticker for row in fl.in_universe(rows, spark.createDataFrame([("ZZZ",), ("ZZZ",)], "ticker string")).collect()] == ["ZZZ"]
    assert [row.ticker for row in fl.for_ticker(rows, "aapl").collect()] == ["AAPL"]
    assert pj.upper_ticker(spark.createDataFrame([("aapl",)], "ticker string")).first().ticker == "AAPL"


def test_last_days(spark):
    news = spark.createDataFrame([("2024-01-10T12:00:00Z",), ("2024-01-02",), ("2024-01-03",)], "published_at string")
    assert fl.last_days(news, 7, as_of="2024-01-10").count() == 2
    assert fl.last_days(news).isEmpty()


def test_first_hits(spark):
    hits = spark.createDataFrame([("A", "10-K", n) for n in range(8)] + [("A", "10-Q", 1)], "ticker string, form_type string, position int")
    assert wn.first_n_hits(hits, fv.HITS_PER_FORM).count() == 6


def test_run_history(spark, tmp_path):
    folder = str(tmp_path / "runs")
    for run, started in (("a", "2024-01-01"), ("b", "2024-01-03"), ("c", "2024-01-02")):
        writers.append_run(spark.createDataFrame([(run, started)], "run_id string, start_time string"), folder)
    assert [row.run_id for row in rk.run_history(spark.read.parquet(folder)).collect()] == ["b", "c", "a"]


def test_shared_folder_is_the_configured_one(spark):
    assert scratch.new_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_declared_schemas_match_what_is_written(spark, tmp_path):
    from marketspark.plans.refresh import refresh_source

    root = str(tmp_path)
    refresh_source(fx.raw_prices(spark, TINY).drop("a1", "a2", "a3"), "feed", root, ())
    silver = spark.read.parquet(f"{root}/silver/prices/feed")
    assert {field.name: field.dataType for field in silver.schema} == {field.name: field.dataType for field in schemas.SILVER_PRICES}
    gold = spark.read.parquet(f"{root}/gold/indicators/feed")
    assert {field.name: field.dataType for field in gold.schema} == {field.name: field.dataType for field in schemas.GOLD_INDICATORS}
    assert silver.count() == gold.count() > 0


class _Unset:
    """A session whose configuration names no shared folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"test-{master}"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})


def test_scratch_without_a_shared_folder():
    local = _Unset("local[4]")
    root = scratch.shared_root(local)
    assert Path(root).is_dir() and root == scratch.shared_root(local)
    assert scratch.new_folder(local) != scratch.new_folder(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(_Unset("spark://cluster:7077"))


def test_price_layers_are_packed(spark, make_bars, tmp_path):
    bars = make_bars({"A": [1.0, 2.0]}).withColumn("data_source", F.lit("feed"))
    for write, name in ((writers.write_bronze_prices, "bronze"), (writers.write_silver, "silver"), (writers.write_gold, "gold")):
        write(bars, f"{tmp_path}/{name}")
        files = [path.name for path in (tmp_path / name).rglob("*.parquet")]
        assert files and all(path.endswith(".zstd.parquet") for path in files)
