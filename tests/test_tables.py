import datetime as dt

import pytest
from conftest import column

from tickloom import schema
from tickloom.operators import latest, quality, shape
from tickloom.operators.segments import SegmentLimits
from tickloom.plans.collection import run_collection
from tickloom.plans.database import run_database_setup
from tickloom.plans.preprocessing import feature_table, run_preprocessing
from tickloom.sources import readers, tables, writers


def write_csv(folder, ticker, closes, volume):
    lines = ["Ticker,Date,Open,High,Low,Close,Volume"]
    for i, close in enumerate(closes):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
        lines.append(f"{ticker},{day},{close},{close},{close},{close},{volume + i}")
    (folder / f"{ticker}_stock_data.csv").write_text("\n".join(lines) + "\n")


def test_csv_files_share_one_schema(spark, tmp_path):
    write_csv(tmp_path, "A", [1.5, 2], 10)
    write_csv(tmp_path, "B", [3, 4], 5_000_000_000)
    (tmp_path / "notes.csv").write_text("not,a,bar\n")
    df = readers.read_bar_files(spark, str(tmp_path))
    assert df.schema == schema.RAW_SCHEMA
    assert df.count() == 4
    assert column(df, "Volume", "B") == [5_000_000_000, 5_000_000_001]


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "X_stock_data.csv").write_text("Ticker,Date,Close,High,Low,Open,Volume\nX,2020-01-01,1,2,3,4,5\n")
    with pytest.raises(Exception, match="header"):
        readers.read_bar_files(spark, str(tmp_path)).collect()


def test_preprocessing_job(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out.parquet")
    source.mkdir()
    for ticker in ("A", "B"):
        write_csv(source, ticker, [10 + i % 7 for i in range(50)], 100)
    out = run_preprocessing(spark, str(source), target)
    assert out.columns == schema.FEATURE_TABLE_COLUMNS
    assert out.count() == 96
    assert not list((tmp_path / "out.parquet").glob("_SUCCESS"))


def test_bar_folders_keep_series_names(spark, tmp_path, bars):
    df = shape.rename_all(bars(**{"007": [1, 2], "B C": [3]}), schema.RAW_COLUMNS)
    writers.write_bar_folders(df, str(tmp_path / "csv"))
    back = readers.read_bar_folders(spark, str(tmp_path / "csv"))
    assert back.schema["Ticker"].dataType.simpleString() == "string"
    assert sorted(back.collect()) == sorted(df.collect())


def test_serving_table(spark, tmp_path, bars):
    path, place = str(tmp_path / "features"), str(tmp_path / "stock")
    writers.write_features(feature_table(shape.rename_all(bars(A=range(10, 60), B=range(5, 30)), schema.RAW_COLUMNS)), path)
    rows, head = run_database_setup(spark, path, "stock_test", "A", place)
    assert rows == 48 + 23
    assert head.count() == 5 and head.columns == ["ticker", "date", "close", "rsi", "ma_7"]
    assert column(head, "close") == [55, 56, 57, 58, 59]
    assert spark.table("stock_test").schema == schema.SERVING_SCHEMA
    assert [r["close"] for r in tables.stock_data(spark, "A", 3, "stock_test").collect()] == [59, 58, 57]
    assert tables.stock_history(spark, "B", "stock_test").first()["close"] == 7
    assert [(r["ticker"], r["close"]) for r in tables.latest_prices(spark, "stock_test").collect()] == [("A", 59), ("B", 29)]
    assert [r["ticker"] for r in tables.all_rows(spark, "stock_test").collect()] == ["A"] * 48 + ["B"] * 23
    assert tables.load_table(spark, path, "stock_test", place) == 71  # replaced, not appended
    assert spark.table("stock_test").count() == 71


def test_latest_rows_and_mean(bars):
    df = bars(A=range(10), B=[5]).withColumnRenamed("close", "daily_return")
    assert latest.latest_rows(df, 3).count() == 4
    means = {r["ticker"]: r["mean_return"] for r in latest.recent_mean(df, n=4).collect()}
    assert means == {"A": 7.5, "B": 5.0}


def test_many_latest_rows_of_a_long_series(spark, bars):
    df = bars(A=range(300), B=range(5))
    limits = SegmentLimits(max_rows=40, small_bytes=0)
    threshold = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(threshold)
    want = sorted(map(repr, latest.latest_rows(df, 120).collect()))
    try:
        spark.conf.set(threshold, "100")
        got = sorted(map(repr, latest.latest_rows(df, 120, limits=limits).select(*df.columns).collect()))
    finally:
        spark.conf.set(threshold, before)
    assert got == want and len(got) == 125


def test_collection_job(spark, tmp_path):
    frame = spark.sql("SELECT date'2024-01-02' AS Date, 1D AS Open, 2D AS High, 0.5D AS Low, 1.5D AS Close, 10L AS Volume")
    report = run_collection(spark, {"X": frame, "Y": frame.unionAll(frame)}, str(tmp_path / "bars")).collect()
    assert {(r["ticker"], r["n_rows"], r["has_duplicate_dates"]) for r in report} == {("X", 1, False), ("Y", 2, True)}


def test_value_counts_fill_zero(bars):
    df = bars(A=[1, 2, 2]).selectExpr("if(close = 2, 'High', 'Low') AS label")
    assert {tuple(r) for r in latest.value_counts(df, "label", schema.GRADES).collect()} == {
        ("High", 2), ("Medium", 0), ("Low", 1)
    }


def test_quality_checks_fail_one_by_one(spark, bars):
    good = bars(GOOD=range(1, 201), SHORT=range(1, 200), ZERO=[0] + list(range(1, 200)), HOLE=[None] + list(range(1, 200)))
    double = bars(TWICE=range(1, 201))
    df = good.unionByName(double).unionByName(double.limit(1))
    got = {r["ticker"]: r for r in quality.series_quality(df).collect()}
    flags = ("too_few_rows", "has_missing", "has_duplicate_dates", "has_bad_close", "valid")
    want = {"GOOD": "valid", "SHORT": "too_few_rows", "ZERO": "has_bad_close", "HOLE": "has_missing",
            "TWICE": "has_duplicate_dates"}
    for ticker, flag in want.items():
        assert [f for f in flags if got[ticker][f]] == [flag]
    assert quality.overall_quality(df).first()["all_valid"] is False
    assert quality.overall_quality(df.filter("ticker = 'GOOD'")).first()["all_valid"] is True


def test_presence_checks(bars):
    df = bars(A=[1], B=[2])
    assert [r["ticker"] for r in quality.missing_series(df, ["A", "C"]).collect()] == ["C"]
    assert quality.missing_columns(df, ["Close", "RSI"]) == ["RSI"]
    assert quality.enough_rows(df, 2).first()[0] is True
    assert quality.enough_rows(df, 3).first()[0] is False


def test_vendor_frame(spark):
    raw = spark.createDataFrame([("2024-01-02", 1, 2, 3, 4, 5)], "Date string, `Close|X` int, `High|X` int, `Low|X` int, `Open|X` int, `Volume|X` int")
    out = shape.normalise_vendor_frame(raw, "X")
    assert out.schema == schema.RAW_SCHEMA or [f.dataType for f in out.schema] == [f.dataType for f in schema.RAW_SCHEMA]
    assert tuple(out.first()) == ("X", dt.date(2024, 1, 2), 4.0, 2.0, 3.0, 1.0, 5)


def test_union_by_name(bars):
    one = bars(A=[1])
    both = latest.concatenate([one, one.select(*reversed(one.columns))])
    assert both.count() == 2 and both.distinct().count() == 1
