"""The bucketed table, kept results, flat CSV files, wide vendor tables, long ticker lists, positions and hash samples."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions import intent
from tickloom.operators import indicators, latest, positions, shape, splits
from tickloom.schema import RAW_COLUMNS
from tickloom.sources import cache, tables
from tickloom.sources.readers import read_bar_files
from tickloom.sources.writers import write_bar_files


def plan_of(df):
    df.collect()  # the plan that ran, after adaptive execution
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def prices(spark):
    rows = [(f"T{t}", (dt.date(2024, 1, 1) + dt.timedelta(days=i)).isoformat(), 10.0 + t + i % 7) for t in range(20) for i in range(40 + t)]
    return spark.createDataFrame(rows, "ticker string, date string, close double").withColumns({c: F.col("close") for c in ("rsi", "ma_7", "ma_30", "daily_return")})


@pytest.fixture(scope="module")
def bucketed(spark, prices, tmp_path_factory):
    assert tables.bucketed_table(prices, "prices_in_buckets", str(tmp_path_factory.mktemp("buckets") / "t"), rows_per_bucket=200) == 5
    return "prices_in_buckets"


def test_bucketed_table_needs_no_shuffle(spark, prices, bucketed):
    found = tables.latest_prices(spark, bucketed).drop("ma_30")
    grouped = spark.table(bucketed).groupBy("ticker").agg(F.max_by("close", "date"))
    assert "Exchange" not in plan_of(grouped)
    window = indicators.moving_averages(spark.table(bucketed), windows=[5])
    assert "Exchange" not in plan_of(window)
    assert {(r.ticker, r.date, r.close) for r in found.collect()} == {(r.ticker, r.date, r.close) for r in latest.latest_values(prices).collect()}


def test_look_up_prunes_buckets(spark, bucketed):
    # A scan without a use for the buckets' partitioning prunes them too, but does not say so.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    plan = tables.stock_data(spark, "T3", 5, bucketed)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 5" in plan
    assert [r.date for r in tables.stock_data(spark, "T3", 2, bucketed).collect()] == ["2024-02-12", "2024-02-11"]


def test_table_of_a_huge_ticker_gets_no_buckets(spark, prices, tmp_path):
    assert tables.bucketed_table(prices, "prices_unbucketed", str(tmp_path / "t"), most_rows_of_ticker=50) == 0
    assert spark.table("prices_unbucketed").count() == prices.count()


def test_empty_bucketed_table(spark, prices, tmp_path):
    assert tables.bucketed_table(prices.limit(0), "no_prices", str(tmp_path / "t")) == 1
    assert spark.table("no_prices").isEmpty()


def test_kept_result_is_read_until_the_table_changes(spark, prices, tmp_path):
    tables.replace_table(prices, "kept_prices", str(tmp_path / "t"))
    root, made = str(tmp_path / "kept"), []

    def compute():
        made.append(1)
        return spark.table("kept_prices").where("ticker = 'T1'")

    def read():
        return cache.kept(spark, "rows", {"ticker": "T1"}, tables.table_version(spark, "kept_prices"), compute, root).count()

    assert read() == read() == 41 and len(made) == 1
    cache.kept(spark, "rows", {"ticker": "T2"}, tables.table_version(spark, "kept_prices"), compute, root)
    assert len(made) == 2
    tables.replace_table(prices.where("date < '2024-01-11'"), "kept_prices", str(tmp_path / "t"))
    spark.catalog.refreshTable("kept_prices")
    assert read() == read() == 10 and len(made) == 3
    folders = [os.listdir(tmp_path / "kept" / "kept-rows" / x) for x in os.listdir(tmp_path / "kept" / "kept-rows")]
    assert sorted(map(len, folders)) == [1, 1]  # the stale version is gone


def test_kept_stock_data(spark, prices, tmp_path):
    tables.replace_table(prices, "kept_stock", str(tmp_path / "t"))
    rows = [cache.kept_stock_data(spark, "T5", 3, "kept_stock", str(tmp_path / "kept")).collect() for _ in range(2)]
    assert rows[0] == rows[1] == tables.stock_data(spark, "T5", 3, "kept_stock").collect()


def test_interrupted_write_is_done_again(spark, prices, tmp_path):
    root = str(tmp_path / "kept")
    cache.kept(spark, "rows", {}, "v1", lambda: prices, root)
    (folder,) = (tmp_path / "kept" / "kept-rows").iterdir()
    os.remove(folder / "v1" / "_SUCCESS")
    assert cache.kept(spark, "rows", {}, "v1", lambda: prices.limit(2), root).count() == 2


def test_bar_files(spark, bars, tmp_path):
    rows = shape.rename_all(bars(**{"A": range(1, 30), "B C": [1, 2], "X/Y+%": [5.0]}), RAW_COLUMNS)
    write_bar_files(rows.limit(3), str(tmp_path / "flat"))
    manifest = write_bar_files(rows.coalesce(1), str(tmp_path / "flat"), max_rows_per_file=10)
    names = sorted(x for x in os.listdir(tmp_path / "flat") if not x.startswith("."))
    assert names == ["A.2_stock_data.csv", "A.3_stock_data.csv", "A_stock_data.csv", "B C_stock_data.csv", "X%2FY+%25_stock_data.csv"]
    assert sorted(r.file for r in manifest.collect()) == names
    assert {(r.series, r.n) for r in manifest.groupBy("series").agg(F.sum("n_rows").alias("n")).collect()} == {("A", 29), ("B C", 2), ("X/Y+%", 1)}
    assert sorted(map(tuple, read_bar_files(spark, str(tmp_path / "flat")).collect())) == sorted(map(tuple, rows.collect()))


def test_wide_vendor_table(spark):
    day = dt.date(2024, 1, 2)
    wide = spark.createDataFrame(
        [(day, 1.0, 2.0, 7.0, None), (day + dt.timedelta(1), None, None, None, 4.0)],
        "Date date, `Close|A` double, `Open|A` double, `Volume|A` double, `Close|B|C` double",
    ).withColumn("other", F.lit(1))
    rows = shape.normalise_vendor_wide(wide)
    assert rows.columns == RAW_COLUMNS and rows.schema["Volume"].dataType.typeName() == "long"
    assert sorted(map(tuple, rows.collect())) == [("A", day, 2.0, None, None, 1.0, 7), ("B|C", day + dt.timedelta(1), None, None, None, 4.0, None)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Exchange" not in plan
    assert shape.normalise_vendor_wide(wide.select("Date")).isEmpty()


def test_many_tickers_as_few(spark, monkeypatch):
    pick = random.Random(3)
    tickers = ["".join(pick.choices("ABCÉ", k=pick.randint(1, 4))) for _ in range(60)] + ["", "abc"]
    for listed in (tickers[:-2], tickers):
        texts = ["".join(pick.choices("abcé x", k=pick.randint(0, 12))) for _ in range(150)] + [None, "", "ABC É"]
        messages = spark.createDataFrame([(t,) for t in texts], "text string")
        few = [r[0] for r in messages.select(intent.mentioned_ticker(F.col("text"), listed)).collect()]
        monkeypatch.setattr(intent, "FEW_TICKERS", 0)
        many = [r[0] for r in messages.select(intent.mentioned_ticker(F.col("text"), listed)).collect()]
        monkeypatch.undo()
        assert few == many and any(few)


def test_ten_thousand_tickers(spark):
    tickers = [f"{i:05d}" for i in range(10_000)]
    messages = spark.createDataFrame([("about 04711 and 00042",), ("9999 only",), (None,)], "text string")
    tagged = messages.select(intent.message_intent(F.col("text"), tickers).alias("i"), intent.mentioned_ticker(F.col("text"), tickers).alias("t"))
    assert [tuple(r) for r in tagged.collect()] == [("prediction", "00042"), ("chat", None), ("chat", None)]


@pytest.mark.parametrize("parts", [1, 7])
def test_positions(spark, parts):
    pick = random.Random(1)
    rows = [(pick.choice([None, "a", "b"]), pick.randint(0, 30), i) for i in range(500)] + [("b", 7, 1)] * 200
    df = spark.createDataFrame(rows, "s string, t int, _part int").repartition(parts)
    out = positions.add_positions(df, ["s", "t", "_part"], "at", start=0)
    assert out.columns == ["s", "t", "_part", "at"]
    got = sorted(out.collect(), key=lambda r: r["at"])
    assert [r["at"] for r in got] == list(range(700))
    key = lambda r: (r[0] is not None, r[0] or "", r[1], r[2])
    assert [key(r) for r in got] == sorted(map(key, rows))
    assert positions.add_positions(df.limit(0), ["s"]).isEmpty()


def test_positions_do_not_gather_ties(spark):
    """Rows that are all alike still spread over partitions, and no window holds the rows."""
    df = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("x"))
    out = positions.add_positions(df, ["x"])
    assert out.agg(F.countDistinct("position"), F.min("position"), F.max("position")).first()[:] == (20_000, 1, 20_000)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_sampled_split(spark):
    rows = spark.range(20_000).select(F.col("id"), (F.col("id") % 2).alias("label"))
    first = splits.sampled_split(rows, ["id"])
    shares = {r["label"]: r["share"] for r in first.groupBy("label").agg(F.avg((F.col("split") == "train").cast("double")).alias("share")).collect()}
    assert all(abs(x - 0.8) <= 4 * (0.8 * 0.2 / 10_000) ** 0.5 for x in shares.values())
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
    half = splits.sampled_split(rows.where("id < 9000").repartition(3), ["id"])
    sides = lambda df: {r["id"]: r["split"] for r in df.where("id < 9000").collect()}
    assert sides(first) == sides(half)
    assert sides(splits.sampled_split(rows, ["id"], seed=1)) != sides(first)


def test_derived_rows_of_a_bucketed_table_are_not_shuffled(spark, prices, tmp_path):
    """Windows run on the placed rows and write one file a bucket; the rows are those made of the whole frame."""
    plans = []

    def derive(rows):
        out = indicators.moving_averages(rows.drop("ma_7"), windows=[7])
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    for most, folder in ((5_000_000, "placed"), (50, "unbucketed")):
        tables.bucketed_table(prices, f"prices_{folder}", str(tmp_path / folder), rows_per_bucket=200, most_rows_of_ticker=most, derive=derive)
        want = indicators.moving_averages(prices.drop("ma_7"), windows=[7])
        assert sorted(spark.table(f"prices_{folder}").select(*want.columns).collect()) == sorted(want.collect())
    assert plans[0].count("Exchange") == 1 and len(list((tmp_path / "placed").glob("*.parquet"))) <= 5
    assert "Exchange" not in plan_of(spark.table("prices_placed").groupBy("ticker").count())
