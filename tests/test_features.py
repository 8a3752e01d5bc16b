import pytest
from conftest import column
from pyspark.sql import functions as F

from tickloom.functions import scalar, scores
from tickloom.functions.intent import mentioned_ticker, message_intent
from tickloom.operators import features, labels
from tickloom.plans.stock_page import tag_messages


def test_lags_and_target(bars):
    out = features.lag_features(bars(A=range(10, 50)))
    assert len([c for c in out.columns if "_lag_" in c]) == 150
    rows = out.orderBy("date").collect()
    assert len(rows) == 40 - 31
    assert (rows[0]["close"], rows[0]["Close_lag_1"], rows[0]["Close_lag_30"], rows[0]["target"]) == (40, 39, 10, 41)
    assert rows[0]["Volume_lag_2"] == rows[0]["volume"] - 2


def test_horizon(bars):
    assert column(features.lag_features(bars(A=range(10, 20)), depth=2, horizon=7), "target") == [19]


def test_total_return_and_percent_change(bars):
    df = bars(A=[10, 11, 12, 9, 20])
    assert column(features.total_return(df), "total_return") == pytest.approx([0, 0.1, 0.2, -0.1, 1.0])
    got = column(features.percent_change(df, windows=(2,)), "return_2d")
    assert got[:2] == [None, None] and got[2:] == pytest.approx([0.2, 9 / 11 - 1, 20 / 12 - 1])


def test_full_rolling_mean_waits_for_the_window(bars):
    df = bars(A=range(20)).withColumn("rsi", F.col("close"))
    got = column(features.rolling_mean_full(df), "avg_rsi")
    assert got[:13] == [None] * 13 and got[13] == pytest.approx(6.5)


def values(spark, expression, schema="x double", rows=((1.0,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expression).collect()]


def test_clamp_keeps_missing_values_missing(spark):
    rows = [(None,), (float("nan"),), (-3.0,), (4.0,), (30.0,)]
    assert values(spark, scalar.clamp(F.col("x"), 0, 10), rows=rows) == [None, None, 0.0, 4.0, 10.0]


SCORE = "total double, short double, long double, rsi double, vol double, sharpe double"


@pytest.mark.parametrize(
    "row, want",
    [
        ((0.05, 0.1, 0.1, 50.0, 5.0, 0.2), round(5 * 0.3 + 8 * 0.2 + 10 * 0.15 + 9 * 0.15 + 6 * 0.2, 2)),
        ((9.0, -0.1, -0.1, 80.0, 100.0, 5.0), round(10 * 0.3 + 2 * 0.2 + 4 * 0.15 + 0 + 10 * 0.2, 2)),
        ((-1.0, 0.1, -0.1, None, None, None), round(0 + 5 * 0.2 + 10 * 0.15 + 8 * 0.15 + 5 * 0.2, 2)),
        ((None, None, None, 50.0, 5.0, 0.2), None),
    ],
)
def test_composite_score(spark, row, want):
    score = scores.composite_score(*[F.col(c) for c in ("total", "short", "long", "rsi", "vol", "sharpe")])
    (got,) = values(spark, score, SCORE, [row])
    assert got == want if want is None else got == pytest.approx(want)


def test_grades_and_zones(spark):
    rows = [(7.0,), (6.99,), (4.0,), (3.99,), (None,)]
    assert values(spark, scores.grade(F.col("x")), rows=rows) == ["High", "Medium", "Medium", "Low", "Low"]
    rows = [(70.0,), (30.0,), (50.0,)]
    assert values(spark, scores.rsi_zone(F.col("x")), rows=rows) == ["overbought", "oversold", "neutral"]


def test_labels_drop_rows_without_features(spark):
    names = ["total_return", "ma7_vs_ma30", "ma30_vs_ma90", "rsi", "ma_7", "ma_30", "ma_90", "volatility",
             "daily_return", "sharpe_ratio"]
    rows = [tuple([0.1] * 10), tuple([0.1] * 9 + [None])]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    out = labels.add_labels(df).collect()
    assert len(out) == 1 and out[0]["label"] in ("High", "Medium", "Low")


@pytest.mark.parametrize(
    "text, intent, ticker",
    [
        ("Predict AAPL next week", "prediction", "AAPL"),
        ("show me tsla and msft", "data", "MSFT"),
        ("Tell me about GOOGL", "data", "GOOGL"),
        ("amzn?", "prediction", "AMZN"),
        ("what is a stock", "chat", None),
        ("price data", "prediction", None),
        ("some INFO please", "data", None),
        (None, "chat", None),
    ],
)
def test_intent(spark, text, intent, ticker):
    df = spark.createDataFrame([(text,)], "text string")
    row = df.select(message_intent(F.col("text")).alias("i"), mentioned_ticker(F.col("text")).alias("t")).first()
    assert (row["i"], row["t"]) == (intent, ticker)
    tagged = tag_messages(df).first()
    assert (tagged["intent"], tagged["ticker"]) == (intent, ticker)


def test_display_formats(spark):
    df = spark.createDataFrame([(1234567, 12.345, 0.0123)], "v long, p double, r double")
    row = df.select(
        scalar.thousands(F.col("v")), scalar.money(F.col("p")), scalar.percent_text(F.col("r") * 100), scalar.fixed(F.col("p"), 1)
    ).first()
    assert tuple(row) == ("1,234,567", "$12.35", "1.23%", "12.3")
