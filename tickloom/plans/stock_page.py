"""The data behind the stock page: metrics, table, indicators and forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.functions.intent import mentioned_ticker, message_intent
from tickloom.functions.scalar import fixed, money, percent_text, thousands
from tickloom.operators.forecast import drift_forecast
from tickloom.operators.latest import latest_rows

# Lengths of the page's tables, their columns and display names.
PAGE_DAYS = 180
TABLE_ROWS = 20
TABLE_COLUMNS = ("date", "open", "high", "low", "close", "volume", "daily_return")
ANSWER_ROWS = 10
ANSWER_COLUMNS = {
    "date": "Date",
    "close": "Close",
    "rsi": "RSI",
    "ma_7": "MA7",
    "ma_30": "MA30",
    "daily_return": "Daily Return",
}


def page_rows(df: DataFrame, days: int = PAGE_DAYS, series: str = schema.SERIES) -> DataFrame:
    """The latest `days` rows of every series, which the page shows."""
    return latest_rows(df, days, series)


def page_metrics(df: DataFrame, series: str = schema.SERIES) -> DataFrame:
    """Price, volume, daily return and RSI of the latest row, as text."""
    return latest_rows(df, 1, series).select(
        series,
        money(F.col("close")).alias("price"),
        thousands(F.col("volume")).alias("volume"),
        percent_text(F.col("daily_return") * 100).alias("daily_return"),
        fixed(F.col("rsi"), 1).alias("rsi"),
    )


def page_table(df: DataFrame, days: int = PAGE_DAYS, series: str = schema.SERIES) -> DataFrame:
    """The latest 20 of the rows shown, newest first per series."""
    rows = latest_rows(df, min(TABLE_ROWS, days), series)
    return rows.select(series, *TABLE_COLUMNS).orderBy(series, F.desc("date"))


def answer_table(df: DataFrame, series: str = schema.SERIES) -> DataFrame:
    """The latest 10 rows under display names, for a data question."""
    rows = latest_rows(df, ANSWER_ROWS, series).select(series, *ANSWER_COLUMNS)
    return rows.withColumnsRenamed(ANSWER_COLUMNS)


def stock_page(df: DataFrame, board: DataFrame, steps: int = schema.FORECAST_STEPS, series: str = schema.SERIES, **forecast) -> DataFrame:
    """One row per series: the metrics of its latest row, its grade and
    confidence from `board` (as `grade_board` gives them; null without), and the
    forecast prices as a list of display text, nearest first."""
    prices = drift_forecast(df, steps=steps, series=series, **forecast)
    step = F.struct("step", money(F.col("price")).alias("text"))
    prices = prices.groupBy(series).agg(F.transform(F.array_sort(F.collect_list(step)), lambda x: x["text"]).alias("forecast"))
    percents = [f"{g.lower()}_percent" for g in schema.GRADES]
    return page_metrics(df, series).join(board.select(series, "grade", *percents), series, "left").join(prices, series, "left")


def tag_messages(df: DataFrame, text: str = "text", **words) -> DataFrame:
    """Adds `intent` and `ticker` to a table of messages."""
    tickers = {"tickers": words["tickers"]} if "tickers" in words else {}
    return df.withColumns(
        {
            "intent": message_intent(F.col(text), **words),
            "ticker": mentioned_ticker(F.col(text), **tickers),
        }
    )
