"""Loads the serving table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom import schema
from tickloom.operators.latest import preview
from tickloom.sources.tables import create_table, load_table, stock_data

PREVIEW_COLUMNS = ("ticker", "date", "close", "rsi", "ma_7")


def run_database_setup(
    spark: SparkSession,
    features_path: str,
    table: str = schema.SERVING_TABLE,
    ticker: str = schema.DEFAULT_TICKERS[0],
    location: str | None = None,
) -> tuple[int, DataFrame]:
    """Creates and loads the table; returns its row count and the latest five
    rows of one ticker."""
    create_table(spark, table, location)
    rows = load_table(spark, features_path, table, location)
    return rows, preview(stock_data(spark, ticker, 5, table), PREVIEW_COLUMNS)
