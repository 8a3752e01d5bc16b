"""Column names, table schemas and default parameters."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = "ticker"
TIME = "date"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("Ticker", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
PRICE_COLUMNS = ["Open", "High", "Low", "Close", "Volume"]

# Indicator columns of the feature table, in its column order.
INDICATOR_COLUMNS = ["MA_7", "MA_30", "MA_90", "RSI", "Volatility", "Daily_Return", "Sharpe_Ratio"]
FEATURE_TABLE_COLUMNS = RAW_COLUMNS + INDICATOR_COLUMNS

SERVING_TABLE = "stock_data"
# Dates in the serving table are ISO strings, so text order is date order.
SERVING_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
    + [T.StructField(name.lower(), T.DoubleType()) for name in INDICATOR_COLUMNS]
)

# Defaults of the indicator and forecast jobs.
DEFAULT_TICKERS = ("AAPL", "MSFT", "GOOGL", "AMZN", "TSLA")
MA_WINDOWS = (7, 30, 90)
RSI_WINDOW = 14
VOLATILITY_WINDOW = 30
SHARPE_WINDOW = 30
LAG_COLUMNS = ("Close", "Open", "High", "Low", "Volume")
LAG_DEPTH = 30
FORECAST_STEPS = 7
RECENT_ROWS = 30
MIN_SERIES_ROWS = 200
MIN_TABLE_ROWS = 1000

# Order of the classifier's feature vector, and its classes.
CLASSIFIER_FEATURES = ["rsi", "ma_7", "ma_30", "ma_90", "volatility", "daily_return", "sharpe_ratio"]
GRADES = ("High", "Medium", "Low")


def find_column(df, name: str) -> str:
    """The frame's own spelling of a column name (names are case-insensitive)."""
    for column in df.columns:
        if column.lower() == name.lower():
            return column
    raise ValueError(f"no column {name!r} in {df.columns}")
