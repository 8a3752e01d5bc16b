"""From raw bars to the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom import schema
from tickloom.operators.indicators import drop_incomplete, indicators
from tickloom.operators.segments import SegmentLimits
from tickloom.operators.sizing import settle
from tickloom.session import scratch_scope
from tickloom.sources.readers import read_bars, read_features
from tickloom.sources.writers import write_features


def feature_table(
    bars: DataFrame,
    ma_windows=schema.MA_WINDOWS,
    rsi_window: int = schema.RSI_WINDOW,
    volatility_window: int = schema.VOLATILITY_WINDOW,
    limits: SegmentLimits | None = None,
    **keys,
) -> DataFrame:
    """All indicators, then only complete rows."""
    return drop_incomplete(indicators(bars, ma_windows, rsi_window, volatility_window, limits=limits, **keys))


def run_preprocessing(
    spark: SparkSession, bars_directory: str, output_path: str, limits: SegmentLimits | None = None, layout: str = "files"
) -> DataFrame:
    """CSV bars to a Parquet feature table; returns the table read back, so
    looking at it does not compute it again. `layout` is "files" for one file
    per ticker, "folders" for what `run_collection` writes."""
    with scratch_scope(spark):
        # Large text is parsed once; counting rows then reads one column.
        bars = settle(read_bars(spark, bars_directory, layout), "bars")
        write_features(feature_table(bars, limits=limits), output_path)
    return read_features(spark, output_path)
