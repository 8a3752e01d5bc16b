"""Takes vendor tables in: normalise, check, write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.latest import concatenate
from tickloom.operators.quality import series_quality
from tickloom.operators.shape import normalise_vendor_frame, normalise_vendor_wide
from tickloom.sources.readers import read_bar_folders
from tickloom.sources.writers import write_bar_folders


def run_collection(spark: SparkSession, vendor: DataFrame | Mapping[str, DataFrame], directory: str) -> DataFrame:
    """Writes the bars of each ticker as CSV and returns their quality report.
    As the report does not stop the job, bad series are written too. `vendor`
    is one wide table of all tickers (`Close|AAPL`), or a table per ticker."""
    if isinstance(vendor, DataFrame):
        rows = normalise_vendor_wide(vendor)
    else:
        rows = concatenate([normalise_vendor_frame(frame, ticker) for ticker, frame in vendor.items()])
    write_bar_folders(rows, directory)
    return series_quality(read_bar_folders(spark, directory))
