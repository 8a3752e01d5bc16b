"""Readers for raw bars and feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schema
from tickloom.operators.shape import serving_shape

BAR_FILES = "*_stock_data.csv"


def read_bar_files(spark: SparkSession, directory: str) -> DataFrame:
    """All `<ticker>_stock_data.csv` files of a directory in one scan."""
    return _read(spark, directory, schema.RAW_SCHEMA, BAR_FILES)


def read_bar_folders(spark: SparkSession, directory: str) -> DataFrame:
    """Bars written by `write_bar_folders`: one folder per ticker, whose name
    gives the ticker, so a filter on it skips the other folders."""
    return _read(spark, directory, schema.RAW_SCHEMA, "*.csv")


#: Layouts of raw bars by name.
LAYOUTS = {"files": read_bar_files, "folders": read_bar_folders}


def read_bars(spark: SparkSession, directory: str, layout: str = "files") -> DataFrame:
    """Raw bars of a directory in one of the `LAYOUTS`."""
    return LAYOUTS[layout](spark, directory)


def _read(spark: SparkSession, directory: str, kinds: T.StructType, names: str) -> DataFrame:
    """CSV with an explicit schema, so no file is read to infer types and all
    files agree on them. No file, a header that does not match, a field that
    does not parse and a fractional volume are errors.

    Volumes may be written as whole floats, as they are where one is missing.
    """
    loose = T.StructType([T.StructField(f.name, T.DoubleType() if f.dataType == T.LongType() else f.dataType) for f in kinds])
    reader = spark.read.schema(loose).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    df = reader.option("pathGlobFilter", names).csv(directory)
    if not df.inputFiles():
        raise FileNotFoundError(f"no {names} in {directory}")
    whole = {
        f.name: F.when(F.col(f.name).isNull() | (F.col(f.name) == F.floor(f.name)), F.col(f.name).cast(f.dataType)).otherwise(
            F.raise_error(F.concat(F.lit(f"{f.name} is not whole: "), F.col(f.name).cast("string")))
        )
        for f in kinds
        if f.dataType == T.LongType()
    }
    return df.withColumns(whole).select(*kinds.fieldNames())


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet feature table."""
    return spark.read.parquet(path)


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet feature table with lower-case names and ISO date strings."""
    return serving_shape(read_features(spark, path))
