"""Data-quality checks. They report; they do not stop a job."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.functions.scalar import is_missing


def series_quality(
    df: DataFrame, min_rows: int = schema.MIN_SERIES_ROWS, series: str = schema.SERIES, time: str = schema.TIME
) -> DataFrame:
    """One row per series: too few rows, missing values, duplicate times,
    zero or negative closes, and whether all four checks pass.

    Rows are first combined per (series, time), so the shuffle spreads over
    times even if one series holds most rows; the second step counts groups.
    """
    missing = F.lit(False)
    for c in schema.PRICE_COLUMNS:
        missing = missing | is_missing(F.col(c))
    per_time = df.groupBy(series, time).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(missing).alias("missing"),
        F.count_if(F.col("close") <= 0).alias("not_positive"),
    )
    checked = per_time.groupBy(series).agg(
        F.sum("n").alias("n_rows"),
        (F.sum("n") < min_rows).alias("too_few_rows"),
        (F.sum("missing") > 0).alias("has_missing"),
        (F.max("n") > 1).alias("has_duplicate_dates"),
        (F.sum("not_positive") > 0).alias("has_bad_close"),
    )
    bad = F.col("too_few_rows") | F.col("has_missing") | F.col("has_duplicate_dates") | F.col("has_bad_close")
    return checked.withColumn("valid", ~bad)


def overall_quality(df: DataFrame, **options) -> DataFrame:
    """One row: whether every series passes every check."""
    verdict = series_quality(df, **options).agg(F.bool_and("valid").alias("all_valid"))
    return verdict.select(F.coalesce("all_valid", F.lit(True)).alias("all_valid"))


def missing_series(df: DataFrame, expected, series: str = schema.SERIES) -> DataFrame:
    """Expected series that do not occur. `expected` is a short list, so the
    scan is filtered by it before anything is shuffled."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], f"{series} string")
    found = df.filter(F.col(series).isin(*expected)).select(series).distinct()
    return wanted.join(found, series, "left_anti")


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required columns that the frame lacks; looks at the schema only."""
    present = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in present]


def enough_rows(df: DataFrame, minimum: int = schema.MIN_TABLE_ROWS) -> DataFrame:
    """One row: whether the table holds at least `minimum` rows."""
    return df.agg((F.count(F.lit(1)) >= minimum).alias("enough_rows"))


def prediction_contract(
    df: DataFrame,
    label: str = "predicted_label",
    probability: str = "probability",
    labels=schema.GRADES,
    tolerance: float = 0.001,
) -> DataFrame:
    """One row: predictions outside the label set, and class probabilities
    (array or ML vector) whose sum is off 1 by the tolerance or more."""
    if df.schema[probability].dataType.typeName() == "array":
        values = F.col(probability)
    else:
        values = vector_to_array(probability)
    total = F.aggregate(values, F.lit(0.0), lambda a, p: a + p)
    return df.agg(
        F.count_if(~F.col(label).isin(*labels) | F.col(label).isNull()).alias("bad_labels"),
        F.count_if(F.abs(total - 1) >= tolerance).alias("bad_sums"),
    )
