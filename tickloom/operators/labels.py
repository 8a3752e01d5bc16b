"""Composite score and High/Medium/Low labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scores import composite_score, grade, rsi_zone
from tickloom.schema import CLASSIFIER_FEATURES


def add_composite_score(df: DataFrame) -> DataFrame:
    score = composite_score(
        *[F.col(c) for c in ("total_return", "ma7_vs_ma30", "ma30_vs_ma90", "rsi", "volatility", "sharpe_ratio")]
    )
    return df.withColumn("composite_score", score)


def add_labels(df: DataFrame) -> DataFrame:
    """Adds score and label, and keeps rows that have every model feature."""
    labelled = add_composite_score(df).withColumn("label", grade(F.col("composite_score")))
    return labelled.na.drop(subset=[*CLASSIFIER_FEATURES, "label"])


def add_rsi_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("rsi_zone", rsi_zone(F.col("rsi")))
