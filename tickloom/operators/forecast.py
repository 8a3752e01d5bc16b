"""Drift forecast: the last price grown by the recent mean return."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom import schema
from tickloom.functions.noise import normal
from tickloom.functions.scalar import add_days, money, short_date
from tickloom.operators.latest import latest_rows


def drift_forecast(
    df: DataFrame,
    steps: int = schema.FORECAST_STEPS,
    recent: int = schema.RECENT_ROWS,
    sigma: float = 0.01,
    seed: int = 42,
    decimals: int | None = 2,
    series: str = schema.SERIES,
    time: str = schema.TIME,
) -> DataFrame:
    """Prices for the next `steps` calendar days of every series.

    Each step multiplies the unrounded price by 1 + mean daily return of the
    latest `recent` rows + normal noise of deviation `sigma`; only the output
    is rounded (`decimals=None` keeps it unrounded). The noise depends on
    series, step and seed alone, so a repeated task gives the same prices.
    A series without rows has no forecast.
    """
    tail = latest_rows(df, recent, series, time)
    state = tail.groupBy(series).agg(
        F.max(time).alias("last_date"),
        F.max_by("close", time).alias("last_price"),
        F.avg("daily_return").alias("mean_return"),
    )
    stepped = state.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    growth = F.lit(1.0) + F.col("mean_return")
    if sigma:
        growth = growth + F.lit(sigma) * normal(F.col(series), F.col("step"), seed)
    path = Window.partitionBy(series).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    price = F.col("last_price") * F.product("_growth").over(path)
    return stepped.withColumn("_growth", growth).select(
        series,
        "step",
        add_days(F.col("last_date").cast("date"), F.col("step")).alias("forecast_date"),
        (price if decimals is None else F.round(price, decimals)).alias("price"),
    )


def forecast_table(df: DataFrame, series: str = schema.SERIES, **options) -> DataFrame:
    """The forecast as display text: `Jan 05` and `$12.34`."""
    prices = drift_forecast(df, series=series, **options)
    return prices.select(
        series, "step", short_date(F.col("forecast_date")).alias("day"), money(F.col("price")).alias("price")
    )
