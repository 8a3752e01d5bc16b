"""Rolling indicators over price bars: moving averages, RSI, volatility, daily
return and Sharpe ratio.

Frames count rows of a series in date order and are partial at its start.
Rows with missing prices keep their place in the frames; `drop_incomplete`
removes them afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.operators.segments import SegmentLimits, SeriesLayout, lay_out

_HELPERS = ("_previous", "_gain", "_loss", "_avg_gain", "_avg_loss", "_mean_return", "_std_return")


def _with_changes(layout: SeriesLayout, close: str) -> DataFrame:
    """Previous close, and the gain and loss against it (0 where unknown)."""
    df = layout.df.withColumn("_previous", F.lag(close, 1).over(layout.ordered))
    change = F.col(close) - F.col("_previous")
    return df.withColumns(
        {
            "_gain": F.when(change > 0, change).otherwise(F.lit(0.0)),
            "_loss": F.when(change < 0, -change).otherwise(F.lit(0.0)),
        }
    )


def _rsi(avg_gain: Column, avg_loss: Column) -> Column:
    strength = F.when(avg_loss == 0, F.lit(100.0)).otherwise(F.try_divide(avg_gain, avg_loss))
    return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + strength)


def _daily_return(close: str) -> Column:
    return F.try_divide(F.col(close) - F.col("_previous"), F.col("_previous"))


def _sharpe(mean: Column, std: Column) -> Column:
    return F.when(std == 0, F.lit(0.0)).otherwise(F.try_divide(mean, std))


def _averages(layout: SeriesLayout, windows, close: str) -> dict[str, Column]:
    return {f"MA_{n}": F.avg(close).over(layout.last_rows(n)) for n in windows}


def moving_averages(
    df: DataFrame, windows=schema.MA_WINDOWS, close: str = "close", limits: SegmentLimits | None = None, **keys
) -> DataFrame:
    """Adds MA_n, the mean close over the last n rows, for each n."""
    layout = lay_out(df, before=max(windows) - 1, limits=limits, **keys)
    return layout.finish(layout.df.withColumns(_averages(layout, windows, close)))


def previous_close(df: DataFrame, close: str = "close", limits: SegmentLimits | None = None, **keys) -> DataFrame:
    """Adds the previous close and the change against it."""
    layout = lay_out(df, before=1, limits=limits, **keys)
    out = layout.df.withColumn("prev_close", F.lag(close, 1).over(layout.ordered))
    return layout.finish(out.withColumn("change", F.col(close) - F.col("prev_close")))


def rsi(
    df: DataFrame, window: int = schema.RSI_WINDOW, close: str = "close", limits: SegmentLimits | None = None, **keys
) -> DataFrame:
    """Adds RSI from simple averages of gains and losses over the window."""
    layout = lay_out(df, before=window, limits=limits, **keys)
    frame = layout.last_rows(window)
    out = _with_changes(layout, close).withColumns(
        {"_avg_gain": F.avg("_gain").over(frame), "_avg_loss": F.avg("_loss").over(frame)}
    )
    out = out.withColumn("RSI", _rsi(F.col("_avg_gain"), F.col("_avg_loss"))).drop(*_HELPERS)
    return layout.finish(out)


def volatility(
    df: DataFrame,
    window: int = schema.VOLATILITY_WINDOW,
    close: str = "close",
    limits: SegmentLimits | None = None,
    **keys,
) -> DataFrame:
    """Adds the sample standard deviation of the close over the window."""
    layout = lay_out(df, before=window - 1, limits=limits, **keys)
    return layout.finish(layout.df.withColumn("Volatility", F.stddev_samp(close).over(layout.last_rows(window))))


def returns(
    df: DataFrame,
    window: int = schema.SHARPE_WINDOW,
    close: str = "close",
    limits: SegmentLimits | None = None,
    **keys,
) -> DataFrame:
    """Adds the daily return and its Sharpe ratio over the window."""
    layout = lay_out(df, before=window, limits=limits, **keys)
    frame = layout.last_rows(window)
    out = layout.df.withColumn("_previous", F.lag(close, 1).over(layout.ordered))
    out = out.withColumn("Daily_Return", _daily_return(close))
    out = out.withColumns(
        {
            "_mean_return": F.avg("Daily_Return").over(frame),
            "_std_return": F.stddev_samp("Daily_Return").over(frame),
        }
    )
    out = out.withColumn("Sharpe_Ratio", _sharpe(F.col("_mean_return"), F.col("_std_return")))
    return layout.finish(out.drop(*_HELPERS))


def indicators(
    df: DataFrame,
    ma_windows=schema.MA_WINDOWS,
    rsi_window: int = schema.RSI_WINDOW,
    volatility_window: int = schema.VOLATILITY_WINDOW,
    close: str = "close",
    limits: SegmentLimits | None = None,
    **keys,
) -> DataFrame:
    """All indicators of the feature table at once: one shuffle and one sort,
    with the lag in a first window pass and every frame in a second."""
    sharpe_window = schema.SHARPE_WINDOW
    reach = max(*ma_windows, volatility_window, rsi_window + 1, sharpe_window + 1) - 1
    layout = lay_out(df, before=reach, limits=limits, **keys)
    out = _with_changes(layout, close).withColumn("Daily_Return", _daily_return(close))
    out = out.withColumns(
        {
            **_averages(layout, ma_windows, close),
            "_avg_gain": F.avg("_gain").over(layout.last_rows(rsi_window)),
            "_avg_loss": F.avg("_loss").over(layout.last_rows(rsi_window)),
            "Volatility": F.stddev_samp(close).over(layout.last_rows(volatility_window)),
            "_mean_return": F.avg("Daily_Return").over(layout.last_rows(sharpe_window)),
            "_std_return": F.stddev_samp("Daily_Return").over(layout.last_rows(sharpe_window)),
        }
    )
    out = layout.finish(out)
    return out.select(
        *df.columns,
        *[f"MA_{n}" for n in ma_windows],
        _rsi(F.col("_avg_gain"), F.col("_avg_loss")).alias("RSI"),
        "Volatility",
        "Daily_Return",
        _sharpe(F.col("_mean_return"), F.col("_std_return")).alias("Sharpe_Ratio"),
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drops rows with a null or NaN in any column, prices included."""
    return df.na.drop()
