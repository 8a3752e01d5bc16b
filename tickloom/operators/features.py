"""Lag matrix, target, and the classifier's per-series features."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.operators.segments import SegmentLimits, lay_out


def lag_columns(columns=schema.LAG_COLUMNS, depth: int = schema.LAG_DEPTH) -> list[str]:
    return [f"{c}_lag_{k}" for c in columns for k in range(1, depth + 1)]


def _lag_lists(df, columns, depth, horizon, close, limits, keys):
    """The frame with the last `depth` values of each column as lists, newest
    first, and the target; only rows without a missing value.

    Each lag is looked up once, for all columns together; a list collected over a
    sliding frame would be built anew for every row and column."""
    layout = lay_out(df, before=depth, after=horizon, limits=limits, **keys)
    w, lags = layout.ordered, [f"_lag_{k}" for k in range(1, depth + 1)]
    out = layout.df.withColumn("_now", F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]))
    out = out.withColumns({name: F.lag("_now", k).over(w) for k, name in enumerate(lags, 1)} | {"target": F.lead(close, horizon).over(w)})
    lists = {f"_lags_{i}": F.array(*[F.col(name)[f"c{i}"] for name in lags]) for i in range(len(columns))}
    out = layout.finish(out.withColumns(lists).drop("_now", *lags))
    clean = [~F.exists(name, lambda x: x.isNull() | F.isnan(x.cast("double"))) for name in lists]
    out = out.filter(reduce(lambda a, b: a & b, clean))
    return out.na.drop(subset=[*df.columns, "target"]), list(lists)


def lag_features(
    df: DataFrame,
    columns=schema.LAG_COLUMNS,
    depth: int = schema.LAG_DEPTH,
    horizon: int = 1,
    close: str = "close",
    limits: SegmentLimits | None = None,
    **keys,
) -> DataFrame:
    """Adds `{column}_lag_{k}` for k = 1..depth and `target`, the close
    `horizon` rows ahead, for all series in one window pass.

    Rows with a missing value in any column are dropped: the first `depth` and
    the last `horizon` of each series among them. One list per column is
    windowed and then taken apart.
    """
    out, lists = _lag_lists(df, columns, depth, horizon, close, limits, keys)
    lags = [F.get(name, F.lit(k)).alias(f"{c}_lag_{k + 1}") for name, c in zip(lists, columns) for k in range(depth)]
    return out.select(*df.columns, *lags, "target")


def lag_vectors(
    df: DataFrame,
    columns=schema.LAG_COLUMNS,
    depth: int = schema.LAG_DEPTH,
    horizon: int = 1,
    close: str = "close",
    limits: SegmentLimits | None = None,
    arrays: bool = False,
    **keys,
) -> DataFrame:
    """The lags of `lag_features` as one vector `features_raw`, in the order of
    its columns, and `target`; with `arrays` as an array `features` instead."""
    out, lists = _lag_lists(df, columns, depth, horizon, close, limits, keys)
    values = F.concat(*[F.col(name).cast("array<double>") for name in lists])
    named = {"features": values} if arrays else {"features_raw": array_to_vector(values)}
    return out.withColumns(named).drop(*lists)


def total_return(df: DataFrame, close: str = "close", limits: SegmentLimits | None = None, **keys) -> DataFrame:
    """Adds the return against the first close of the series."""
    layout = lay_out(df, firsts=(close,), limits=limits, **keys)
    out = layout.df.withColumn("_start", layout.first(close))
    out = out.withColumn("total_return", F.try_divide(F.col(close) - F.col("_start"), F.col("_start")))
    return layout.finish(out.drop("_start"))


def percent_change(
    df: DataFrame, windows=(7, 30), close: str = "close", limits: SegmentLimits | None = None, **keys
) -> DataFrame:
    """Adds `return_{n}d`, the change against the close n rows before."""
    layout = lay_out(df, before=max(windows), limits=limits, **keys)
    changes = {f"return_{n}d": F.try_divide(F.col(close), F.lag(close, n).over(layout.ordered)) - 1 for n in windows}
    return layout.finish(layout.df.withColumns(changes))


def rolling_mean_full(
    df: DataFrame,
    column: str = "rsi",
    window: int = 14,
    name: str = "avg_rsi",
    limits: SegmentLimits | None = None,
    **keys,
) -> DataFrame:
    """Adds a rolling mean that is null until the window holds `window` values."""
    layout = lay_out(df, before=window - 1, limits=limits, **keys)
    frame = layout.last_rows(window)
    mean = F.when(F.count(column).over(frame) == window, F.avg(column).over(frame))
    return layout.finish(layout.df.withColumn(name, mean))


def trend_ratios(df: DataFrame) -> DataFrame:
    """Adds the relative distance of MA 7 to MA 30 and of MA 30 to MA 90."""
    return df.withColumns(
        {
            "ma7_vs_ma30": F.try_divide(F.col("ma_7") - F.col("ma_30"), F.col("ma_30")),
            "ma30_vs_ma90": F.try_divide(F.col("ma_30") - F.col("ma_90"), F.col("ma_90")),
        }
    )


def classifier_features(
    df: DataFrame, close: str = "close", limits: SegmentLimits | None = None, **keys
) -> DataFrame:
    """Total return, 7- and 30-row returns, trend ratios and the 14-row mean
    RSI for all series, with one shuffle and one sort."""
    layout = lay_out(df, before=30, firsts=(close,), limits=limits, **keys)
    w, frame = layout.ordered, layout.last_rows(14)
    out = layout.df.withColumns(
        {
            "_start": layout.first(close),
            "_week": F.lag(close, 7).over(w),
            "_month": F.lag(close, 30).over(w),
            "_known": F.count("rsi").over(frame),
            "_mean": F.avg("rsi").over(frame),
        }
    )
    out = layout.finish(out).withColumns(
        {
            "total_return": F.try_divide(F.col(close) - F.col("_start"), F.col("_start")),
            "return_7d": F.try_divide(F.col(close), F.col("_week")) - 1,
            "return_30d": F.try_divide(F.col(close), F.col("_month")) - 1,
            "avg_rsi": F.when(F.col("_known") == 14, F.col("_mean")),
        }
    )
    return trend_ratios(out.drop("_start", "_week", "_month", "_known", "_mean"))
