"""Latest rows and histories of series, and plain counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickloom import schema
from tickloom.operators.positions import add_positions
from tickloom.operators.segments import SegmentLimits, lay_out

LATEST_COLUMNS = ("close", "rsi", "ma_7", "ma_30", "daily_return")


def series_rows(df: DataFrame, value: str, series: str = schema.SERIES, time: str = schema.TIME) -> DataFrame:
    """All rows of one series, oldest first."""
    return df.filter(F.col(series) == value).orderBy(time)


def last_rows_of(
    df: DataFrame, value: str, n: int = 30, ascending: bool = False, series: str = schema.SERIES, time: str = schema.TIME
) -> DataFrame:
    """The latest n rows of one series, newest first unless `ascending`."""
    newest = df.filter(F.col(series) == value).orderBy(F.desc(time)).limit(n)
    return newest.orderBy(time) if ascending else newest


def latest_rows(
    df: DataFrame,
    n: int = 1,
    series: str = schema.SERIES,
    time: str = schema.TIME,
    limits: SegmentLimits | None = None,
) -> DataFrame:
    """The latest n rows of every series.

    Spark limits each group to n rows before the shuffle, so a long series
    reaches its task as at most n rows from each scan task. It does so up to a
    configured n; beyond that rows are picked by their position in the series.
    """
    if n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        rank = F.row_number().over(Window.partitionBy(series).orderBy(F.desc(time)))
        return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    layout = lay_out(df, series=series, time=time, limits=limits)
    out = layout.df.withColumns({"_position": layout.position(), "_length": layout.length()})
    return layout.finish(out).filter(F.col("_position") > F.col("_length") - n).drop("_position", "_length")


def latest_values(
    df: DataFrame, columns=LATEST_COLUMNS, series: str = schema.SERIES, time: str = schema.TIME
) -> DataFrame:
    """Chosen columns at the latest time of every series, ordered by series.

    All `max_by` buffers see the same rows in the same order, so on equal
    times they pick the same row. One hash aggregate, combined before the
    shuffle, and no sort of the input: ISO date strings compare as dates,
    since aggregates over strings would sort.
    """
    kind = df.select(time).schema[0].dataType
    key = F.col(time).cast("date") if isinstance(kind, T.StringType) else F.col(time)
    return (
        df.groupBy(series)
        .agg(F.max(key).cast(kind).alias(time), *[F.max_by(c, key).alias(c) for c in columns])
        .orderBy(series)
    )


def recent_mean(
    df: DataFrame,
    column: str = "daily_return",
    n: int = schema.RECENT_ROWS,
    name: str = "mean_return",
    series: str = schema.SERIES,
    time: str = schema.TIME,
) -> DataFrame:
    """Mean of a column over the latest n rows of every series."""
    return latest_rows(df, n, series, time).groupBy(series).agg(F.avg(column).alias(name))


def distinct_series(df: DataFrame, series: str = schema.SERIES) -> DataFrame:
    return df.select(series).distinct()


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, column: str, values) -> DataFrame:
    """Rows per listed value, 0 for values that do not occur."""
    counts = df.agg(*[F.count_if(F.col(column) == v).alias(f"n{i}") for i, v in enumerate(values)])
    pairs = [F.struct(F.lit(v).alias(column), F.col(f"n{i}").alias("n")) for i, v in enumerate(values)]
    return counts.select(F.inline(F.array(*pairs)))


def ordered_table(df: DataFrame, series: str = schema.SERIES, time: str = schema.TIME) -> DataFrame:
    """The whole table by series and time, as a range-partitioned sort."""
    return df.orderBy(series, time)


def numbered_table(df: DataFrame, series: str = schema.SERIES, time: str = schema.TIME, name: str = "position") -> DataFrame:
    """The whole table with the place of each row by series and time, from 1, without a window that holds it all."""
    return add_positions(df, [series, time], name)


def preview(df: DataFrame, columns=None, n: int = 5) -> DataFrame:
    """A few rows to look at."""
    return (df.select(*columns) if columns else df).limit(n)


def concatenate(frames) -> DataFrame:
    """UNION ALL by column name, keeping duplicates."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
