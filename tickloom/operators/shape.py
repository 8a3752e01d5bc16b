"""Projections: subset, rename, drop, select by pattern, normalise names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.functions.scalar import iso_date


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def rename_all(df: DataFrame, names) -> DataFrame:
    """New column names by position."""
    return df.toDF(*names)


def matching_columns(df: DataFrame, part: str) -> list[str]:
    """Columns whose name contains `part`."""
    return [c for c in df.columns if part in c]


def normalise_vendor_frame(df: DataFrame, ticker: str, date: str = "Date") -> DataFrame:
    """The seven raw columns, in order and typed, from a vendor table of one
    ticker: a constant `Ticker` is added, and of names with several levels
    (`Close|AAPL`) the first level counts."""
    flat = df.toDF(*[c.split("|")[0] for c in df.columns])
    return flat.select(
        F.lit(ticker).alias("Ticker"),
        F.col(date).cast("date").alias("Date"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.RAW_SCHEMA.fields[2:]],
    )


def normalise_vendor_wide(df: DataFrame, date: str = "Date", separator: str = "|") -> DataFrame:
    """The seven raw columns from one vendor table of many tickers, whose names have two levels (`Close|AAPL`): a row
    per date and ticker, in one scan and without a shuffle. Dates on which a ticker has no value at all give no row."""
    prices = [f.name for f in schema.RAW_SCHEMA.fields[2:]]
    split = [c.split(separator, 1) for c in df.columns if separator in c]
    known = {(field, ticker) for field, ticker in split if field in prices}
    kinds = {f.name: f.dataType for f in schema.RAW_SCHEMA.fields}

    def value(field: str, ticker: str):
        found = F.col(f"`{field}{separator}{ticker}`") if (field, ticker) in known else F.lit(None)
        return found.cast(kinds[field]).alias(field)

    tickers = sorted({ticker for _, ticker in known})
    rows = [F.struct(F.lit(t).alias("Ticker"), F.col(date).cast("date").alias("Date"), *[value(p, t) for p in prices]) for t in tickers]
    if not rows:
        return df.sparkSession.createDataFrame([], schema.RAW_SCHEMA)
    return df.select(F.inline(F.array(*rows))).na.drop("all", subset=prices)


def serving_shape(df: DataFrame) -> DataFrame:
    """Lower-case names and ISO date strings, as in the serving table."""
    lower = lower_names(df)
    return lower.withColumn("date", iso_date(F.col("date")))
