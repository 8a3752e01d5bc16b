"""The SQL serving table and the queries on it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom import schema
from tickloom.operators.latest import LATEST_COLUMNS, last_rows_of, latest_values, ordered_table, series_rows
from tickloom.operators.segments import SegmentLimits
from tickloom.sources.readers import read_serving


def create_table(spark: SparkSession, name: str = schema.SERVING_TABLE, location: str | None = None) -> None:
    """Creates the table if it does not exist. Spark tables have no primary
    key; uniqueness is a check in `operators.quality`."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.SERVING_SCHEMA)
    quoted = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{quoted}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def replace_table(df: DataFrame, name: str = schema.SERVING_TABLE, location: str | None = None) -> int:
    """Replaces the table with the frame and returns the number of rows,
    counted while writing.

    Rows are range-partitioned and sorted by ticker and date. File and
    row-group statistics then serve look-ups as an index would, and a ticker
    with very many rows spreads over several tasks.
    """
    seen = Observation()
    placed = df.repartitionByRange("ticker", "date").sortWithinPartitions("ticker", "date")
    # Counted after the exchange, whose sampling job would count rows twice.
    writer = placed.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return seen.get["n"]


def bucketed_table(
    df: DataFrame, name: str, location: str | None = None, rows_per_bucket: int = 200_000, most_rows_of_ticker: int = 5_000_000,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Replaces the table with the frame, in buckets by ticker, sorted by date within; returns the number of buckets.

    A look-up of a ticker reads one bucket, and windows, latest rows and counts
    per ticker need no shuffle, as an index on ticker and date would give. All
    rows of a bucket are read by one task then. So the number of buckets
    follows the rows, and a table in which a single ticker has more than
    `most_rows_of_ticker` rows gets no buckets (0): it is range-partitioned as
    by `replace_table`, whose long series the operators cut.

    The frame is read twice: stage it if it is costly. With `derive` the table holds what that makes of the frame: at most as many rows of a ticker, by windows
    per ticker and other steps that leave rows in their partition. It is then called on rows that lie in
    their buckets already, so that the frame is shuffled and not the wider rows made of it.
    """
    derive = derive or (lambda rows: rows)
    sizes = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    if (sizes["most"] or 0) > most_rows_of_ticker:
        replace_table(derive(df), name, location)
        return 0
    buckets = max(1, -(-(sizes["all"] or 0) // rows_per_bucket))
    if (sizes["most"] or 0) > SegmentLimits().max_rows:  # windows cut such series and deal their rows anew
        placed = derive(df).repartition(buckets, "ticker")
    else:
        placed = derive(df.repartition(buckets, "ticker"))
    writer = placed.sortWithinPartitions("ticker", "date").write.mode("overwrite").format("parquet").bucketBy(buckets, "ticker").sortBy("ticker", "date")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return buckets


def load_table(
    spark: SparkSession, path: str, name: str = schema.SERVING_TABLE, location: str | None = None
) -> int:
    """Loads the Parquet feature table into the serving table."""
    return replace_table(read_serving(spark, path), name, location)


def table_version(spark: SparkSession, name: str = schema.SERVING_TABLE) -> str:
    """Changes whenever the table is written: a digest of its files' names, sizes and times. Spark gives every write
    new file names."""
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    found = files.agg(F.count(F.lit(1)), F.coalesce(F.sum(each), F.lit(0)).cast("string")).first()
    return f"{found[0]}-{found[1].lstrip('-')}"


def all_rows(spark: SparkSession, name: str = schema.SERVING_TABLE) -> DataFrame:
    """The whole table ordered by ticker and date."""
    return ordered_table(spark.table(name))


def stock_data(spark: SparkSession, ticker: str, days: int = 30, name: str = schema.SERVING_TABLE) -> DataFrame:
    """The latest `days` rows of a ticker, newest first."""
    return last_rows_of(spark.table(name), ticker, days)


def stock_history(spark: SparkSession, ticker: str, name: str = schema.SERVING_TABLE) -> DataFrame:
    """All rows of a ticker, oldest first."""
    return series_rows(spark.table(name), ticker)


def latest_prices(spark: SparkSession, name: str = schema.SERVING_TABLE) -> DataFrame:
    """Price and main indicators at the latest date of every ticker."""
    return latest_values(spark.table(name), LATEST_COLUMNS)
