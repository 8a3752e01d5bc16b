"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schema import find_column
from tickloom.session import scratch_path

FOLDER = "_of"


def write_features(df: DataFrame, path: str) -> None:
    """Overwrite a Parquet table, without a success marker file.

    Tasks write what they hold: the indicator job has already placed and
    sorted rows by series and date, so row-group statistics are narrow.
    """
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)


def write_bar_folders(df: DataFrame, directory: str, series: str = "Ticker", max_rows_per_file: int = 5_000_000) -> None:
    """CSV with a header, one folder per series.

    The rebalance groups rows by series but splits a group that is too large
    for one task, and `max_rows_per_file` bounds the files.
    """
    key = find_column(df, series)
    (
        df.hint("rebalance", key)
        .write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(key)
        .csv(directory)
    )


def write_bar_files(
    df: DataFrame, directory: str, series: str = "Ticker", max_rows_per_file: int = 5_000_000, suffix: str = "_stock_data.csv"
) -> DataFrame:
    """A flat directory of CSV files `<ticker>_stock_data.csv` with a header, replacing what it held; returns the
    manifest: `series`, `file` and `n_rows`.

    One job writes the files of all tickers, into folders per ticker next to the
    directory; a rebalance splits a ticker that is too large for one task, and
    `max_rows_per_file` bounds files. A listing then gives the names: the files of
    a ticker after the first are `<ticker>.2_stock_data.csv` and so on. Tickers are
    escaped as Spark escapes folder names. The manifest is read from the files.
    """
    spark = df.sparkSession
    key = find_column(df, series)
    parts = scratch_path(spark, "bar-files")
    (
        df.withColumn(FOLDER, F.col(key)).hint("rebalance", FOLDER)
        .write.mode("overwrite").option("header", True).option("maxRecordsPerFile", max_rows_per_file).partitionBy(FOLDER).csv(parts)
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    target, source = path(directory), path(parts)
    conf = spark._jsc.hadoopConfiguration()
    files, to = source.getFileSystem(conf), target.getFileSystem(conf)
    to.delete(target, True)
    to.mkdirs(target)
    # Only names pass here, one per file; the parts lie on the same file system or are copied.
    listed, seen = files.listFiles(source, True), {}
    while listed.hasNext():
        part = listed.next().getPath()
        if part.getName().startswith("part-"):
            ticker = part.getParent().getName().split("=", 1)[1]
            seen[ticker] = seen.get(ticker, 0) + 1
            number = "" if seen[ticker] == 1 else f".{seen[ticker]}"
            named = path(target, path(None, None, f"{ticker}{number}{suffix}"))
            if not files.rename(part, named):
                spark._jvm.org.apache.hadoop.fs.FileUtil.copy(files, part, to, named, True, conf)
    files.delete(source, True)
    rows = spark.read.option("header", True).option("pathGlobFilter", f"*{suffix}").schema(df.schema).csv(directory)
    # The metadata column gives names as in a URL.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return rows.groupBy(F.col(key).alias("series"), name.alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
