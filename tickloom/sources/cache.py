"""Results kept under a key and the version of what they were made from."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom import schema
from tickloom.operators.latest import last_rows_of
from tickloom.session import scratch_root
from tickloom.sources.tables import table_version


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def kept(spark: SparkSession, name: str, key: dict, version: str, compute: Callable[[], DataFrame], root: str | None = None) -> DataFrame:
    """The result stored for `key` and `version`; if there is none, that of `compute`, which is stored.

    Results lie below `root` (by default the shared scratch folder), in a folder per key and one per version in it. A
    result counts once its success marker is there, so an interrupted write is done again. Results of
    other versions of the key are deleted after a new one is stored: they are stale.
    """
    digest = hashlib.sha256(json.dumps(key, sort_keys=True, default=str).encode()).hexdigest()[:32]
    folder = f"{(root or scratch_root(spark)).rstrip('/')}/kept-{name}/{digest}"
    path = f"{folder}/{version}"
    marker, files = _files(spark, f"{path}/_SUCCESS")
    if not files.exists(marker):
        compute().write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
        for status in files.listStatus(_files(spark, folder)[0]):
            if status.getPath().getName() != version:
                files.delete(status.getPath(), True)
    return spark.read.parquet(path)


def kept_stock_data(
    spark: SparkSession, ticker: str, days: int = 30, name: str = schema.SERVING_TABLE, root: str | None = None
) -> DataFrame:
    """The latest `days` rows of a ticker, newest first, from the store while the table is as it was."""
    key = {"table": name, "ticker": ticker, "days": days}
    rows = kept(spark, "stock-data", key, table_version(spark, name), lambda: last_rows_of(spark.table(name), ticker, days), root)
    return rows.orderBy(rows["date"].desc())
