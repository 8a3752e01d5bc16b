"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` overrides them.

    Nothing that depends on the size of the cluster is set here: partition
    counts are left to adaptive execution.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.debug.maxToStringFields": "200",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder; on a
    cluster such a folder would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes what was staged within, at the end: for jobs whose results are
    written or shown by then. Frames that still read it must not leave."""
    held: list[str] = []
    _scopes.append(held)
    try:
        yield
    finally:
        _scopes.remove(held)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for path in map(hadoop, held):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """Jobs within delete their shuffle files as they end, instead of when the
    driver next collects garbage."""
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back, so that later jobs
    do not repeat its work and a lost executor costs only a re-read. What it
    was shuffled for is written then, so the disk holds the shuffles of one
    frame at a time."""
    path = scratch_path(df.sparkSession, name)
    for held in _scopes:
        held.append(path)
    with without_shuffles_left(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
