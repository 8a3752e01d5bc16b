"""Size checks that decide between plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import stage

# A broadcast side may take this much memory; beyond it the join shuffles.
BROADCAST_BYTES = 128 << 20


def split_bytes(df: DataFrame) -> int:
    """Bytes in one scan split, the unit of work one task is sized for."""
    value = df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes").lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    digits = value.rstrip("bkmg")
    return int(digits) * units[value[len(digits):] or "b"]


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether Catalyst's size estimate for the frame is a quarter of a scan
    split at most; files may unpack to several times their size.

    Such an input cannot make a task much heavier than a scan task, so the
    counting passes are not worth a job. Unknown sizes count as large.
    """
    limit = split_bytes(df) // 4 if limit is None else limit
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Stages a frame that is not small, before operators that read it more
    than once; a small one is cheap enough to compute again."""
    return df if is_small(df) else stage(df, name)


def place(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by a hash of their keys to partitions whose number follows
    from the row count, and sorted within. Tree training samples by partition,
    so with this its result does not depend on cores or files; work costs far
    more than reading, so a few thousand rows make a task."""
    rows = df.count()
    tasks = max(min(64, -(-rows // 2_000)), -(-rows // 200_000), 1)
    return df.repartition(tasks, *keys).sortWithinPartitions(*keys)


def broadcast_if_small(side: DataFrame) -> DataFrame:
    """Marks a staged side for broadcast if its size in memory, bounded by its
    row count and its longest strings, allows it. Sides with nested columns,
    whose size that does not bound, are not marked."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in side.schema):
        return side
    strings = [f.name for f in side.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    rows, *longest = side.agg(F.count(F.lit(1)), *[F.max(F.octet_length(c)) for c in strings]).first()
    row_bytes = 32 + 16 * len(side.columns) + sum(n or 0 for n in longest)
    return F.broadcast(side) if rows * row_bytes <= BROADCAST_BYTES else side


def attach(
    df: DataFrame, side: DataFrame, on: list[str], how: str = "left", small_bytes: int | None = None
) -> DataFrame:
    """Join a derived, usually small, side onto a large frame; keys compare
    null-safe.

    The side is staged and measured first. If it may be broadcast, the large
    frame is not shuffled; otherwise the join is an ordinary one, where
    adaptive execution splits skewed keys.
    """
    if not is_small(df, small_bytes):
        side = broadcast_if_small(stage(side, "side"))
    keys = {c: f"_on_{c}" for c in on}
    side = side.withColumnsRenamed(keys)
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    return df.join(side, same, how).drop(*keys.values())
