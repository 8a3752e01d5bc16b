"""Row numbers over a whole table, without a window that holds it in one task.

`row_number()` over an unpartitioned window sends every row to one task. Here rows are
range-partitioned and sorted, numbered within their partition, and shifted by the number
of rows in the partitions before: one shuffle, and a table of one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.sizing import broadcast_if_small
from tickloom.session import stage

# monotonically_increasing_id keeps the partition above this bit, the row in it below.
_PARTITION_BIT = 33


def add_positions(df: DataFrame, order: list[str], name: str = "position", start: int = 1) -> DataFrame:
    """Adds `name`, the place of each row in the order of the columns `order` (nulls
    first), counted from `start` without gaps. Rows that tie get different places, in no
    particular order: name enough columns to tell rows apart where that matters.

    Ties do not pile up in a partition: the row's place in the input is the last key of
    the range. The sorted rows are staged, so the numbers stay as they are.
    """
    taken = {c.lower() for c in df.columns}
    tie, part, before = (_unused(taken, x) for x in ("_tie", "_part", "_before"))
    keys = [F.col(f"`{c}`") for c in order]
    sorted_rows = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*keys, F.col(tie))
        .sortWithinPartitions(*keys, F.col(tie))
        .withColumn(tie, F.monotonically_increasing_id())
    )
    rows = stage(sorted_rows, "positions")
    rows = rows.withColumn(part, F.shiftright(tie, _PARTITION_BIT))
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition of the shuffle, so this window stays small.
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    rows = rows.join(broadcast_if_small(stage(offsets, "offsets")), part)
    within = F.col(tie).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return rows.withColumn(name, F.col(before) + within + F.lit(start)).drop(tie, part, before)


def _unused(taken: set[str], name: str) -> str:
    while name in taken:
        name += "_"
    return name
