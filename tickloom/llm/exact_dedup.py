"""Exact deduplication by a tree merge of sorted digest runs.

Texts are equal when they are identical after white space (`[\\x20\\x09-\\x0D]`) is deleted.
Of equal texts the row with the most code points stays, then the smallest id.

1. Every partition sorts its digests into a run, equal ones collapsed at once, so a hot
   group leaves a partition as one entry. A run is cut into slices by digest range.
2. In each round, `FAN_IN` neighbouring runs of a slice (three binomial levels) meet in
   one task, which merges them: entries whose digests are equal are verified by a second
   hash and the length, counted together, and keep the best identifier. Rounds go on
   until a slice has one run; each is written to the shared folder.
3. Rows look up their digest among the merged entries.

A task holds at most `FAN_IN` runs of one slice, and slices are as many as the rows need.
Null counts as empty, and empty texts form a group. A null id comes after all others.
Rows tied in text, length and id (repeated rows) form a group like others; one of them is
kept. Columns other than id and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

FAN_IN = 8
SLICE_ROWS = 200_000
KEY = ("digest", "proof", "n_bytes")
BEST = (("n_points", "descending"), ("id", "ascending"), ("row", "ascending"))


def digest_columns(text: Column) -> dict[str, Column]:
    bare = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]", "")
    return {
        "digest": F.unhex(F.sha2(bare, 256)),
        "proof": F.xxhash64(bare),
        "n_bytes": F.octet_length(bare),
        "n_points": F.length(F.coalesce(text.cast("string"), F.lit(""))),
    }


def merge(entries: pa.Table) -> pa.Table:
    """Sorts entries and leaves the best of each key, with the number of rows it stands for."""
    if not entries.num_rows:
        return entries
    entries = entries.combine_chunks().sort_by([(x, "ascending") for x in KEY] + list(BEST))
    new = np.ones(entries.num_rows, bool)
    new[1:] = False
    for x in KEY:
        column = entries.column(x)
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    counts = np.add.reduceat(entries.column("n_rows").to_numpy(), first)
    entries = entries.take(pa.array(first))
    return entries.set_column(entries.schema.get_field_index("n_rows"), "n_rows", pa.array(counts, pa.int64()))


def first_runs(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    """The partition's run: merged entries, each with its slice."""
    batches = list(batches)  # digests only; a partition of texts has few MB of them
    if not batches:
        return
    entries = merge(pa.Table.from_batches(batches))
    head = np.array([int.from_bytes(x[:8], "big") for x in entries.column("digest").to_pylist()], np.uint64)
    place = (head >> np.uint64(32)).astype(np.int64) * slices >> 32
    entries = entries.set_column(entries.schema.get_field_index("slice"), "slice", pa.array(place.astype(np.int32)))
    yield from entries.to_batches()


def merged_runs(rows: DataFrame) -> DataFrame:
    """One entry per distinct text of `rows` (columns `id`, `row` and those of `digest_columns`)."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.shiftright("row", 33)).alias("last")).first()
    slices = max(1, -(-size["n"] // SLICE_ROWS))
    runs = (size["last"] or 0) + 1
    rows = rows.select(F.lit(0).alias("slice"), F.shiftright("row", 33).alias("run"), *KEY, "n_points", "id", "row", F.lit(1).cast("long").alias("n_rows"))
    level = rows.mapInArrow(lambda batches: first_runs(batches, slices), rows.schema)
    while runs > 1:
        runs = -(-runs // FAN_IN)
        up = level.withColumn("run", F.floor(F.col("run") / FAN_IN).cast("long"))
        level = stage(up.groupBy("slice", "run").applyInArrow(merge, up.schema), "runs")
    return level


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `keep_id`, `group_size`, `kept`, `text_sha256`."""
    rows = docs.select(F.col(id_col).alias("id"), *(c.alias(x) for x, c in digest_columns(F.col(text_col)).items()))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    best = merged_runs(rows).select(*KEY, F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n_rows").alias("group_size"))
    return rows.join(best, list(KEY)).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all columns. Texts meet their group's entry by
    digest, length and id together, so copies spread over tasks."""
    names = docs.columns
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *(c.alias(x) for x, c in digest_columns(F.col(text_col)).items()))
    best = merged_runs(stage(rows.withColumn("row", F.monotonically_increasing_id()), "digests"))
    keys = [*KEY, "n_points"]
    best = best.select(*keys, "id").withColumns({"no_id": F.col("id").isNull(), "id": F.coalesce(F.col("id").cast("string"), F.lit(""))})
    whole = docs.select(
        F.struct(*(F.col(f"`{x}`") for x in names)).alias("doc"), *(c.alias(x) for x, c in digest_columns(F.col(text_col)).items()),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{id_col}`").isNull().alias("no_id"),
    )
    keys += ["id", "no_id"]
    return whole.join(best, keys).dropDuplicates(keys).select(*(F.col("doc")[x].alias(x) for x in names))
