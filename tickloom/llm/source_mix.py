"""Mixing sources to target weights along a time-varying curriculum.

1. Sizes (words) are summed per source and hash bucket, then per source.
2. Targets share the total by weight; a source gives at most `MAX_PASSES` times its size,
   and what is above goes to the others by weight. Sorted by size over weight, the sources
   at that limit come first, so one running sum decides all.
3. The documents of a source lie on a line in the order of a hash of their id. Whole
   passes over the line come first; of the rest, a document is taken if its middle lies
   within it.
4. A source's weight over training time is a schedule of knots, linear in between. Its
   integral is the source's cumulative demand; where a document's place on the line of
   demand falls, the inverse integral gives its training position in [0, 1].

Places on the line come from sums per (source, bucket) and a window within a bucket, so a
source of any size is spread over tasks. Only the table of sources (one row each) is
ordered as a whole. Order and ties depend on id, size and source only, so reruns agree.
A null text has size 0; a null source is a source of its own, ranked last; rows with a null
or repeated id are rows like others. With no words at all every target is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.textual import fresh_name

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
#: For each weight in turn, knots (time, relative weight): the first sources fade, the last grow.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))
BUCKET_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A source's name with a mark in front, so that null has a key too, and the last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """Adds `turn` (place in the list of weights) and `target` to rows of `source`, `source_size`."""
    turn = (F.row_number().over(Window.orderBy("source")) - 1) % len(weights)
    rows = sources.withColumn("turn", turn)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1).cast("long"))
    rows = rows.withColumn("limit", passes * F.col("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    line = Window.orderBy(F.col("limit") / F.col("weight"), "source")
    rows = rows.select(
        "*", F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("limit").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"),
        F.sum("weight").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("weights"),
    )
    rows = rows.withColumn("full", F.col("weight") * (F.col("total") - F.col("above")) > F.col("limit") * F.col("weights"))
    of = lambda name, when: F.coalesce(F.sum(F.when(when, F.col(name))).over(everything), F.lit(0))
    shared = F.col("weight") * (F.col("total") - of("limit", F.col("full"))) / of("weight", ~F.col("full"))
    return rows.select("source", "source_size", "turn", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(shared).alias("target"))


def position(done: Column, turn: Column, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> Column:
    """The time at which a source has met the part `done` (0 to 1) of its demand."""
    found = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
        need = done * sum(areas)
        at = F.lit(float(knots[-1][0]))
        for i in reversed(range(len(areas))):
            (t0, w0), (t1, w1) = knots[i], knots[i + 1]
            rest, slope = need - sum(areas[:i]), (w1 - w0) / (t1 - t0)
            # Invert w0 x + slope x^2 / 2; written without a division by slope, which may be 0.
            step = 2 * rest / (F.lit(float(w0)) + F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * rest)))
            at = F.when(need <= sum(areas[: i + 1]), t0 + step).otherwise(at)
        found = F.when(turn == k, at).otherwise(found)
    return found


def mix(docs: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, str]:
    """`docs` with the columns of `carry` and a struct of `size`, `source_size`, `target`,
    `copies`, `taken`, `place` (of the first copy on the source's line) and `turn`; and the
    name of that struct."""
    name = fresh_name(carry, "mix")
    order = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*(F.col(f"`{x}`") for x in carry)).alias("doc"), source_key(F.col(f"`{source_col}`")).alias("source"),
        word_count(F.col(f"`{text_col}`").cast("string")).alias("size"), order.alias("ord"), F.substring(order, 1, BUCKET_DIGITS).alias("bucket"),
    )
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    by_source = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    sums = sums.join(by_source, "source")

    within = Window.partitionBy("source", "bucket").orderBy("ord", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(sums, ["source", "bucket"]).withColumn("place", F.col("start") + F.col("inner"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("whole", whole)
    more = (F.col("size") > 0) & (F.col("place") + F.col("size") / 2 <= F.col("target") - F.col("whole") * F.col("source_size"))
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, F.least(F.col("whole") + more.cast("long"), F.lit(MAX_PASSES))).otherwise(0).cast("long"))
    rows = rows.withColumn("taken", F.col("size") * F.col("copies"))
    struct = F.struct("size", "source_size", "target", "copies", "taken", "place", "turn")
    return rows.select(*(F.col("doc")[x].alias(x) for x in carry), struct.alias(name)), name


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, str]:
    """The documents the mix takes, once per copy, range-sorted by training position; and
    the name of the column with that position."""
    rows, name = mix(docs, docs.columns, id_col, text_col, source_col)
    return in_order(rows, name, docs.columns, id_col)


def in_order(rows: DataFrame, name: str, carry: list[str], id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """`training_order` of what `mix` gave, with the columns of `carry`."""
    at = fresh_name([*rows.columns, name], "position")
    m = F.col(name)
    rows = rows.where(m["copies"] > 0).withColumn(at, F.explode(F.sequence(F.lit(0).cast("long"), m["copies"] - 1)))
    done = (F.col(at) * m["source_size"] + m["place"] + m["size"] / 2) / m["target"]
    rows = rows.withColumn(at, position(F.least(done, F.lit(1.0)), m["turn"])).select(*(F.col(f"`{x}`") for x in carry), at)
    return rows.repartitionByRange(F.col(f"`{at}`"), F.col(f"`{id_col}`")).sortWithinPartitions(at, id_col), at
