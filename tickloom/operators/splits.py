"""Train/validation/test splits and standardising, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.noise import hash_text, uniform
from tickloom.operators.segments import SegmentLimits, lay_out
from tickloom.operators.sizing import attach

_HEX_PREFIX = 5  # about a million buckets per label


def row_numbers(df: DataFrame, name: str = "row_num", limits: SegmentLimits | None = None, **keys) -> DataFrame:
    """Adds the 1-based row number within the series by time."""
    layout = lay_out(df, limits=limits, **keys)
    return layout.finish(layout.df.withColumn(name, layout.position()))


def row_range(df: DataFrame, above: int | None = None, up_to: int | None = None, name: str = "row_num") -> DataFrame:
    """Rows numbered above `above` and up to `up_to`."""
    if above is not None:
        df = df.filter(F.col(name) > above)
    return df if up_to is None else df.filter(F.col(name) <= up_to)


def chronological_split(
    df: DataFrame, train: float = 0.8, validation: float = 0.1, limits: SegmentLimits | None = None, **keys
) -> DataFrame:
    """Adds `row_num` and `split`: the first floor(0.8 n) rows of each series
    train, the next floor(0.1 n) validate, the rest test."""
    layout = lay_out(df, limits=limits, **keys)
    out = layout.df.withColumns({"row_num": layout.position(), "_n": layout.length()})
    n_train = F.floor(F.col("_n") * F.lit(train))
    n_validation = F.floor(F.col("_n") * F.lit(validation))
    split = (
        F.when(F.col("row_num") <= n_train, F.lit("train"))
        .when(F.col("row_num") <= n_train + n_validation, F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return layout.finish(out.withColumn("split", split).drop("_n"))


def stratified_split(
    df: DataFrame, label: str, key: list[str], train: float = 0.8, seed: int = 42, small_bytes: int | None = None,
    ties: list[str] | None = None,
) -> DataFrame:
    """Adds `split`: exactly floor(0.8 n) rows of every label train, the rest
    test. Rows are ordered by the MD5 of their key and the seed, and where keys
    repeat by the columns of `ties` (by default a hash of all columns), so the
    split repeats exactly at any input size.

    A few labels hold all rows, so ranking within a label does not spread.
    Instead the cut is found by selection: rows are counted per label and hash
    prefix, only the bucket that contains the cut is ranked, and other rows are
    compared by prefix without shuffling them. The input is read several
    times: stage it if it is costly.
    """
    hashed = df.withColumn("_hash", hash_text(*[F.col(c) for c in key], seed))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, _HEX_PREFIX))
    counts = hashed.groupBy(F.col(label).alias("_label"), "_bucket").agg(F.count(F.lit(1)).alias("n"))
    by_label = Window.partitionBy("_label")
    placed = counts.select(
        "*",
        F.floor(F.sum("n").over(by_label) * F.lit(train)).alias("wanted"),
        F.sum("n").over(by_label.orderBy("_bucket")).alias("through"),
    )
    # The cut lists one row per label at most.
    cut = placed.filter((F.col("through") - F.col("n") < F.col("wanted")) & (F.col("wanted") <= F.col("through")))
    nth = F.col("wanted") - F.col("through") + F.col("n")
    cut = cut.select(F.col("_label").alias(label), F.col("_bucket").alias("_cut"), nth.alias("_nth"))
    marked = attach(hashed, cut, [label], small_bytes=small_bytes)
    at_cut = F.coalesce(F.col("_bucket") == F.col("_cut"), F.lit(False))
    order = ["_hash", *(ties if ties is not None else [F.xxhash64(*df.columns)])]
    rank = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    ranked = marked.filter(at_cut).withColumn("_train", rank <= F.col("_nth"))
    clear = marked.filter(~at_cut).withColumn("_train", F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False)))
    out = clear.unionByName(ranked)
    split = F.when(F.col("_train"), F.lit("train")).otherwise(F.lit("test"))
    return out.withColumn("split", split).drop("_hash", "_bucket", "_cut", "_nth", "_train")


def sampled_split(df: DataFrame, key: list[str], train: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds `split` by a threshold on a hash of the key and the seed: one pass
    without counting or shuffling, and a row keeps its side when others come or go.

    The share of training rows of a label with n different keys is `train` up to
    chance: within 4 * sqrt(train * (1 - train) / n) of it but for 1 in 16,000 labels.
    For exact shares use `stratified_split`.
    """
    below = uniform(*[F.col(c) for c in key], seed) <= F.lit(train)
    return df.withColumn("split", F.when(below, F.lit("train")).otherwise(F.lit("test")))


def standardise(
    df: DataFrame, columns, by: list[str], fit_on=None, population: bool = False, keep_moments: bool = False
) -> DataFrame:
    """Adds the z-score `{column}_z` of columns within groups, and with
    `keep_moments` also `_mean_{column}` and `_std_{column}`.

    A column that is constant in a group scores 0. Mean and deviation come from the rows matching `fit_on` (all by default;
    fit on the training rows to avoid a leak). They are aggregated with
    partial sums and joined back, so no group is gathered in one task.
    """
    spread = F.stddev_pop if population else F.stddev_samp
    rows = df if fit_on is None else df.filter(fit_on)
    moments = rows.groupBy(*by).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns], *[spread(c).alias(f"_std_{c}") for c in columns]
    )
    out = attach(df, moments, by)
    scores = {
        f"{c}_z": F.when(F.col(f"_std_{c}") == 0, F.lit(0.0)).otherwise(
            F.try_divide(F.col(c) - F.col(f"_mean_{c}"), F.col(f"_std_{c}"))
        )
        for c in columns
    }
    helpers = [] if keep_moments else [f"_{m}_{c}" for m in ("mean", "std") for c in columns]
    return out.withColumns(scores).drop(*helpers)
