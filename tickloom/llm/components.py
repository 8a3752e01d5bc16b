"""Connected components of a link table by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage


def star(links: DataFrame, large: bool) -> DataFrame:
    """Ties the neighbours of every node to the smallest of them and the node itself: the
    larger neighbours in a large star, the others in a small one. A node with many
    neighbours is one key, but its minimum is aggregated before the shuffle and its rows
    meet it in a join that adaptive execution can split."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    rows = both.join(least, "a")
    if large:
        return rows.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return rows.select("b", "m").union(least.select("a", "m")).where("b <> m").toDF("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`links` has columns `a`, `b` of one orderable type, without nulls; repeated links and
    links of a node to itself do no harm. Gives a row `node`, `root` for every node that is
    not the smallest of its component. Rounds are written to the shared folder, and go on
    until one leaves the table as it was."""
    now = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        now = stage(star(star(now, True), False), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
