"""Price bars derived from the test tables, in Spark and in SQL.

Prices are divided by a prime: decimal inputs then never fall on a rounding
tie, where two engines may round a float sum differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 9973.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(rows: DataFrame) -> DataFrame:
    """Daily bars from rows of ticker, date, price and a unique sequence."""
    return rows.groupBy("ticker", "date").agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        F.col("o_orderdate").cast("date").alias("date"),
        (F.col("o_totalprice") / SCALE).alias("price"),
        F.col("o_orderkey").alias("seq"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five series, one per order priority."""
    return _bars(order_rows(spark, sf_dir))


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many series, one per supplier, from all line items."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_extendedprice") / SCALE).alias("price"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("seq"),
    )
    return _bars(rows)


def unmerged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per order, so dates repeat within a series."""
    p = F.col("price")
    return order_rows(spark, sf_dir).select(
        "ticker", "date", p.alias("open"), p.alias("high"), p.alias("low"), p.alias("close"),
        F.lit(1).cast("long").alias("volume"),
    )


ORDER_ROWS_SQL = f"""order_rows AS (
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date,
         o_totalprice / {SCALE}::DOUBLE AS price, o_orderkey AS seq
  FROM orders)"""

SUPPLIER_ROWS_SQL = f"""order_rows AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice / {SCALE}::DOUBLE AS price,
         row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS seq
  FROM lineitem)"""

BARS_SQL = """bars AS (
  SELECT ticker, date, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, seq) AS close, count(*) AS volume
  FROM order_rows GROUP BY ticker, date)"""
