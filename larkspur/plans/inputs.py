"""Stand-in inputs that the registered queries derive from the tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order totals, one series per order priority: ``series_id, d, v``."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("d")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("v")
    )


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("series_id"), F.date_trunc("month", "o_orderdate").cast("date").alias("d")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))


PANEL = """panel AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d,
  round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2)"""
MONTHLY = """monthly AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS d,
  round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2)"""
#: The trailing 60-row rank of the panel.
RANKED = PANEL + """, ranked AS (SELECT *, CASE WHEN len(h) = 60
  THEN 100.0::DOUBLE * len(list_filter(h, lambda x: x < v)) / 59 END AS rank
  FROM (SELECT *, list(v) OVER (PARTITION BY series_id ORDER BY d ROWS 59 PRECEDING) AS h FROM panel))"""
