"""Small reference tables with a fixed number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import local_table

# Measured Parquet object sizes, (rows, bytes).
POSTS_SIZES = [
    (1, 7680), (2, 7887), (5, 8304), (10, 8540), (25, 9118), (50, 9861),
    (100, 11331), (250, 15128), (500, 20687), (1000, 32052), (2500, 68094), (5000, 128675),
]
SUMMARY_SIZES = [(1, 4591), (2, 4637), (5, 4688), (7, 4739)]

# List prices in USD.
PRICES = [
    ("get_request", 0.0000004, "USD per request"),
    ("put_request", 0.000005, "USD per request"),
    ("storage_gb_month", 0.023, "USD per GB-month"),
    ("scan_tb", 5.0, "USD per TB scanned"),
]


def size_points(spark: SparkSession) -> DataFrame:
    rows = [("posts", r, b) for r, b in POSTS_SIZES] + [("daily_summary", r, b) for r, b in SUMMARY_SIZES]
    return local_table(spark, rows, "dataset string, rows bigint, bytes bigint")


def prices(spark: SparkSession) -> DataFrame:
    return local_table(spark, PRICES, "name string, value double, unit string")
