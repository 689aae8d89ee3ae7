"""Orders as records, suppliers of their line items as members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.specs import category_of, parse_categories
from rollcall.operators.members import attach_records, record_sizes

BINS = "1,2,3,4-6,7-10,11-end"
# 2001 lies outside every range, nothing lies in the last
YEAR_RANGES = "1995-1996,1997-1998,1999-2000,2010-2020"
# the priority 5-LOW has no category
CATEGORIES = "1-URGENT:rush;2-HIGH:rush;3-MEDIUM:normal;4-NOT SPECIFIED:unset"


def order_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """``(l_orderkey, n)``: how many line items an order has."""
    return record_sizes(_items(spark, folder), "l_orderkey", "member")


def order_records(spark: SparkSession, folder: str) -> DataFrame:
    """Order sizes with the kind, category and year of the order."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderpriority").alias("kind"),
        category_of("o_orderpriority", parse_categories(CATEGORIES)).alias("category"),
        F.year("o_orderdate").alias("year"),
    )
    return order_sizes(spark, folder).join(orders, "l_orderkey")


def order_memberships(spark: SparkSession, folder: str, *, described: bool = False) -> DataFrame:
    """One row per line item: supplier, order size, and with ``described`` the rest."""
    records = order_records(spark, folder) if described else order_sizes(spark, folder)
    return attach_records(_items(spark, folder), records, "l_orderkey")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    return items.select("l_orderkey", F.col("l_suppkey").alias("member")).where("member IS NOT NULL")
