"""Scans of the star-schema parquet tables, bound to the business names the plans use.

The plans know four entities and nothing about where they come from:

=========  ==================================================================
orders     order_id, customer_id, order_date, total, channel, status
items      order_id, product_id, quantity
products   product_id, product, category_id, category
customers  customer_id, customer
=========  ==================================================================

A binding only renames, so filters and column pruning still reach the parquet scan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class Sales(NamedTuple):
    """The four entities the plans work on."""

    orders: DataFrame
    items: DataFrame
    products: DataFrame
    customers: DataFrame


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def sales(spark: SparkSession, root: str) -> Sales:
    """The entities of a folder of parquet tables."""
    return bind({name: table(spark, root, name) for name in ("orders", "lineitem", "part", "customer")})


def bind(tables: dict[str, DataFrame]) -> Sales:
    """The entities of star tables from anywhere, such as a typed load.

    Order priority stands in for the sales channel and the brand for the category, which these
    tables do not have. Quantities stay as they are stored. A category's id is the number at the
    end of its brand, null without one. (l_orderkey, l_linenumber) is not unique: every row is a
    line of its own.
    """
    orders = tables["orders"].select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"),
    )
    items = tables["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    )
    products = tables["part"].select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product"),
        F.substring_index("p_brand", "#", -1).try_cast("bigint").alias("category_id"),
        F.col("p_brand").alias("category"),
    )
    customers = tables["customer"].select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer"),
    )
    return Sales(orders, items, products, customers)


def orders(spark: SparkSession, root: str) -> DataFrame:
    return sales(spark, root).orders
