"""Size of the operation: totals, monthly evolution, channels and order statuses.

No order status is ever filtered out here or in any other plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.dates import month
from tidebook.functions.numbers import cents, from_cents, ratio, round2, wide_sum


def table_eda(df: DataFrame, value: str) -> DataFrame:
    """Rows, columns and the mean of one column of numbers, rounded once at the end.

    Whole parts and billionths are summed apart, both exactly: values may reach 9.2e18.
    """
    number = F.col(value).cast("double")
    whole = F.floor(number).cast("bigint")
    by_value = df.agg(
        F.count("*").alias("n_rows"),
        F.count(value).alias("n_values"),
        wide_sum(whole).alias("whole"),
        wide_sum(F.rint((number - whole) * 1_000_000_000).cast("bigint")).alias("billionths"),
    )
    total = F.col("whole").cast("double") + F.col("billionths").cast("double") / 1_000_000_000
    return by_value.select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        round2(ratio(total, F.col("n_values"))).alias("mean_value"),
    )


def sales_kpis(orders: DataFrame) -> DataFrame:
    """Total value, orders, customers and average ticket, in one row.

    Grouping by customer first gives the distinct count without a separate distinct pass: a
    single shuffle of one partly summed row per customer and task.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.sum(cents(F.col("total"))).alias("cents"), F.count("*").alias("n")
    )
    totals = per_customer.agg(
        wide_sum(F.col("cents")).alias("cents"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"),
        F.count("customer_id").alias("n_customers"),
    )
    return totals.select(
        from_cents(F.col("cents")).alias("total_value"),
        "n_orders",
        "n_customers",
        round2(ratio(from_cents(F.col("cents")), F.col("n_orders"))).alias("average_ticket"),
    )


def sales_cube(orders: DataFrame) -> DataFrame:
    """Orders and value per month, channel and status."""
    return orders.groupBy(
        month(F.col("order_date")).alias("month"), "channel", "status"
    ).agg(F.count("*").alias("n_orders"), F.sum(cents(F.col("total"))).alias("cents"))


def _totals(orders: DataFrame, key: str, of: Column) -> DataFrame:
    """Orders and value per key, straight from the two columns that they need."""
    summed = orders.groupBy(of.alias(key)).agg(
        F.count("*").alias("n_orders"), wide_sum(cents(F.col("total"))).alias("cents")
    )
    value = from_cents(F.col("cents"))
    return summed.select(
        key,
        "n_orders",
        value.alias("total_value"),
        round2(ratio(value, F.col("n_orders"))).alias("average_ticket"),
    )


def monthly_sales(orders: DataFrame) -> DataFrame:
    return _totals(orders, "month", month(F.col("order_date")))


def sales_by_channel(orders: DataFrame) -> DataFrame:
    return _totals(orders, "channel", F.col("channel"))


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per status and their share of all orders. The window sees one row per status."""
    everything = F.sum("n_orders").over(Window.partitionBy())
    return _totals(orders, "status", F.col("status")).select(
        "status", "n_orders", "total_value", ratio(F.col("n_orders"), everything).alias("share")
    )


def sales_overview(orders: DataFrame) -> dict[str, DataFrame]:
    """The four overview tables."""
    return {
        "sales_kpis": sales_kpis(orders),
        "monthly_sales": monthly_sales(orders),
        "sales_by_channel": sales_by_channel(orders),
        "status_distribution": status_distribution(orders),
    }
