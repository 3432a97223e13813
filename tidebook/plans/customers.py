"""Loyal customers by average ticket, and the categories they buy.

Order totals and item facts live at different grains. Each is aggregated to the customer before
they meet, because joining items to orders first would count an order's total once per item.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.numbers import cents, exact_units, from_cents, millionths, ratio, round2, whole_units
from tidebook.operators.ranking import numbered, top
from tidebook.session import materialize

# Up to this many orders of ranked customers (two longs each) are sent to every executor. The
# number changes the plan, never the rows.
BROADCAST_ORDERS = 1_000_000


def customer_orders(orders: DataFrame) -> DataFrame:
    """Revenue, number of orders and average ticket per customer, from the orders alone."""
    summed = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum(cents(F.col("total"))).alias("cents"), F.count("*").alias("frequency"))
    )
    revenue = F.coalesce(from_cents(F.col("cents")), F.lit(0.0))
    return summed.select(
        "customer_id",
        revenue.alias("revenue"),
        "frequency",
        round2(ratio(revenue, F.col("frequency"))).alias("average_ticket"),
    )


def category_diversity(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Exact number of different categories per customer.

    Spark counts the distinct pairs on both columns before it counts per customer, so a customer
    with very many lines is spread over tasks.
    """
    return (
        items.select("order_id", "product_id")
        .join(orders.select("order_id", "customer_id"), "order_id")
        .join(products.select("product_id", "category_id"), "product_id")
        .groupBy("customer_id")
        .agg(F.count_distinct("category_id").alias("category_diversity"))
    )


def customer_profile(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Both grains side by side; a customer whose orders hold no item has diversity 0."""
    diversity = category_diversity(orders, items, products)
    return _with_diversity(customer_orders(orders), diversity)


def _with_diversity(customers: DataFrame, diversity: DataFrame) -> DataFrame:
    return customers.join(diversity, "customer_id", "left").withColumn(
        "category_diversity", F.coalesce("category_diversity", F.lit(0))
    )


@dataclass(frozen=True)
class Ranking:
    """Ranked customers, and the number of their orders."""

    customers: DataFrame
    n_orders: int


def rank_customers(
    orders: DataFrame, items: DataFrame, products: DataFrame, min_categories: int = 0, n: int = 10
) -> Ranking:
    """The top ``n`` customers by average ticket.

    With a diversity threshold every customer's diversity must be known first. Without one the
    ranking needs the orders only.

    The ranking is written now, so that the plans built on it need not repeat it and know how many
    orders it stands for.
    """
    if min_categories > 0:
        eligible = customer_profile(orders, items, products).filter(
            F.col("category_diversity") >= min_categories
        )
    else:
        eligible = customer_orders(orders)
    ranked = top(eligible, [F.desc("average_ticket"), F.asc("customer_id")], n)
    ranked = materialize(ranked, "ranking")
    return Ranking(ranked, ranked.agg(F.coalesce(F.sum("frequency"), F.lit(0))).first()[0])


def orders_of(orders: DataFrame, ranking: Ranking) -> DataFrame:
    """The orders of the ranked customers (semi join).

    Few orders are sent to the items, which then need not be shuffled. One of the customers may
    hold a large share of all orders; beyond the limit both sides are shuffled instead.
    """
    # There are no more customers than orders of theirs.
    customers = ranking.customers.select("customer_id")
    if ranking.n_orders <= BROADCAST_ORDERS:
        customers = F.broadcast(customers)
    chosen = orders.select("order_id", "customer_id").join(customers, "customer_id", "left_semi")
    return F.broadcast(chosen) if ranking.n_orders <= BROADCAST_ORDERS else chosen


def loyal_customers(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    ranking: Ranking,
) -> DataFrame:
    """The ranking with customer names and diversity, looked up for the ranked customers only.

    A customer without a name stays in the ranking.
    """
    ranked = ranking.customers
    if "category_diversity" not in ranked.columns:
        diversity = category_diversity(orders_of(orders, ranking), items, products)
        ranked = _with_diversity(ranked, diversity)
    names = customers.join(ranking.customers.select("customer_id"), "customer_id", "left_semi")
    named = ranked.join(names, "customer_id", "left").select(
        "customer_id",
        "customer",
        "revenue",
        "frequency",
        "average_ticket",
        "category_diversity",
        "position",
    )
    return named.orderBy("position")


def loyal_categories(
    orders: DataFrame, items: DataFrame, products: DataFrame, ranking: Ranking, fractional: bool = False
) -> DataFrame:
    """Units per category bought by the ranked customers, most bought first.

    ``fractional`` units are a decimal of six places. Units are added up per product before the product table is joined. Those of products that it
    does not list stand under a null category.
    """
    chosen = orders_of(orders, ranking).select("order_id")
    per_product = (
        items.join(chosen, "order_id").groupBy("product_id").agg(F.sum(millionths(F.col("quantity"))).alias("units"))
    )
    per_category = (
        per_product.join(products.select("product_id", "category_id", "category"), "product_id", "left")
        .groupBy("category_id", "category")
        .agg((exact_units if fractional else whole_units)(F.sum("units")).alias("n_items"))
    )
    order = [F.desc("n_items"), F.asc_nulls_last("category_id"), F.asc_nulls_last("category")]
    return numbered(per_category, order).orderBy("position")
