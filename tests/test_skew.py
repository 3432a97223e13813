"""One key holds a third or more of all rows; results must be whole and no task may get it all."""

import pytest
from helpers import plan_of, rows
from entities import products
from pyspark.sql import functions as F

from tidebook.operators.affinity import best_sellers, buyers_per_product, purchases, similar_items
from tidebook.operators.demand import monthly_units
from tidebook.plans.customers import customer_profile

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
N = 120_000


@pytest.fixture
def hot(spark):
    """A third of the items belong to order 0, a third of the orders to customer 0."""
    k = F.col("id")
    orders = spark.range(9000).select(
        k.alias("order_id"),
        F.when(k % 3 == 0, 0).otherwise(k % 500).alias("customer_id"),
        F.lit("2024-03-05 00:00:00").cast("timestamp_ntz").alias("order_date"),
        (k % 100 + 0.25).alias("total"),
        F.lit("store").alias("channel"),
        F.lit("paid").alias("status"),
    )
    items = spark.range(0, N, 1, 4).select(
        F.when(k % 3 == 0, 0).otherwise(k % 9000).alias("order_id"),
        F.when(k % 5 < 2, 7).otherwise(k * 7 % 300).alias("product_id"),
        (k % 4 + 1).alias("quantity"),
    )
    return orders, items, products(spark, range(300), lambda i: i % 11)


def run_plan(df):
    result = rows(df)
    return result, plan_of(df)


def python_rows(hot):
    orders, items, _ = hot
    owner = {r["order_id"]: r["customer_id"] for r in orders.collect()}
    return owner, [tuple(r) for r in items.collect()]


def test_hot_order_is_split_and_pairs_are_whole(spark, hot, with_conf):
    with_conf(SKEW)
    orders, items, _ = hot
    found, plan = run_plan(purchases(orders, items))
    assert "skew=true" in plan
    owner, lines = python_rows(hot)
    assert found == sorted({(owner[o], p) for o, p, _ in lines}, key=repr)


def test_hot_order_in_monthly_units(spark, hot, with_conf):
    with_conf(SKEW)
    orders, items, _ = hot
    found, plan = run_plan(monthly_units(orders, items))
    assert "skew=true" in plan
    _, lines = python_rows(hot)
    units = {}
    for _, p, q in lines:
        units[p] = units.get(p, 0) + q
    assert {p: u for p, _, u in found} == units


def test_hot_customer_and_product_in_the_profile(spark, hot, with_conf):
    with_conf(SKEW)
    found, plan = run_plan(customer_profile(*hot))
    assert "skew=true" in plan
    owner, lines = python_rows(hot)
    kinds, spent = {}, {}
    for o, p, _ in lines:
        kinds.setdefault(owner[o], set()).add(p % 11)
    for r in hot[0].collect():
        total, n = spent.get(r["customer_id"], (0.0, 0))
        spent[r["customer_id"]] = (total + r["total"], n + 1)
    assert {(c, t, n, d) for c, t, n, _, d in found} == {
        (c, t, n, len(kinds.get(c, ()))) for c, (t, n) in spent.items()
    }


def test_neighbours_of_a_hot_product(spark, hot, with_conf):
    with_conf(SKEW)
    orders, items, _ = hot
    pairs = purchases(orders, items)
    owner, lines = python_rows(hot)
    buyers = {}
    for o, p, _ in lines:
        buyers.setdefault(p, set()).add(owner[o])
    assert dict(rows(buyers_per_product(pairs))) == {p: len(b) for p, b in buyers.items()}
    best = max(buyers, key=lambda p: (len(buyers[p]), -p))
    scores = sorted((-len(b & buyers[best]) ** 2 / len(b), p) for p, b in buyers.items() if p != best)
    found = similar_items(pairs, best_sellers(pairs), 5).orderBy("position").collect()
    assert [(r["reference_id"], r["product_id"]) for r in found] == [(best, p) for _, p in scores[:5]]


def test_groups_are_cut_before_they_are_shuffled(spark, hot):
    pairs = purchases(*hot[:2])
    plan = plan_of(similar_items(pairs, best_sellers(pairs), 5))
    assert plan.count("WindowGroupLimit") == 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
