import random
from collections import defaultdict

import pytest
from helpers import rows
from entities import items, orders, products

from tidebook.plans import customers as cust


def names(spark, ids):
    return spark.createDataFrame([(i, f"customer {i}") for i in ids], "customer_id bigint, customer string")


def test_items_do_not_multiply_order_totals(spark):
    o = orders(spark, [(1, 7, "2024-01-01", 100.0, "s", "paid"), (2, 7, "2024-01-02", 50.0, "s", "draft")])
    i = items(spark, [(1, p, 1) for p in range(5)] + [(2, 0, 3), (2, 0, 3)])
    found = cust.customer_profile(o, i, products(spark, range(5))).collect()
    assert [tuple(r) for r in found] == [(7, 150.0, 2, 75.0, 3)]


def test_customer_without_items_stays(spark):
    o = orders(spark, [(1, 7, "2024-01-01", 100.0, "s", "paid")])
    found = cust.customer_profile(o, items(spark, []), products(spark, [1])).collect()
    assert [tuple(r) for r in found] == [(7, 100.0, 1, 100.0, 0)]


def test_missing_totals_count_as_orders(spark):
    o = orders(spark, [(1, 7, "2024-01-01", None, "s", "paid"), (2, None, "2024-01-01", 5.0, "s", "paid")])
    found = cust.customer_orders(o).collect()
    assert [tuple(r) for r in found] == [(7, 0.0, 1, 0.0)]


def random_sales(spark, seed, n=400):
    rnd = random.Random(seed)
    o = [(k, rnd.randint(1, 30), "2024-01-01", rnd.randint(100, 99999) / 100, "s", "paid") for k in range(n)]
    i = [(rnd.randint(0, n + 20), rnd.randint(0, 25), rnd.randint(1, 9)) for _ in range(3 * n)]
    return o, i


def brute_force(o, i, category, min_categories, n):
    revenue, count, kinds, units = defaultdict(int), defaultdict(int), defaultdict(set), defaultdict(int)
    owner = {k: c for k, c, *_ in o}
    for _, c, _, total, *_ in o:
        revenue[c] += round(total * 100)
        count[c] += 1
    for k, p, _ in i:
        if k in owner:
            kinds[owner[k]].add(category(p))
    ranked = sorted(
        (-round(revenue[c] / 100 / count[c] * 100) / 100, c) for c in count if len(kinds[c]) >= min_categories
    )[:n]
    best = {c for _, c in ranked}
    for k, p, q in i:
        if owner.get(k) in best:
            units[category(p)] += q
    customers = [(c, revenue[c] / 100, count[c], -t, len(kinds[c]), at) for at, (t, c) in enumerate(ranked, 1)]
    categories = [(g, u, at) for at, (u, g) in enumerate(sorted((-u, g) for g, u in units.items()), 1)]
    return customers, [(g, -u, at) for g, u, at in categories]


@pytest.mark.parametrize("min_categories, few", [(0, True), (0, False), (6, True), (8, False)])
def test_ranking_and_categories_against_brute_force(spark, monkeypatch, min_categories, few):
    """``few``: the winners' orders are broadcast; otherwise both sides are shuffled."""
    if not few:
        monkeypatch.setattr(cust, "BROADCAST_ORDERS", 0)
    raw_orders, raw_items = random_sales(spark, seed=min_categories + few)
    category = lambda p: p % 9
    expected_customers, expected_categories = brute_force(raw_orders, raw_items, category, min_categories, 10)
    o, i = orders(spark, raw_orders), items(spark, raw_items)
    p = products(spark, range(26), category)
    ranking = cust.rank_customers(o, i, p, min_categories, 10)
    found = cust.loyal_customers(o, i, p, names(spark, range(31)), ranking)
    found = found.drop("customer")
    assert [tuple(r) for r in found.collect()] == expected_customers
    categories = cust.loyal_categories(o, i, p, ranking).select("category_id", "n_items", "position")
    assert [tuple(r) for r in categories.collect()] == expected_categories


def test_ties_fall_back_to_the_customer_id(spark):
    o = orders(spark, [(k, c, "2024-01-01", 10.0, "s", "paid") for k, c in enumerate([5, 3, 9, 1])])
    ranking = cust.rank_customers(o, items(spark, []), products(spark, [1]), n=3)
    assert ranking.n_orders == 3
    assert rows(ranking.customers.select("position", "customer_id")) == [(1, 1), (2, 3), (3, 5)]


def test_unnamed_customers_stay(spark):
    o = orders(spark, [(k, c, "2024-01-01", 10.0 + c, "s", "paid") for k, c in enumerate([5, 3])])
    sales = o, items(spark, []), products(spark, [1])
    found = cust.loyal_customers(*sales, names(spark, [3]), cust.rank_customers(*sales))
    assert rows(found.select("position", "customer_id", "customer")) == [(1, 5, None), (2, 3, "customer 3")]
