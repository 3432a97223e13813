import math
import random
from collections import defaultdict

import pytest
from helpers import SMALL, plan_after, plan_of, rows
from entities import items, orders, products

from tidebook.operators import affinity
from tidebook.plans.recommend import recommendations
from tidebook.plans.registry import QUERIES

# Co-buyers, buyers and published similarity of five products to one with 397 buyers.
REFERENCE_BUYERS = 397
PUBLISHED = [
    (389, 106, 430, 0.2565525786018403),
    (295, 103, 407, 0.2562387261946596),
    (75, 100, 385, 0.25578459320485303),
    (337, 99, 431, 0.2393322954285645),
    (55, 98, 428, 0.23774365646117201),
]


def test_published_similarities(spark):
    """Purchases with exactly the published counts give the published ranking."""
    bought, fresh = [(c, 0) for c in range(REFERENCE_BUYERS)], REFERENCE_BUYERS
    for product, both, buyers, _ in PUBLISHED:
        bought += [(c, product) for c in range(both)]
        bought += [(c, product) for c in range(fresh, fresh + buyers - both)]
        fresh += buyers
    pairs = spark.createDataFrame(bought, "customer_id bigint, product_id bigint")
    found = affinity.similar_items(pairs, affinity.references(spark, [0])).orderBy("position").collect()
    assert [(r["product_id"], r["co_buyers"], r["buyers"]) for r in found] == [p[:3] for p in PUBLISHED]
    for row, published in zip(found, PUBLISHED):
        assert row["similarity"] == pytest.approx(published[3], abs=1e-15)
        assert row["reference_buyers"] == REFERENCE_BUYERS


def test_repeated_purchases_count_once(spark):
    o = orders(spark, [(1, 7, "2024-01-01", 1.0, "s", "p"), (2, 7, "2024-01-02", 1.0, "s", "p"), (3, None, "2024-01-02", 1.0, "s", "p")])
    pairs = affinity.purchases(o, items(spark, [(1, 5, 1), (1, 5, 4), (2, 5, 1), (2, 6, 1), (3, 5, 1), (4, 5, 1)]))
    assert rows(pairs) == [(7, 5), (7, 6)]


def brute_force(bought, references, k):
    buyers = defaultdict(set)
    for c, p in bought:
        buyers[p].add(c)
    result = []
    for ref in references:
        scored = []
        for p, who in buyers.items():
            both = len(who & buyers[ref])
            if p != ref and both:
                scored.append((-(both * both) / len(who), p, both))
        for at, (_, p, both) in enumerate(sorted(scored)[:k], 1):
            similarity = both / math.sqrt(float(len(buyers[ref])) * len(buyers[p]))
            result.append((ref, at, p, both, len(buyers[p]), len(buyers[ref]), similarity))
    return sorted(result)


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True), (3, True)])
def test_neighbours_against_brute_force(spark, seed, hot):
    """``hot``: one customer bought everything, one product was bought by everyone."""
    rnd = random.Random(seed)
    bought = {(rnd.randint(1, 60), rnd.randint(1, 40)) for _ in range(500)}
    if hot:
        bought |= {(0, p) for p in range(1, 41)} | {(c, 1) for c in range(61)}
    pairs = spark.createDataFrame(sorted(bought), "customer_id bigint, product_id bigint")
    every = sorted({p for _, p in bought})
    for refs in (every[:1], every):
        found = affinity.similar_items(pairs, affinity.references(spark, refs), 5)
        assert sorted(tuple(r) for r in found.collect()) == brute_force(bought, refs, 5)


def test_only_short_lists_are_broadcast(spark, monkeypatch, with_conf):
    with_conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 3)], "customer_id bigint, product_id bigint")
    best = affinity.best_sellers(pairs, 1)
    bounded, unbounded = affinity.similar_items(pairs, best, 5, 1), affinity.similar_items(pairs, best)
    assert "BroadcastHashJoin" in plan_of(bounded)
    assert "BroadcastHashJoin" not in plan_of(unbounded)
    monkeypatch.setattr(affinity, "BROADCAST_REFERENCES", 0)
    assert "BroadcastHashJoin" not in plan_of(affinity.similar_items(pairs, best, 5, 1))
    assert rows(bounded) == rows(unbounded)


def test_base_tables_are_joined_once(spark):
    """All uses of the pairs share one shuffle of the joined tables."""
    plan = plan_of(QUERIES["similar_to_reference"](spark, SMALL))
    lines = plan.count("lineitem.parquet")
    shared = plan_after(QUERIES["similar_to_reference"](spark, SMALL))
    assert lines >= 3 and shared.count("lineitem.parquet") == 1
    assert shared.count("ReusedExchange") >= 3


def test_repeated_references_count_once(spark):
    pairs = spark.createDataFrame([(1, 0), (1, 2), (2, 0), (2, 2)], "customer_id bigint, product_id bigint")
    twice = spark.createDataFrame([(0,), (0,)], "product_id bigint")
    assert rows(affinity.co_buyers(pairs, twice)) == [(0, 2, 2)]
    assert affinity.similar_items(pairs, twice).first()["similarity"] == 1.0


def test_leaders_and_names(spark):
    p = products(spark, range(6), lambda i: i % 2)
    bought = [(1, 0), (2, 0), (1, 2), (2, 2), (3, 4), (1, 1), (1, 3), (2, 3)]
    pairs = spark.createDataFrame(bought, "customer_id bigint, product_id bigint")
    assert rows(affinity.category_leaders(pairs, p)) == [(0, 0), (1, 3)]
    assert affinity.count_categories(p) == 2
    found = recommendations(pairs, affinity.category_leaders(pairs, p), p, 1)
    assert rows(found.select("reference_id", "product_id", "product")) == [(0, 2, "product 2"), (3, 0, "product 0")]


def test_equal_similarities_rank_by_id(spark):
    """co/sqrt(n) is the same for 3 of 9x and 1 of x buyers; the id decides."""
    bought = [(c, 0) for c in range(3)]
    bought += [(c, 9) for c in range(3)] + [(100 + c, 9) for c in range(6)]
    bought += [(0, 4)]
    pairs = spark.createDataFrame(bought, "customer_id bigint, product_id bigint")
    found = affinity.similar_items(pairs, affinity.references(spark, [0])).orderBy("position")
    assert [r["product_id"] for r in found.collect()] == [4, 9]


def test_unlisted_products_stay(spark):
    pairs = spark.createDataFrame([(1, 0), (1, 7), (1, 1)], "customer_id bigint, product_id bigint")
    found = recommendations(pairs, affinity.references(spark, [0]), products(spark, [0, 1]), 5)
    assert rows(found.select("product_id", "product")) == [(1, "product 1"), (7, None)]
