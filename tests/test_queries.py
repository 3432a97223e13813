import pytest
from check_oracles import compare, duckdb_tables
from helpers import SMALL, plan_of

import __spark_entry__ as registered
from tidebook.plans.oracles import ORACLES
from tidebook.plans.registry import QUERIES


@pytest.fixture(scope="module")
def connection():
    return duckdb_tables(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    assert compare(spark, connection, name, SMALL) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLES.items() <= registered.oracle_sql().items()


def test_entry(spark):
    assert registered.entry(spark).count() == 7


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("mart", "published", "load"))])
def test_plans_stay_in_the_jvm_and_cross_nothing(spark, name):
    plan = plan_of(registered.queries()[name](spark, SMALL))
    for operator in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan


def test_overview_tables(spark):
    from tidebook.plans.overview import sales_overview
    from tidebook.plans.registry import QUERIES
    from tidebook.sources import star

    for name, df in sales_overview(star.orders(spark, SMALL)).items():
        assert sorted(df.collect()) == sorted(QUERIES[name](spark, SMALL).collect())
