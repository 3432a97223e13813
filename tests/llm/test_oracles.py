import pytest
from check_oracles import compare, duckdb_tables
from tidebook.llm.oracles import ORACLES
from tidebook.llm.queries import QUERIES

import __spark_entry__ as registered

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duckdb_tables(SMALL)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_its_sql(spark, connection, name):
    assert compare(spark, connection, name, SMALL) is None


def test_all_are_registered():
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLES.items() <= registered.oracle_sql().items()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
