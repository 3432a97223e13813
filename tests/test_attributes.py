import itertools

import pytest
from helpers import SMALL, plan_after, plan_of, rows
from pyspark.sql import functions as F

from tidebook.operators import attributes
from tidebook.operators.attributes import long_values, typed_values, usual_spelling, value_problems, wide_values
from tidebook.plans.registry import QUERIES

DICTIONARY = [
    ("color", "text"), ("length_m", "number"), ("waterproof", "boolean"), ("odd", "money"), ("twice", "text"),
    ("twice", "number"), (None, "text"), ("untyped", None),
]

# value, attribute, expected (text, number, boolean, problem)
CASES = [
    ("456.5", "length_m", (None, 456.5, None, None)),
    (" 143.0 ", "length_m", (None, 143.0, None, None)),
    ("\t-7\n", "length_m", (None, -7.0, None, None)),
    ("1e3", "length_m", (None, 1000.0, None, None)),
    ("52.", "length_m", (None, None, None, "not a number")),
    ("23..7", "length_m", (None, None, None, "not a number")),
    ("1e999", "length_m", (None, None, None, "not a number")),
    ("NaN", "length_m", (None, None, None, "not a number")),
    (".", "length_m", (None, None, None, "placeholder")),
    ("true", "waterproof", (None, None, True, None)),
    (" FALSE", "waterproof", (None, None, False, None)),
    ("t", "waterproof", (None, None, None, "not a boolean")),
    ("truue", "waterproof", (None, None, None, "not a boolean")),
    ("fase", "waterproof", (None, None, None, "not a boolean")),
    ("Cinza", "color", ("Cinza", None, None, None)),
    (" Preto ", "color", ("Preto", None, None, None)),
    ("preto", "color", ("preto", None, None, None)),
    ("??", "color", (None, None, None, "placeholder")),
    ("TODO", "color", (None, None, None, "placeholder")),
    ("N/A", "color", (None, None, None, "placeholder")),
    ("", "color", (None, None, None, "missing")),
    ("  ", "color", (None, None, None, "missing")),
    (None, "color", (None, None, None, "missing")),
    ("5", "odd", (None, None, None, "unknown type")),
    ("5", "untyped", (None, None, None, "unknown type")),
    ("5", "twice", (None, 5.0, None, None)),
    ("5", "nowhere", (None, None, None, "unknown attribute")),
    ("5", None, (None, None, None, "unknown attribute")),
    ("x" * 100_000, "color", ("x" * 100_000, None, None, None)),
]


@pytest.fixture
def values(spark):
    data = [(i, a, v, "kept") for i, (v, a, _) in enumerate(CASES)]
    return spark.createDataFrame(data, "entity long, attribute string, value string, problem string").repartition(3)


@pytest.fixture
def dictionary(spark):
    return spark.createDataFrame(DICTIONARY, "attribute string, data_type string")


def test_every_kind_of_value(values, dictionary):
    typed = typed_values(values, dictionary)
    assert typed.columns == ["entity", "attribute", "value", "data_type", "value_text", "value_number", "value_boolean", "problem"]
    found = {r.entity: (r.value_text, r.value_number, r.value_boolean, r.problem) for r in typed.collect()}
    assert found == {i: expected for i, (_, _, expected) in enumerate(CASES)}


def test_good_and_bad_rows_add_up(values, dictionary):
    typed = typed_values(values.union(values), dictionary)
    counts = value_problems(typed).collect()
    assert sum(r.n_rows for r in counts) == 2 * len(CASES)
    for r in typed.collect():
        assert sum(x is not None for x in (r.value_text, r.value_number, r.value_boolean)) == (r.problem is None)


def test_spellings(spark, dictionary):
    data = [(1, "color", c) for c in ["Preto", "Preto", "preto", "PRETO", "Azul", "azul"]]
    typed = typed_values(spark.createDataFrame(data, "entity long, attribute string, value string"), dictionary)
    found = {r.value_text: r.usual for r in usual_spelling(typed).collect()}
    assert found == {"Preto": "Preto", "preto": "Preto", "PRETO": "Preto", "Azul": "Azul", "azul": "Azul"}


def test_wide_rows(spark, dictionary):
    data = [
        (1, "color", "b", 5), (1, "color", "a", 9), (1, "color", "n/a", 1), (1, "length_m", "7", None), (1, "length_m", "9", 3),
        (2, "waterproof", "no", 1), (None, "waterproof", "true", 1), (3, "size", "4", 1), (1, "color", "a", 9),
    ]
    df = spark.createDataFrame(data, "entity long, attribute string, value string, seen int")
    typed = typed_values(df, dictionary)
    types = {"color": "text", "length_m": "number", "waterproof": "boolean"}
    assert rows(wide_values(typed, types, ["seen"])) == sorted(
        [(1, "b", 9.0, None), (2, None, None, None), (None, None, None, True), (3, None, None, None)], key=repr
    )
    assert (1, "a", 7.0, None) in rows(wide_values(typed, types))
    with pytest.raises(ValueError):
        wide_values(typed, {"color": "money"})


def test_names_need_no_job(spark, values, dictionary):
    typed = typed_values(values, dictionary)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    plan = plan_of(wide_values(typed, {"color": "text", "length_m": "number"}, ["value"]))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert "Pivot" not in plan and plan.count("partial_min") >= 2


def test_empty_tables(values, dictionary):
    assert typed_values(values.limit(0), dictionary).collect() == []
    assert {r.problem for r in typed_values(values, dictionary.limit(0)).collect()} == {"unknown attribute"}
    assert wide_values(typed_values(values.limit(0), dictionary), {"color": "text"}).collect() == []


def test_long_rows_unfold_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "id long, name string, size double")
    long = long_values(df, "id", {"name": df["name"], "size": df["size"]})
    assert rows(long) == sorted([(1, "name", "a"), (1, "size", "2.5"), (2, "name", None), (2, "size", None)], key=repr)
    assert "Exchange" not in plan_of(long)


def test_blanks_around_a_value_go_as_the_pattern_takes_them(spark):
    """The plain trim gives what the pattern gives, before ends of lines that Java knows too."""
    parts = ["", " ", "\t", "\n", "\r\n", "\x0b\f", "\x85", " ", " ", "\x1c", "\xa0", "a", "é"]
    texts = ["".join(t) for t in itertools.product(parts, repeat=4)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "value string")
    by_pattern = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    assert df.filter(~attributes._trimmed(F.col("value")).eqNullSafe(by_pattern)).collect() == []


@pytest.mark.parametrize("name", ["typed_event_values", "event_value_problems", "event_value_spellings", "users_wide"])
def test_values_are_not_shuffled_by_attribute(spark, name):
    """There are few attributes, and most rows of a task would be of one."""
    before_grouping = plan_of(QUERIES[name](spark, SMALL)).split("Generate explode")[0]
    joins = [line for line in before_grouping.splitlines() if "LeftOuter" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)


def test_values_are_typed_once_for_both_sides_of_the_spellings(spark):
    plan = plan_after(QUERIES["event_value_spellings"](spark, SMALL))
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1
