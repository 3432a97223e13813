import random
from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from helpers import plan_of, rows
from entities import items, orders, products
from pyspark.sql import functions as F

from tidebook.functions.dates import add_months
from tidebook.operators.demand import dense_months, forecast_error, monthly_units, moving_average
from tidebook.plans.demand import demand_forecast, monthly_demand, most_sold

# Published actuals, forecasts and errors of three test months, with the history
# that leads to them.
HISTORY = [34, 60, 22]
ACTUAL = [79, 68, 60]
PREDICTED = [38.666666666666664, 53.666666666666664, 56.333333333333336]
ERRORS = [40.333333333333336, 14.333333333333336, 3.6666666666666643]
MAE = 19.444444444444443
PREDICTED_SUM = 149


def series(spark, product=1):
    o, i = [], []
    for k, units in enumerate(HISTORY + ACTUAL):
        month = add_months(date(2025, 10, 1), k)
        o.append((k, 1, month.isoformat(), 1.0, "s", "paid"))
        i += [(k, product, units - 10), (k, product, 10)]
    return orders(spark, o), items(spark, i)


def test_published_forecast(spark):
    o, i = series(spark)
    forecast = demand_forecast(o, i, products(spark, [1]), date(2026, 1, 1), date(2026, 3, 1))
    found = forecast.orderBy("month").collect()
    assert [r["actual"] for r in found] == ACTUAL
    assert [r["predicted"] for r in found] == PREDICTED
    assert [r["abs_error"] for r in found] == ERRORS
    error = forecast_error(forecast).first()
    assert error["n_forecasts"] == 3
    assert error["mae"] == pytest.approx(MAE, abs=1e-12)
    assert error["predicted_sum_rounded"] == PREDICTED_SUM


def test_no_forecast_without_full_history(spark):
    o, i = series(spark)
    first = o.agg({"order_date": "min"}).first()[0]
    start = first.date().replace(day=1) if hasattr(first, "date") else first.replace(day=1)
    forecast = demand_forecast(o, i, products(spark, [1]), add_months(start, -2), add_months(start, 3))
    found = forecast.orderBy("month").collect()
    assert [r["month"] for r in found] == [add_months(start, k) for k in range(4)]
    assert [r["predicted"] is None for r in found] == [True, True, True, False]
    assert forecast_error(forecast).first()["n_forecasts"] == 1


def test_months_after_the_last_order_are_not_scored(spark):
    o, i = series(spark)
    assert demand_forecast(o, i, products(spark, [1]), date(2040, 1, 1), date(2040, 3, 1)).count() == 0
    assert demand_forecast(o.limit(0), i, products(spark, [1]), date(2025, 1, 1), date(2025, 3, 1)).count() == 0


def test_fractions_add_up_to_whole_units(spark):
    o = orders(spark, [(1, 1, "2024-01-15", 1.0, "s", "p")])
    i = spark.createDataFrame([(1, 1, 2.5), (1, 1, 2.5)], "order_id bigint, product_id bigint, quantity double")
    assert [r.units for r in monthly_units(o, i).collect()] == [5]
    with pytest.raises(Exception, match="not whole"):
        monthly_units(o, i.limit(1)).collect()


def test_fractional_units(spark):
    o = orders(spark, [(1, 1, "2024-01-15", 1.0, "s", "p"), (2, 1, "2024-02-15", 1.0, "s", "p")])
    i = spark.createDataFrame([(1, 1, 2.4), (1, 1, 2.5), (2, 1, 0.000001), (2, 1, None)], "order_id bigint, product_id bigint, quantity double")
    assert sorted(r.units for r in monthly_units(o, i, fractional=True).collect()) == [Decimal("0.000001"), Decimal("4.9")]


def test_empty_months_count_as_zero(spark):
    o = orders(
        spark,
        [(1, 1, "2024-01-15", 1.0, "s", "p"), (2, 1, "2024-05-20", 1.0, "s", "p"), (3, 1, "2024-06-01", 1.0, "s", "p")],
    )
    i = items(spark, [(1, 1, 9), (2, 1, 4)])
    found = demand_forecast(o, i, products(spark, [1]), date(2024, 4, 1), date(2024, 6, 1))
    assert rows(found.select("month", "actual", "predicted")) == [
        (date(2024, 4, 1), 0, 3.0),
        (date(2024, 5, 1), 4, 0.0),
        (date(2024, 6, 1), 0, 4 / 3),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_grid_and_forecast_against_brute_force(spark, seed):
    """Products that never sold, and products no catalogue lists, are in the grid."""
    rnd = random.Random(seed)
    months = [add_months(date(2023, 6, 1), k) for k in range(14)]
    o = [(k, 1, months[rnd.randrange(14)].replace(day=rnd.randint(1, 28)).isoformat(), 1.0, "s", "p") for k in range(60)]
    i = [(rnd.randint(0, 70), rnd.choice([1, 2, 3, 50]), rnd.randint(1, 9)) for _ in range(150)]
    listed = [1, 2, 3, 4]
    when = {k: date.fromisoformat(d).replace(day=1) for k, _, d, *_ in o}
    cells = defaultdict(int)
    for k, p, q in i:
        if k in when:
            cells[p, when[k]] += q
    lo, hi = min(when.values()), max(when.values())
    span = [m for m in months if lo <= m <= hi]
    grid = sorted((p, m, cells[p, m]) for p in [*listed, 50] for m in span)

    frames = orders(spark, o), items(spark, i), products(spark, listed)
    dense = monthly_demand(*frames)
    assert sorted(tuple(r) for r in dense.collect()) == grid

    by_cell = {(p, m): u for p, m, u in grid}
    expected = []
    for p, m, u in grid:
        before = [by_cell.get((p, add_months(m, -k))) for k in (1, 2, 3)]
        history = None if None in before else sum(before)
        expected.append((p, m, u, history, None if history is None else history / 3))
    averaged = moving_average(dense).drop("abs_error")
    assert sorted((tuple(r) for r in averaged.collect()), key=lambda r: r[:2]) == expected

    last = span[-3]
    limited = demand_forecast(*frames, last, hi).drop("abs_error")
    wanted = [r for r in expected if r[1] >= last]
    sold_recently = {p for p, m in cells if m >= add_months(last, -3)}
    wanted = [r for r in wanted if r[0] in listed or r[0] in sold_recently]
    assert sorted((tuple(r) for r in limited.collect()), key=lambda r: r[:2]) == wanted


def test_errors_are_exact_for_any_window(spark):
    rnd = random.Random(5)
    units = [(p, add_months(date(2024, 1, 1), m), rnd.randint(0, 50)) for p in range(20) for m in range(12)]
    df = spark.createDataFrame(units, "product_id bigint, month date, units bigint")
    for window in (1, 2, 5):
        found = forecast_error(moving_average(df, window), window).first()
        by = {(p, m): u for p, m, u in units}
        errors, total = 0, 0
        n = 0
        for p in range(20):
            for m in range(window, 12):
                history = sum(by[p, add_months(date(2024, 1, 1), m - k)] for k in range(1, window + 1))
                errors += abs(window * by[p, add_months(date(2024, 1, 1), m)] - history)
                total += history
                n += 1
        assert found["n_forecasts"] == n
        assert found["mae"] == errors / (window * n)
        assert found["predicted_sum"] == total / window


def test_most_sold(spark):
    i = items(spark, [(1, 5, 3), (2, 4, 2), (3, 4, 1), (3, 9, 1)])
    assert most_sold(i) == 4


def test_only_needed_months_are_read_and_nothing_is_crossed(spark):
    from tidebook.plans.registry import demand_forecast as registered
    from tidebook.plans.registry import monthly_demand_dense

    plan = plan_of(registered(spark, "/root/testdata/sf0.001"))
    assert "GreaterThanOrEqual(o_orderdate,2001-02-01" in plan
    assert "LessThan(o_orderdate,2001-08-01" in plan
    for p in (plan, plan_of(monthly_demand_dense(spark, "/root/testdata/sf0.001"))):
        assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_units_of_unknown_orders_are_not_counted(spark):
    o = orders(spark, [(1, 1, "2024-01-15", 1.0, "s", "p")])
    units = monthly_units(o, items(spark, [(1, 1, 2), (9, 1, 5)]))
    assert rows(units) == [(1, date(2024, 1, 1), 2)]
    dense = dense_months(units, products(spark, [1, 2]), date(2024, 1, 1), date(2024, 2, 1))
    assert rows(dense.select("product_id", "units")) == [(1, 0), (1, 2), (2, 0), (2, 0)]


def test_repeated_catalogue_entries_add_no_rows(spark):
    cells = [(1, date(2024, 1, 1), 5), (2, date(2024, 2, 1), 4)]
    units = spark.createDataFrame(cells, "product_id bigint, month date, units bigint")
    dense = dense_months(units, products(spark, [1, 1, 2, 2, 2, 3]), date(2024, 1, 1), date(2024, 2, 1))
    assert rows(dense.select("product_id", F.month("month"), "units")) == [
        (1, 1, 5),
        (1, 2, 0),
        (2, 1, 0),
        (2, 2, 4),
        (3, 1, 0),
        (3, 2, 0),
    ]
