from collections import defaultdict
from datetime import date, timedelta

import pytest
from helpers import plan_of, rows
from entities import orders
from pyspark.sql import functions as F

from tidebook.functions.dates import WEEKDAY_NAMES
from tidebook.operators.calendar import calendar
from tidebook.plans.weekdays import OTHER, WORST, daily_sales, daily_totals, weekday_average, worst_weekday

START = date(2024, 1, 1)  # a Monday


def two_weeks(spark):
    """Thursdays sell most per selling day, but only once; Mondays sell a little every week."""
    data = [
        (1, 1, "2024-01-01", 40.0, "store", "paid"),
        (2, 1, "2024-01-02", 90.0, "store", "paid"),
        (3, 2, "2024-01-03", 90.0, "store", "draft"),
        (4, 2, "2024-01-04", 70.0, "store", "cancelled"),
        (5, 3, "2024-01-05", 90.0, "store", "paid"),
        (6, 3, "2024-01-06", 90.0, "store", "paid"),
        (7, 3, "2024-01-07", 90.0, "store", "paid"),
        (8, 1, "2024-01-08", 40.0, "store", "confirmed"),
        (9, 1, "2024-01-09", 30.0, "store", "paid"),
        (10, 1, "2024-01-09", 60.0, "store", "paid"),
        (11, 1, "2024-01-10", 90.0, "store", "paid"),
        (12, 1, "2024-01-12", 90.0, "store", "paid"),
        (13, 1, "2024-01-13", 90.0, "store", "paid"),
        (14, 1, "2024-01-14", 90.0, "online", "paid"),
    ]
    return orders(spark, data)


def test_days_without_sales_decide_the_worst_weekday(spark):
    found = weekday_average(two_weeks(spark), "store").collect()
    assert [r["weekday"] for r in found] == [1, 2, 3, 4, 5, 6, 7]
    by_day = {r["weekday"]: r for r in found}
    assert by_day[4]["average_sales"] == 35.0 and by_day[4]["days_without_sales"] == 1
    assert by_day[1]["average_sales"] == 40.0 and by_day[1]["days_without_sales"] == 0
    # The last Sunday sold online only: inside the calendar, without a sale in the store.
    assert by_day[7]["calendar_days"] == 2 and by_day[7]["days_without_sales"] == 1
    assert [r["weekday"] for r in found if r["label"] == WORST] == [4]
    assert sum(r["label"] == OTHER for r in found) == 6
    worst = worst_weekday(weekday_average(two_weeks(spark), "store")).first()
    assert tuple(worst) == (4, "Quinta-feira", 35.0)


def test_every_status_counts(spark):
    total = sum(r["total_value"] for r in weekday_average(two_weeks(spark)).collect())
    assert total == sum(r["total"] for r in two_weeks(spark).collect())


@pytest.mark.parametrize("channel", ["store", "online", "none", ["store", "online"], None])
def test_given_bounds_agree_with_observed_bounds(spark, channel):
    observed = weekday_average(two_weeks(spark), channel)
    given = weekday_average(two_weeks(spark), channel, START, START + timedelta(13))
    assert rows(observed) == rows(given)


@pytest.mark.parametrize("type_name", ["date", "timestamp", "timestamp_ntz"])
def test_order_dates_of_any_type(spark, type_name):
    typed = two_weeks(spark).withColumn("order_date", F.col("order_date").cast(type_name))
    expected = rows(weekday_average(two_weeks(spark), "store"))
    assert rows(weekday_average(typed, "store")) == expected
    assert rows(weekday_average(typed, "store", START, START + timedelta(13))) == expected


def test_one_bound_is_an_error(spark):
    with pytest.raises(ValueError, match="both bounds"):
        daily_sales(two_weeks(spark), lo=START)


def test_bounds_reach_beyond_the_orders(spark):
    daily = daily_sales(two_weeks(spark), "store", START - timedelta(3), START + timedelta(20))
    found = daily_totals(daily).collect()
    assert len(found) == 24
    assert sum(r["total_value"] for r in found) == 960.0


def test_bounds_cut_orders_at_midnight(spark):
    late = orders(spark, [(1, 1, "2024-01-02 23:59:59", 5.0, "s", "p"), (2, 1, "2024-01-03", 7.0, "s", "p")])
    found = rows(daily_totals(daily_sales(late, None, date(2024, 1, 1), date(2024, 1, 2))))
    assert [(r[0], r[4]) for r in found] == [(date(2024, 1, 1), 0.0), (date(2024, 1, 2), 5.0)]


def test_orders_without_a_date_are_left_out(spark):
    data = two_weeks(spark).unionByName(orders(spark, [(99, 1, None, 1000.0, "store", "paid")]))
    assert rows(weekday_average(data, "store")) == rows(weekday_average(two_weeks(spark), "store"))


def test_daily_series_against_python(spark):
    data = two_weeks(spark)
    expected = defaultdict(float)
    for r in data.collect():
        if r["channel"] == "store":
            expected[r["order_date"].date()] += r["total"]
    found = daily_totals(daily_sales(data, "store")).collect()
    assert {r["date"]: r["total_value"] for r in found} == {
        START + timedelta(i): expected[START + timedelta(i)] for i in range(14)
    }


def test_calendar_counts_of_seven_years(spark):
    """Weekday counts of 2020-01-01 to 2026-12-31, Monday first."""
    days = calendar(spark, date(2020, 1, 1), date(2026, 12, 31))
    counts = {r["weekday"]: r["count"] for r in days.groupBy("weekday").count().collect()}
    assert [counts[d] for d in range(1, 8)] == [365, 365, 366, 366, 365, 365, 365]
    first = days.orderBy("date").first()
    assert tuple(first) == (date(2020, 1, 1), 2020, 1, 1, 3, WEEKDAY_NAMES[2])


def test_observed_bounds_scan_the_orders_once(spark):
    from tidebook.plans.registry import weekday_avg_sales, weekday_avg_sales_bounded

    plan = plan_of(weekday_avg_sales(spark, "/root/testdata/sf0.001"))
    assert plan.count("FileScan parquet") == 1
    bounded = plan_of(weekday_avg_sales_bounded(spark, "/root/testdata/sf0.001"))
    assert "EqualTo(o_orderpriority,1-URGENT)" in bounded
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in bounded
