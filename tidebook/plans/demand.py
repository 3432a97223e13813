"""Demand baseline: monthly units per product against a walk-forward moving average."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.dates import add_months, month
from tidebook.functions.numbers import millionths
from tidebook.operators.calendar import observed_bounds
from tidebook.operators.demand import dense_months, monthly_units, moving_average


def monthly_demand(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """The whole product x month grid between the first and the last order, empty cells as 0."""
    lo, hi = observed_bounds(orders, "order_date")
    return dense_months(monthly_units(orders, items), products, lo, hi)


def most_sold(items: DataFrame) -> int:
    """The id of the product with the most units, the lower id on a tie."""
    units = items.groupBy("product_id").agg(F.sum(millionths(F.col("quantity"))).alias("units"))
    return units.orderBy(F.desc("units"), F.asc("product_id")).first()["product_id"]


def demand_forecast(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    test_from: date,
    test_to: date,
    window: int = 3,
) -> DataFrame:
    """Actual and predicted units of every product for the months ``test_from`` to ``test_to``.

    Only the test months and the ``window`` months before them can matter, so only those orders
    are read. The test filter comes after the window, which needs the history. The series runs from
    the month of the first order to that of the last, whatever they hold: months before are no
    history, so forecasts that would need them are null, and months after are not scored.
    """
    lo = add_months(test_from, -window)
    recent = orders.filter(
        (F.col("order_date") >= F.lit(lo)) & (F.col("order_date") < F.lit(add_months(test_to, 1)))
    )
    first, last = observed_bounds(orders, "order_date")
    # Without orders there are no bounds; greatest and least would pass over the null.
    first = F.when(first.isNotNull(), F.greatest(F.lit(lo), month(first)))
    last = F.when(last.isNotNull(), F.least(F.lit(test_to), month(last)))
    inside = first <= last
    dense = dense_months(
        monthly_units(recent, items), products.filter(inside), F.when(inside, first), F.when(inside, last)
    )
    forecast = moving_average(dense, window)
    return forecast.filter(F.col("month").between(F.lit(test_from), F.lit(test_to)))
