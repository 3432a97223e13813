"""Monthly demand per product and the walk-forward moving-average baseline."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.dates import month
from tidebook.functions.numbers import exact_units, millionths, whole_units


def monthly_units(orders: DataFrame, items: DataFrame, fractional: bool = False) -> DataFrame:
    """Units sold per product and month, for the cells that have any. ``fractional`` units are a
    decimal of six places; otherwise they are whole, and a fraction stops the query."""
    units = exact_units if fractional else whole_units
    sold = items.join(orders.select("order_id", "order_date"), "order_id")
    return sold.groupBy("product_id", month(F.col("order_date")).alias("month")).agg(
        units(F.sum(millionths(F.col("quantity")))).alias("units")
    )


def dense_months(
    units: DataFrame, products: DataFrame, lo: date | Column, hi: date | Column
) -> DataFrame:
    """One row per product and month from ``lo`` to ``hi``; months without a sale count 0.

    ``units`` holds the non-empty cells, each once. They are shuffled by product together with
    one empty cell per catalogued product, and each then unfolds into itself and the empty months
    up to the next one. The grid is never crossed and never travels. A product is kept whether
    the catalogue or only a sale names it.
    """
    first, last = _month(lo), _month(hi)
    empty = F.lit(0).cast(units.schema["units"].dataType)
    sold = units.filter(F.col("month").between(first, last)).withColumn("listed", F.lit(False))
    listed = (
        products.select("product_id")
        .distinct()
        .select(
            "product_id", first.alias("month"), empty.alias("units"), F.lit(True).alias("listed")
        )
    )
    by_month = Window.partitionBy("product_id").orderBy(F.asc("month"), F.desc("listed"))
    cells = sold.unionByName(listed).select(
        "product_id",
        "month",
        "units",
        "listed",
        F.lag("month").over(by_month).alias("before"),
        F.lead("month").over(by_month).alias("after"),
    )
    # An empty first cell gives way to a sale in the same month.
    needed = cells.filter(~F.col("listed") | ~F.col("month").eqNullSafe(F.col("after")))
    start = F.when(F.col("before").isNull(), first).otherwise(F.col("month"))
    until = F.coalesce(F.add_months("after", -1), last)
    unfolded = needed.select(
        "product_id",
        F.explode(F.sequence(start, until, F.expr("interval 1 month"))).alias("cell_month"),
        "month",
        "units",
    )
    return unfolded.select(
        "product_id",
        F.col("cell_month").alias("month"),
        F.when(F.col("cell_month") == F.col("month"), F.col("units")).otherwise(0).alias("units"),
    )


def moving_average(dense: DataFrame, window: int = 3) -> DataFrame:
    """One-step-ahead forecast: the mean of the ``window`` months before, never the month itself.

    Needs a dense series, or the frame would reach over missing months. The forecast is null
    until ``window`` months of history exist. ``history`` keeps the exact sum behind the mean.
    """
    before = Window.partitionBy("product_id").orderBy("month").rowsBetween(-window, -1)
    known = dense.select(
        "product_id",
        "month",
        F.col("units").alias("actual"),
        F.when(F.count("*").over(before) == window, F.sum("units").over(before)).alias("history"),
    )
    predicted = F.col("history").cast("double") / window
    return known.withColumn("predicted", predicted).withColumn(
        "abs_error", F.abs(F.col("actual") - F.col("predicted"))
    )


def forecast_error(forecast: DataFrame, window: int = 3, by: list[str] | None = None) -> DataFrame:
    """Mean absolute error and the rounded sum of the forecasts, overall or per group.

    Errors are added up as whole ``window``-ths and divided once, so the result does not depend
    on the order of the rows.
    """
    scored = forecast.filter(F.col("history").isNotNull())
    scaled_error = F.sum(F.abs(F.col("actual") * window - F.col("history")))
    predicted_sum = F.sum("history").cast("double") / window
    return scored.groupBy(*(by or [])).agg(
        F.count("*").alias("n_forecasts"),
        (scaled_error.cast("double") / (F.count("*") * window)).alias("mae"),
        predicted_sum.alias("predicted_sum"),
        F.rint(predicted_sum).cast("bigint").alias("predicted_sum_rounded"),
    )


def _month(value: date | Column) -> Column:
    return month(value if isinstance(value, Column) else F.lit(value))
