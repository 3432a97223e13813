"""Average sales per weekday over every calendar day, days without a sale included."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.dates import day
from tidebook.functions.numbers import cents, from_cents, ratio, round2, wide_sum
from tidebook.operators.calendar import calendar, fill_calendar, fill_gaps, with_weekday

# The two labels of the published weekday table.
WORST = "Pior média"
OTHER = "Demais dias"

MEASURES = ["cents", "n_orders"]


def daily_sales(
    orders: DataFrame,
    channel: str | list[str] | None = None,
    lo: date | None = None,
    hi: date | None = None,
) -> DataFrame:
    """Sales of one channel (or several) per day, without missing days.

    With given bounds the channel and date filters go down to the scan and a calendar is joined.
    Without them the calendar spans all orders, whatever their channel; one pass over the orders
    then collects both the bounds and the channel's sales.
    """
    if (lo is None) != (hi is None):
        raise ValueError("give both bounds of the calendar or none")
    wanted = F.lit(True) if channel is None else F.col("channel").isin(channel)
    if lo is not None:
        inside = orders.filter(
            wanted & (F.col("order_date") >= F.lit(lo)) & (F.col("order_date") < F.lit(hi + timedelta(1)))
        )
        daily = inside.groupBy(day(F.col("order_date")).alias("date")).agg(
            F.sum(cents(F.col("total"))).alias("cents"), F.count("*").alias("n_orders")
        )
        filled = fill_calendar(daily, calendar(orders.sparkSession, lo, hi), MEASURES)
    else:
        daily = (
            orders.filter(F.col("order_date").isNotNull())
            .groupBy(day(F.col("order_date")).alias("date"))
            .agg(
                F.coalesce(F.sum(F.when(wanted, cents(F.col("total")))), F.lit(0)).alias("cents"),
                F.count_if(wanted).alias("n_orders"),
            )
        )
        filled = fill_gaps(daily, MEASURES)
    return with_weekday(filled)


def daily_totals(daily: DataFrame) -> DataFrame:
    return daily.select(
        "date", "weekday", "weekday_name", "n_orders", from_cents(F.col("cents")).alias("total_value")
    )


def weekday_average(
    orders: DataFrame,
    channel: str | list[str] | None = None,
    lo: date | None = None,
    hi: date | None = None,
) -> DataFrame:
    """Per weekday: calendar days, days without a sale, total, mean per calendar day, label.

    One weekday is the worst: the lowest mean before rounding, the earlier one on a tie.
    """
    per_weekday = (
        daily_sales(orders, channel, lo, hi)
        .groupBy("weekday", "weekday_name")
        .agg(
            F.count("*").alias("calendar_days"),
            F.count_if(F.col("n_orders") == 0).alias("days_without_sales"),
            wide_sum(F.col("cents")).alias("cents"),
        )
    )
    total = from_cents(F.col("cents"))
    averaged = per_weekday.select(
        "weekday",
        "weekday_name",
        round2(ratio(total, F.col("calendar_days"))).alias("average_sales"),
        "calendar_days",
        "days_without_sales",
        total.alias("total_value"),
    )
    # One row per weekday: the window sees seven.
    mean = F.coalesce(ratio(F.col("total_value"), F.col("calendar_days")), F.lit(0.0))
    worst = F.min(F.struct(mean, "weekday")).over(Window.partitionBy())["weekday"]
    return averaged.withColumn(
        "label", F.when(F.col("weekday") == worst, WORST).otherwise(OTHER)
    ).orderBy("weekday")


def worst_weekday(weekdays: DataFrame) -> DataFrame:
    """The weekday with the lowest average; the earlier one on a tie."""
    return weekdays.filter(F.col("label") == WORST).select("weekday", "weekday_name", "average_sales")
