"""Gap-free calendars and daily series without missing days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.functions.dates import day, iso_weekday, weekday_name


def calendar(spark: SparkSession, lo: date | Column, hi: date | Column) -> DataFrame:
    """One row per date from ``lo`` to ``hi``, both included, with weekday attributes."""
    dates = spark.range(1).select(F.explode(F.sequence(_date(lo), _date(hi))).alias("date"))
    return with_weekday(dates).select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        "weekday",
        "weekday_name",
    )


def with_weekday(df: DataFrame) -> DataFrame:
    numbered = df.withColumn("weekday", iso_weekday(F.col("date")))
    return numbered.withColumn("weekday_name", weekday_name(F.col("weekday")))


def observed_bounds(df: DataFrame, column: str) -> tuple[Column, Column]:
    """First and last day in ``column`` as scalar subqueries over one single-column scan."""
    days = df.select(day(F.col(column)).alias("d"))
    return days.agg(F.min("d")).scalar(), days.agg(F.max("d")).scalar()


def fill_calendar(daily: DataFrame, days: DataFrame, measures: list[str]) -> DataFrame:
    """Calendar LEFT JOIN daily rows; days without a row get 0 in every measure.

    Both sides hold at most one row per date, so AQE is left to pick the join.
    """
    return days.select("date").join(daily, "date", "left").select(
        "date", *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures]
    )


def fill_gaps(daily: DataFrame, measures: list[str]) -> DataFrame:
    """The same for a calendar that runs from the first to the last day in ``daily``.

    Each row is followed by the days up to the next row, so no second pass over the source is
    needed to learn the bounds. The window has one partition, but only one row per date.
    """
    upcoming = F.date_sub(F.lead("date").over(Window.orderBy("date")), 1)
    stretched = daily.withColumn("until", F.coalesce(upcoming, F.col("date")))
    return stretched.select(
        F.explode(F.sequence("date", "until")).alias("calendar_date"), "date", *measures
    ).select(
        F.col("calendar_date").alias("date"),
        *[F.when(F.col("calendar_date") == F.col("date"), F.col(m)).otherwise(0).alias(m) for m in measures],
    )


def _date(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")
