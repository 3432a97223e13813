"""Calendar helpers that do not depend on session locale or time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names of the published weekday table, Monday first.
WEEKDAY_NAMES = (
    "Segunda-feira",
    "Terça-feira",
    "Quarta-feira",
    "Quinta-feira",
    "Sexta-feira",
    "Sábado",
    "Domingo",
)


def day(moment: Column) -> Column:
    return moment.cast("date")


def month(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day(moment), "MM").cast("date")


def iso_weekday(moment: Column) -> Column:
    """Monday = 1 to Sunday = 7."""
    return (F.weekday(day(moment)) + 1).cast("int")


def weekday_name(iso: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAY_NAMES]), iso)


def add_months(first_of_month: date, n: int) -> date:
    """Driver-side month arithmetic for query parameters."""
    index = first_of_month.year * 12 + first_of_month.month - 1 + n
    return date(index // 12, index % 12 + 1, 1)
