"""What kind of value a piece of text holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms of each type.
INTEGER = r"^-?[0-9]+\z"
DECIMAL = r"^-?[0-9]+\.[0-9]+\z"
LEADING_ZERO = r"^-?0[0-9]"
BOOLEANS = ("true", "false", "TRUE", "FALSE", "True", "False")
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z"


def kind(value: Column) -> Column:
    """One of int, dec, bool, date, ts, text; null for null.

    The kinds exclude each other. Cheap comparisons leave at most two patterns to run per value:
    numbers, dates and times all start with a character from "-" to "9". Dates and timestamps
    must also exist: 2026-02-30 is text.
    """

    def text_unless(test: Column, name: str) -> Column:
        return F.when(test, name).otherwise("text")

    def exists(pattern: str, type_name: str) -> Column:
        return value.rlike(pattern) & value.try_cast(type_name).isNotNull()

    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when((value < "-") | (value >= ":"), text_unless(value.isin(*BOOLEANS), "bool"))
        .when(value.rlike(INTEGER), "int")
        .when(value.contains(":"), text_unless(exists(TIMESTAMP, "timestamp_ntz"), "ts"))
        .when(value.contains("."), text_unless(value.rlike(DECIMAL), "dec"))
        .otherwise(text_unless(exists(DATE, "date"), "date"))
    )


def has_leading_zero(number: Column) -> Column:
    """A zero in front of another digit, as only identifiers have."""
    return (number.startswith("0") | number.startswith("-0")) & number.rlike(LEADING_ZERO)


def whole_digits(number: Column) -> Column:
    """Digits before the decimal point."""
    dot = F.instr(number, ".")
    end = F.when(dot > 0, dot - 1).otherwise(F.length(number))
    return end - number.startswith("-").cast("int")


def scale_digits(number: Column) -> Column:
    """Digits after the decimal point."""
    dot = F.instr(number, ".")
    return F.when(dot > 0, F.length(number) - dot).otherwise(0)
