"""Exact money sums, the rounding rule of the published figures, and number rendering."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """A two-decimal amount as whole cents.

    Summing doubles gives a last digit that depends on the order in which partitions arrive, and
    so on retries. Whole cents add up exactly in any order, and cost far less per row than
    ``cast("decimal(18,2)")``, which goes through text. A 64-bit sum holds 92 quadrillion units
    per group; totals over all groups use ``wide_sum``.
    """
    return F.rint(amount * 100).cast("bigint")


def millionths(value: Column) -> Column:
    """A value as whole millionths: exact for values of up to six decimals and twelve digits before
    them, and summed exactly in any order."""
    return F.rint(value.cast("double") * 1_000_000).cast("bigint")


def whole_units(total: Column) -> Column:
    """Summed millionths as a whole number. Parts may be fractions (2.5 + 2.5); a sum that is not
    whole stops the query instead of being cut."""
    units = F.floor(total / 1_000_000).cast("bigint")
    message = F.concat(F.lit("units are not whole: "), (total / 1_000_000).cast("string"))
    return F.when(total % 1_000_000 == 0, units).when(total.isNotNull(), F.raise_error(message).cast("bigint"))


def exact_units(total: Column) -> Column:
    """Summed millionths as a decimal of six places, for goods by weight or length."""
    return (total.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast("decimal(27,6)")


def wide_sum(whole: Column) -> Column:
    """Sum of whole numbers whose total may exceed 64 bits."""
    return F.sum(whole.cast("decimal(20,0)"))


def from_cents(total: Column) -> Column:
    return total.cast("double") / F.lit(100.0)


def round2(value: Column) -> Column:
    """Two decimals: scale the double by 100, round half to even, scale back.

    ``round`` and ``bround`` work on the decimal rendering of the double instead and give
    another second decimal on exact halves.
    """
    return F.rint(value * 100) / F.lit(100.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; null instead of a division by zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def plain_text(value: Column) -> Column:
    """A double as text with its shortest digits and no exponent (57758021.43, not 5.775802143E7)."""
    text = value.cast("string")
    scale = F.when(F.abs(value) >= 1, text.cast("decimal(38,18)").cast("string")).otherwise(
        text.cast("decimal(38,36)").cast("string")
    )
    trimmed = F.regexp_replace(F.regexp_replace(scale, "0+$", ""), r"\.$", ".0")
    return F.when(text.contains("E"), trimmed).otherwise(text)
