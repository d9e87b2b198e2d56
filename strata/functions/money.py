"""Exact money: whole units in a ``bigint`` inside, doubles only at the edge.

Sums of doubles depend on the order in which partitions arrive. Sums of whole
units do not, and a plain ``sum`` that overflows raises an error (ANSI mode)
instead of giving a wrong number. Where one group may hold a large part of a
very large table, ``exact_sum`` has no such limit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits after the point that order amounts may carry.
ORDER_DIGITS = 4
#: Sales events are rounded to cents when they are cleaned.
CENT_DIGITS = 2


#: Amounts from here on have no whole number of their smallest units in a double.
LARGEST_UNITS = 2.0**53


def to_units(amount: Column, digits: int = CENT_DIGITS) -> Column:
    """Nearest whole number of ``10^-digits``; halves go up.

    Null for an amount that is not finite or too large to be exact: it is no
    money amount, though it may be a fine number.
    """
    units = amount * F.lit(10.0**digits) + F.lit(0.5)
    return F.when(F.abs(units) < LARGEST_UNITS, F.floor(units))


def exact_sum(units: Column) -> Column:
    """Sum of a ``bigint`` column as a decimal; only 2^43 rows or more could overflow its parts.

    The upper and the lower bits are summed on their own, as plain ``bigint``:
    about as fast as one such sum and several times faster than summing
    decimals row by row.
    """
    bits = 20
    upper = F.sum(F.shiftright(units, bits)).cast("decimal(20,0)")
    lower = F.sum(units.bitwiseAND(F.lit(2**bits - 1))).cast("decimal(20,0)")
    return upper * F.lit(2**bits).cast("decimal(7,0)") + lower


def _divide_half_up(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to the nearest integer, halves away from zero."""
    size = F.call_function("div", F.abs(numerator) * 2 + denominator, denominator * 2)
    return F.when(numerator < 0, -size).otherwise(size)


def from_units(units: Column, digits: int = CENT_DIGITS) -> Column:
    """Units back to an amount with two decimals."""
    if digits > CENT_DIGITS:
        units = _divide_half_up(units, F.lit(10 ** (digits - CENT_DIGITS)).cast("bigint"))
    return units / F.lit(100.0)


def mean_from_units(total: Column, rows: Column, digits: int = CENT_DIGITS) -> Column:
    """Mean amount with two decimals; null for no rows."""
    per_cent = 10 ** (digits - CENT_DIGITS)
    return F.when(rows > 0, _divide_half_up(total, rows * per_cent) / F.lit(100.0))
