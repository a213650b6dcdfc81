"""Order-independent sums and averages of DOUBLE columns.

A floating-point ``sum`` depends on the order in which partitions are merged, so the last digit
of a rounded average can change between runs. Amounts are therefore summed as two BIGINT counts,
of 1/10000 and of what is left in units of 1e-12: associative, exact to that unit, and cheaper than
DECIMAL (long arithmetic inside codegen). The two sums meet in one DECIMAL(38, 0) after it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

COARSE = 10_000         # parts of the first sum
UNITS = 10 ** 12        # parts of the result
UNITS_TYPE = "decimal(38,0)"


def sum_units(name: str) -> Column:
    """Sum of a DOUBLE column in units of 1e-12; NULL when there is no value."""
    value = F.col(name)
    coarse = F.floor(value * COARSE + 0.5)
    # a value of at most four decimals equals its coarse part, so nothing is left of it
    rest = F.floor((value - coarse / float(COARSE)) * float(UNITS) + 0.5)
    return (F.sum(coarse).cast(UNITS_TYPE) * F.lit(UNITS // COARSE).cast("decimal(9,0)")
            + F.sum(rest).cast(UNITS_TYPE)).cast(UNITS_TYPE)


def amount(units: Column, digits: int = 2) -> Column:
    return F.round(units.cast("double") / F.lit(float(UNITS)), digits)


def mean(units: Column, count: Column, digits: int) -> Column:
    """Average of the non-null values, NULL when there are none."""
    return F.round(units.cast("double") / F.nullif(count * F.lit(float(UNITS)), F.lit(0.0)), digits)
