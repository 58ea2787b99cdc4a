"""Numeric value functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of IEEE half precision.
HALF_MAX = 65504.0
HALF_MIN_EXPONENT = -14
HALF_FRACTION_BITS = 10


def half_round(col: Column) -> Column:
    """A number as it reads after storage in half precision.

    Goes through single precision first, rounds half to even, keeps
    subnormals, and turns what does not fit into a signed infinity.
    """
    x = col.cast("float").cast("double")
    exponent = F.greatest(F.floor(F.log2(F.abs(x))), F.lit(HALF_MIN_EXPONENT))
    unit = F.pow(F.lit(2.0), (exponent - HALF_FRACTION_BITS).cast("double"))
    rounded = F.rint(x / unit) * unit
    infinite = F.when(x < 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (F.when(x.isNull() | F.isnan(x) | (x == 0), x)
            .when(F.abs(x) == float("inf"), x)
            .when(F.abs(rounded) > HALF_MAX, infinite)
            .otherwise(rounded)).cast("float")


def ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient in double precision, NULL over zero."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.when(bottom != 0, bottom)


def metric_round(col: Column) -> Column:
    return F.round(col, 6)
