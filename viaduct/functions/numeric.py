"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round the scaled value to the nearest integer, ties to even, as numpy does."""
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def round_numeric(value: Column, digits: int) -> Column:
    """Round half up after cutting the noise past the 12th decimal.

    This is what a database does that casts a float to numeric before rounding. It also makes the
    result independent of the order in which an average was summed.
    """
    return F.round(F.round(value, 12), digits)
