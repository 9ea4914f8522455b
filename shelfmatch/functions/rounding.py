"""Rounding that agrees with IEEE half-even rounding of the binary value.

Spark's ``round`` works on the printed decimal and rounds half up, so 2.675
becomes 2.68 although the stored double lies below the tie.  The helpers here
decide ties on the stored value and stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(col: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, ties (of the exact value) to even."""
    scale = float(10**digits)
    x = col.cast("double")
    # x * scale = y + e without error: the float part of x has 24 bits, so its
    # product with the scale is exact, and so is the product of the remainder.
    head = x.cast("float").cast("double")
    y = x * scale
    e = (head * scale - y) + (x - head) * scale
    low = F.floor(y).cast("double")
    past_half = (y - low - 0.5) + e
    step = (
        F.when(past_half > 0, 1.0)
        .when(past_half < 0, 0.0)
        .otherwise(F.abs(low % 2))
    )
    # from 2^53 / scale on doubles lie further apart than the digits asked for
    return F.when(F.abs(x) < 2.0**53 / scale, (low + step) / scale).otherwise(x)


def round_scaled(col: Column, digits: int) -> Column:
    """Round by scaling, ``rint`` and unscaling, the usual array-library rule."""
    scale = float(10**digits)
    return F.rint(col.cast("double") * scale) / scale
