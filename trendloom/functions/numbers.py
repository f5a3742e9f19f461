"""Rounding and ratio expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.functions.arrays import bind


def round_exact(x: Column, digits: int | None) -> Column:
    """Round the exact binary value, ties to even, the way CPython's ``round`` does.

    ``F.round`` rounds the shortest decimal text of a double (2.675 -> 2.68) although the
    stored value lies below the tie. Here the product ``2 * x * 10**digits`` is split into a
    rounded part and its exact error, so the side of the tie is decided without guessing.
    ``None`` leaves the value as it is.
    """
    if digits is None:
        return x
    scale = float(10 ** digits)
    factor = 2.0 * scale

    def decide(v: Column) -> Column:
        low = F.floor(v * F.lit(scale)).cast("double")
        product = v * F.lit(factor)
        big = v * F.lit(134217729.0)                  # 2**27 + 1 halves the mantissa
        head = big - (big - v)
        error = (head * F.lit(factor) - product) + (v - head) * F.lit(factor)
        side = (product - (low * 2.0 + 1.0)) + error
        even_up = F.pmod(low, F.lit(2.0)) == 1.0
        up = (side > 0) | ((side == 0) & even_up)
        return (low + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / F.lit(scale)
    return bind(x.cast("double"), decide)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null when there is no base."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
