"""Numeric helpers: safe ratios, nearest ranks and order-keeping value buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**41 + 1 leaves 12 leading bits of a double: buckets about 0.05 % wide, 2048 to the octave.
_SPLIT = float(2**41 + 1)
_LARGEST = 1e290


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(a, b)


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def round_half_even(value: Column, digits: int = 0) -> Column:
    """``value`` to ``digits`` decimals, correctly rounded from its binary value; only exact ties go to even.

    Spark's ``bround`` rounds the shortest decimal text of a double, where 0.066125 looks like a tie although the
    double lies above it. Here the product with the power of ten is kept with its exact rounding error, and the
    error decides what looks like a tie. Values beyond 2**52 units of the last digit are whole already.
    """
    scale = float(10**digits)
    split = float(2**27 + 1)
    scale_high = scale * split - (scale * split - scale)
    scale_low = scale - scale_high
    scaled = value * F.lit(scale)
    wide = value * F.lit(split)
    high = wide - (wide - value)
    low = value - high
    error = (high * scale_high - scaled + high * scale_low + low * scale_high) + low * scale_low

    below = F.floor(scaled)
    rest = scaled - below
    tie = (error > 0) | ((error == 0) & (F.pmod(below, F.lit(2)) == 1))
    up = F.when((rest > 0.5) | ((rest == 0.5) & tie), 1).otherwise(0)
    return F.when(F.abs(scaled) < float(2**52), (below + up) / F.lit(scale)).otherwise(value)


def nearest_rank(n: Column, q: float) -> Column:
    """0-based rank of the ``q`` quantile among ``n`` sorted values: (n - 1) q, halves upwards."""
    return F.floor((n - 1) * F.lit(float(q)) + F.lit(0.5))


def value_bucket(value: Column) -> Column:
    """``value`` rounded to 12 significant bits by three exact floating-point steps.

    Rounding to nearest keeps order (a <= b gives bucket(a) <= bucket(b)), so counts per bucket locate a
    rank exactly, and the steps are plain IEEE operations, so every executor computes the same bucket.
    """
    held = F.least(F.greatest(value, F.lit(-_LARGEST)), F.lit(_LARGEST))
    scaled = held * F.lit(_SPLIT)
    return scaled - (scaled - held)
