"""Rounding that agrees with the numbers the jobs must reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(x: Column, digits: int) -> Column:
    """Scale, round half to even, unscale: the data-frame rounding rule."""
    scale = F.lit(10.0**digits)
    return F.rint(x * scale) / scale


_SPLITTER = 134217729.0  # 2**27 + 1, halves a double's mantissa


def _halves(x: float) -> tuple[float, float]:
    high = _SPLITTER * x - (_SPLITTER * x - x)
    return high, x - high


def round_exact(x: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even.

    ``F.round`` works on the shortest decimal text, so 2.675 goes up although the
    stored double is below the tie. Here the product's rounding error is recovered
    (error-free product, Dekker 1971) and decides the ties. Exact while
    ``abs(x) * 10**digits`` stays below 2**52.
    """
    scale = 10.0**digits
    s_high, s_low = _halves(scale)
    product = x * F.lit(scale)
    x_high = x * F.lit(_SPLITTER) - (x * F.lit(_SPLITTER) - x)
    x_low = x - x_high
    error = ((x_high * s_high - product) + x_high * s_low + x_low * s_high) + x_low * s_low
    floor = F.floor(product).cast("double")
    nearest = (
        F.when(product - floor != F.lit(0.5), F.rint(product))
        .when(error > 0, floor + 1.0)
        .when(error < 0, floor)
        .otherwise(F.rint(product))
    )
    return nearest / F.lit(scale)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)
