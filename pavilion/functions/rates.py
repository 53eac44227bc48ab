"""Ratio metrics over finished aggregates.

All of them scale the integer numerator before the division and shift the
decimal point back after rounding. That gives exact half-up rounding of the
true quotient, so every engine agrees on the last digit. A zero denominator
gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BALLS_PER_OVER = 6


def ratio(top: Column | str, bottom: Column | str, scale: int = 1, digits: int = 2) -> Column:
    """``round(scale * top / bottom, digits)``."""
    top, bottom = (F.col(c) if isinstance(c, str) else c for c in (top, bottom))
    shift = 10**digits
    return F.round(top * (scale * shift) / F.nullif(bottom, F.lit(0))) / shift


def percentage(part: Column | str, whole: Column | str) -> Column:
    return ratio(part, whole, scale=100)


def strike_rate(runs: Column | str, balls: Column | str) -> Column:
    """Runs per 100 balls."""
    return percentage(runs, balls)


def economy(runs: Column | str, balls: Column | str) -> Column:
    """Runs per over."""
    return ratio(runs, balls, scale=BALLS_PER_OVER)


def overs(balls: Column | str) -> Column:
    return ratio(balls, F.lit(BALLS_PER_OVER), digits=1)
