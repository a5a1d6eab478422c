"""Reproducible draws from a hash, the same for any partitioning or retry."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = 2.0**32


def uniform_int(low: int, high: int, *parts: Column) -> Column:
    """An integer in [low, high], both ends included."""
    span = F.lit(high - low + 1).cast("long")
    return (F.lit(low) + F.pmod(F.xxhash64(*parts), span)).cast("int")


def polar(*parts: Column) -> tuple[Column, Column]:
    """Radius and angle of a Box-Muller pair, from the two halves of one 64-bit hash."""
    word = F.xxhash64(*parts)
    upper = F.shiftrightunsigned(word, 32).cast("double")
    lower = word.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("double")
    # The argument is in (0, 1], so the logarithm is never NULL; saying so drops NULL checks
    # from the code generated for everything that follows.
    logarithm = F.coalesce(F.log((upper + F.lit(1.0)) * F.lit(1.0 / _WORD)), F.lit(0.0))
    radius = F.sqrt(F.lit(-2.0) * logarithm)
    angle = lower * F.lit(2.0 * math.pi / _WORD)
    return radius, angle


def jitter(base: Column, normal: Column, scale: float) -> Column:
    """Noise in proportion to the base; zero stays zero."""
    return base * (F.lit(1.0) + normal * F.lit(scale))
