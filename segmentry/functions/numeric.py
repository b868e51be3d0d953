"""Rounding, clipping and flags with the null rules the features need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, places: int) -> Column:
    """Round on the binary value, halves to even (Spark's ``round`` works on the decimal text instead)."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def round_away(value: Column, places: int) -> Column:
    """Round on the binary value, halves away from zero: SQL ``ROUND`` of the warehouse on doubles."""
    scale = float(10**places)
    return F.signum(value) * F.floor(F.abs(value) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null although least/greatest skip nulls."""
    return F.when(
        value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    )


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def guarded_ratio(numerator: Column, denominator: Column, allowed: Column, low: float, high: float, places: int) -> Column:
    """Clipped and rounded ratio where ``allowed`` holds, 0.0 elsewhere (also where it is unknown)."""
    ratio = F.try_divide(numerator, denominator)
    return F.when(allowed, round_even(clip(ratio, low, high), places)).otherwise(F.lit(0.0))
