"""Rounded measures over epoch counts. All arithmetic is on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hypnolith.schemas import EPOCH_SEC


def minutes(epochs: Column) -> Column:
    return F.round(epochs * float(EPOCH_SEC) / 60.0, 1)


def hours(epochs: Column) -> Column:
    return F.round(epochs * float(EPOCH_SEC) / 3600.0, 2)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)


def fraction(part: Column, whole: Column) -> Column:
    return F.round(F.lit(1.0) * part / F.nullif(whole, F.lit(0)), 3)


def per_hour(count: Column, rounded_hours: Column) -> Column:
    """Events per hour; the hours are the reported, already rounded ones."""
    return F.round(F.lit(1.0) * count / F.nullif(rounded_hours, F.lit(0.0)), 2)


def scaled(value: Column, decimals: int) -> Column:
    """A value rounded to ``decimals`` places as an exact integer.

    Sums of these do not depend on the order in which tasks finish.
    """
    return F.round(value * float(10**decimals)).cast("long")
