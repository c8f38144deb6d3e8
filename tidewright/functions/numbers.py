"""Numeric functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_MILES = 3961
KM_PER_MILE = 1.60934


def to_cents(amount: Column) -> Column:
    """Money as whole cents, halves away from zero, so that sums are exact in any order.

    Plain double arithmetic: ``round`` would go through a decimal object per row.
    """
    return (amount * 100 + F.signum(amount) * 0.5).cast("bigint")


def cents_to_dollars(cents: Column, places: int = 2) -> Column:
    return F.round(cents / F.lit(100.0), places)


def safe_add(*fields: Column) -> Column:
    """Sum in which null counts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(f, F.lit(0)) for f in fields])


def row_sum(*fields: Column) -> Column:
    """Sum that is null as soon as one part is null."""
    return reduce(lambda a, b: a + b, fields)


def width_bucket(value: Column, low: float, high: float, buckets: int) -> Column:
    """Equal-width bucket number; 0 below ``low``, ``buckets`` + 1 from ``high`` on."""
    return F.width_bucket(value, F.lit(float(low)), F.lit(float(high)), F.lit(buckets))


def degrees_to_radians(degrees: Column) -> Column:
    return F.radians(degrees)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    half = (
        F.pow(F.sin(F.radians((lat2 - lat1) / 2)), F.lit(2))
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians((lon2 - lon1) / 2)), F.lit(2))
    )
    miles = F.asin(F.sqrt(half)) * (2 * EARTH_MILES)
    return miles if unit == "mi" else miles * KM_PER_MILE


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null when the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole)


def percent_of(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(F.lit(100.0) * part / whole, places)
