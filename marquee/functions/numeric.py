"""Arithmetic functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Fixed values of the distance formula.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def bounded_int(c: str | Column, low: int, high: int | Column) -> Column:
    """The value as an integer when it lies in [low, high], else NULL."""
    v = col(c).try_cast("int")
    return F.when(v.between(F.lit(low), high if isinstance(high, Column) else F.lit(high)), v)


def safe_add(*fields: str | Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(col(f), F.lit(0)) for f in fields])


def safe_subtract(*fields: str | Column) -> Column:
    return reduce(lambda a, b: a - b, [F.coalesce(col(f), F.lit(0)) for f in fields])


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """NULL instead of an error when the denominator is 0."""
    return col(numerator) / F.nullif(col(denominator), F.lit(0))


def width_bucket(c: str | Column, low: float, high: float, buckets: int) -> Column:
    """0 below ``low``, 1..n inside, n+1 at or above ``high``."""
    return F.width_bucket(col(c).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))


def haversine(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column,
              unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    a1, o1, a2, o2 = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    chord = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles


def exact_avg(c: str | Column) -> Column:
    """Average of a narrow decimal kept to 16 digits, so thresholds cannot flip."""
    return F.avg(col(c).cast("decimal(18,12)"))


_WHOLE = "decimal(20,0)"   # any bigint; quotients keep 18 digits


def guarded_ratio(n: Column, d: Column, scale: int) -> Column:
    """n / max(d, 1), rounded half up as a decimal."""
    top = n.cast(_WHOLE)
    bottom = F.greatest(d, F.lit(1)).cast(_WHOLE)
    return F.round(top / bottom, scale)


def share(n: str | Column, total: Column, scale: int = 4) -> Column:
    """n / total rounded half up as a decimal; NULL for a zero total."""
    return F.round(col(n).cast(_WHOLE) / F.nullif(total.cast(_WHOLE), F.lit(0)), scale)
