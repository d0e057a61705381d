"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Months (or days / seconds) one unit of a datepart spans.
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_DAYS = {"day": 1, "week": 7}
_SECONDS = {"hour": 3600, "minute": 60, "second": 1}
DATEPARTS = (*_MONTHS, *_DAYS, *_SECONDS)


def _known(datepart: str) -> str:
    part = datepart.lower()
    if part not in DATEPARTS:
        raise ValueError(f"unknown datepart {datepart!r}; expected one of {DATEPARTS}")
    return part


def as_timestamp(c: str | Column) -> Column:
    return col(c).cast("timestamp")


def date_add(datepart: str, n: int | Column, start: str | Column) -> Column:
    """``start`` moved by n units, as a timestamp."""
    part = _known(datepart)
    n = n if isinstance(n, Column) else F.lit(n)
    ts = as_timestamp(start)
    if part in _MONTHS:
        return ts + F.make_ym_interval(F.lit(0), (n * _MONTHS[part]).cast("int"))
    if part in _DAYS:
        return ts + F.make_dt_interval((n * _DAYS[part]).cast("int"))
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n * _SECONDS[part]).cast("decimal(18,6)"))


def _sunday_week(c: str | Column) -> Column:
    """Number of the Sunday-to-Saturday week (1970-01-04 was a Sunday)."""
    return F.floor((F.unix_date(as_timestamp(c).cast("date")) + 4) / 7).cast("bigint")


def date_diff(datepart: str, start: str | Column, end: str | Column) -> Column:
    """Number of unit boundaries between two instants (Jan 31 to Feb 1 is one month).

    Weeks turn on Sunday.
    """
    part = _known(datepart)
    a = F.date_trunc(part, as_timestamp(start))
    b = F.date_trunc(part, as_timestamp(end))
    if part in _MONTHS:
        months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        return F.floor(months / _MONTHS[part]).cast("bigint")
    if part == "day":
        return F.datediff(b, a).cast("bigint")
    if part == "week":
        return _sunday_week(end) - _sunday_week(start)
    return F.floor((F.unix_seconds(b) - F.unix_seconds(a)) / _SECONDS[part]).cast("bigint")


def date_trunc(datepart: str, c: str | Column) -> Column:
    return F.date_trunc(_known(datepart), as_timestamp(c))


def span_years(start: str | Column, end: str | Column, as_of: Column) -> Column:
    """Inclusive number of years; an open end counts up to ``as_of``."""
    return F.coalesce(col(end), F.year(as_of)) - col(start) + 1


def as_of_column(as_of=None) -> Column:
    """Reference date: a given date / text, or today."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
