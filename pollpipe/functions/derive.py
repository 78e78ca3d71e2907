"""Scalar derivations: rates on a common basis, lags and ages between times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS_PER_YEAR = 24.0 * 365.0
BASIS_HOURS = 8.0


def rate_per_basis(rate: Column, interval_hours: Column) -> Column:
    """Rate per 8 hours. NULL, not zero, if an input is missing or the interval is not positive."""
    return F.when(interval_hours > 0, rate * BASIS_HOURS / interval_hours)


def rate_per_year(rate: Column, interval_hours: Column) -> Column:
    """The rate if it held for every interval of a year; NULL as in :func:`rate_per_basis`."""
    return F.when(interval_hours > 0, rate * (F.lit(HOURS_PER_YEAR) / interval_hours))


def as_time(value: Column) -> Column:
    """An instant from a time or its text; NULL where the text is no time, never an error."""
    return value.try_cast("timestamp")


def micros(time: Column) -> Column:
    return F.unix_micros(as_time(time))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Signed seconds with their fraction; NULL if either time is missing."""
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def minutes_between(later: Column, earlier: Column, digits: int = 1) -> Column:
    return F.round((micros(later) - micros(earlier)) / F.lit(6e7), digits)


def within_days(time: Column, days: int, as_of: Column | None = None) -> Column:
    """True for times in the last ``days`` days before ``as_of`` (default: now)."""
    end = F.current_timestamp() if as_of is None else as_of
    return time >= end - F.make_dt_interval(F.lit(days))
