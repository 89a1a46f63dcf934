"""Date arithmetic with the unit names and counting rules of other SQL systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names and their synonyms.
UNITS = {
    "year": ("year", "y", "yy", "yyy", "yyyy", "yr", "years", "yrs"),
    "quarter": ("quarter", "q", "qq", "qtr", "qtrs", "quarters"),
    "month": ("month", "mm", "m", "mon", "mons", "months"),
    "week": ("week", "w", "wk", "ww", "weekofyear", "woy", "wy", "weeks"),
    "day": ("day", "d", "dd", "days", "dayofmonth", "dayofyear", "dy", "weekday", "dw"),
    "hour": ("hour", "h", "hh", "hr", "hours", "hrs"),
    "minute": ("minute", "mi", "n", "min", "minutes", "mins"),
    "second": ("second", "s", "ss", "sec", "seconds", "secs"),
    "millisecond": ("millisecond", "ms", "msec", "milliseconds"),
    "microsecond": ("microsecond", "us", "mcs", "usec", "microseconds"),
    "nanosecond": ("nanosecond", "ns", "nsec", "nanosec", "nanoseconds"),
}
_SECONDS = {"hour": 3600, "minute": 60, "second": 1}


def unit_name(unit: str) -> str:
    for name, synonyms in UNITS.items():
        if unit.lower().strip("'\"") in synonyms:
            return name
    raise ValueError(f"unknown date unit: {unit}")


def date_add(unit: str, n, c: Column) -> Column:
    """Add ``n`` units. The type of the input stays: with days and larger units a DATE stays a DATE and a timestamp
    keeps its time of day. Months end at the last day of the month. Timestamps have microseconds, so of nanoseconds
    the whole microseconds are added, rounded down.
    """
    unit = unit_name(unit)
    n = n if isinstance(n, Column) else F.lit(n)
    if unit in ("year", "quarter", "month"):
        return c + F.make_ym_interval(F.lit(0), (n * {"year": 12, "quarter": 3, "month": 1}[unit]).cast("int"))
    if unit in ("week", "day"):
        # An interval of whole days leaves the type alone.
        return c + F.make_dt_interval(days=(n * (7 if unit == "week" else 1)).cast("int")).cast("interval day")
    if unit in _SECONDS:
        return c + F.make_dt_interval(secs=n * _SECONDS[unit])
    if unit == "nanosecond":
        n, unit = F.floor(n / 1000), "microsecond"
    return c + F.make_dt_interval(secs=n / F.lit({"millisecond": 1000, "microsecond": 1000000}[unit]))


def timestamp_add(unit: str, n, c: Column) -> Column:
    """Add ``n`` units to a point in time; a DATE counts as its midnight."""
    return date_add(unit, n, c.cast("timestamp"))


def date_diff(unit: str, start: Column, end: Column, whole: bool = False) -> Column:
    """Unit borders between two points in time, or (``whole``) complete units, as a count."""
    unit = unit_name(unit)
    if whole:
        return F.timestamp_diff(unit.upper(), start, end)
    years = F.year(end) - F.year(start)
    if unit == "year":
        return years
    if unit == "quarter":
        return years * 4 + F.quarter(end) - F.quarter(start)
    if unit == "month":
        return years * 12 + F.month(end) - F.month(start)
    if unit == "week":
        return F.floor(F.datediff(F.trunc(end, "week"), F.trunc(start, "week")) / 7)
    if unit == "day":
        return F.datediff(end, start)
    if unit in _SECONDS:
        a, b = (F.unix_timestamp(F.date_trunc(unit, x.cast("timestamp"))) for x in (start, end))
        return F.floor((b - a) / _SECONDS[unit])
    factor = {"millisecond": 1000, "microsecond": 1}[unit]
    a, b = (F.floor(F.unix_micros(x.cast("timestamp")) / factor) for x in (start, end))
    return b - a


def last_day(c: Column, unit: str = "month") -> Column:
    """Last day of the year, quarter, month or week that holds the date."""
    unit = unit_name(unit)
    start = F.trunc(c, unit)
    if unit == "week":
        return F.date_add(start, 6)
    return F.date_add(F.add_months(start, {"year": 12, "quarter": 3, "month": 1}[unit]), -1)


def day_name(c: Column) -> Column:
    return F.date_format(c, "E")


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMM")


def convert_timezone(target: str, c: Column, source: str | None = None) -> Column:
    return F.convert_timezone(F.lit(source) if source else None, F.lit(target), c)
