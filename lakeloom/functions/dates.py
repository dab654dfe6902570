"""Dates and times; the week starts on Monday, which is 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.strings import date_pattern


def day_of(c: Column) -> Column:
    """The start of the day, still a timestamp."""
    return F.date_trunc("day", c)


def time_of(c: Column) -> Column:
    """The time of day as text."""
    return F.date_format(c, "HH:mm:ss")


def microsecond(c: Column) -> Column:
    """Microseconds within the second."""
    return (F.date_part(F.lit("SECONDS"), c) * 1_000_000).cast("long") % 1_000_000


def millisecond(c: Column) -> Column:
    """Milliseconds within the second."""
    return F.floor(microsecond(c) / 1000)


def weekday(c: Column) -> Column:
    """Day of the week, Monday 0."""
    return F.weekday(c)


def unix_timestamp(c: Column) -> Column:
    """Whole seconds since 1970 in UTC."""
    return F.unix_timestamp(c.cast("timestamp"))


def is_month_start(c: Column) -> Column:
    """First day of a month."""
    return F.dayofmonth(c) == 1


def is_month_end(c: Column) -> Column:
    """Last day of a month."""
    return F.to_date(c) == F.last_day(c)


def is_year_start(c: Column) -> Column:
    """First day of a year."""
    return F.dayofyear(c) == 1


def is_year_end(c: Column) -> Column:
    """Last day of a year."""
    return (F.month(c) == 12) & (F.dayofmonth(c) == 31)


def strftime(c: Column, fmt: str) -> Column:
    """Text after a Python format."""
    return F.date_format(c, date_pattern(fmt))


def shift(c: Column, unit: str, n: int) -> Column:
    """c moved by n units: year, month, day, hour, minute, second, millisecond or microsecond."""
    return F.timestamp_add(unit.upper(), F.lit(n), c)
