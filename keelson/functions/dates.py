"""Date parsing, formatting and arithmetic with an explicit processing date.

Every function takes the processing date ``as_of`` as a value instead of
reading the clock, so a plan gives the same rows whenever it runs. The clock
(``current_date()``) is only the default when the caller passes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: str | dt.date | Column | None = None) -> Column:
    """A literal processing date (the date of a moment); today's date only
    when none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(str(as_of)[:10]).cast("date")


def as_of_time(as_of: str | dt.date | Column | None = None) -> Column:
    """A literal processing moment: a timestamp if ``as_of`` has a time of day
    (a ``datetime``, or text longer than a date), a date if it is one, the
    clock (``current_timestamp()``) when nothing is given. Cast it to the type
    of the column that it is written to."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    text = str(as_of).strip()
    return F.lit(text).cast("timestamp" if len(text) > 10 else "date")


def parse_date(c: str | Column, fmt: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Text to date with a pattern. Bad text gives NULL unless ``strict``."""
    c = F.col(c) if isinstance(c, str) else c
    if strict:
        return F.to_date(c, fmt)
    return F.try_to_date(c, fmt)


def format_date(c: str | Column, fmt: str = "MMM-yyyy") -> Column:
    return F.date_format(c, fmt)


def days_between(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` (``end - start``)."""
    return F.date_diff(end, start)


def months_between(end: str | Column, start: str | Column) -> Column:
    """Fractional months (31-day month fraction, rounded to 8 digits)."""
    return F.months_between(end, start, roundOff=True)


def add_days(c: str | Column, days: int) -> Column:
    return F.date_add(c, days)


def add_months(c: str | Column, months: int) -> Column:
    """Add calendar months; a day past the end of the target month clamps to its end."""
    return F.add_months(c, months)


def month_of(c: str | Column) -> Column:
    return F.month(c)
