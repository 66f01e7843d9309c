"""Date expressions. "Today" is always a parameter, so that a rerun gives the same rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(column: str, pattern: str = "yyyy-MM-dd") -> Column:
    """The date a string holds, NULL if it does not follow the pattern."""
    return F.try_to_date(F.col(column), pattern)


def today(as_of: date | None = None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def now(as_of: datetime | None = None) -> Column:
    """The moment the query runs, or a fixed one, as a timestamp without zone."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def days_since(column: str, as_of: date | None = None) -> Column:
    return F.datediff(today(as_of), F.col(column).cast("date"))


def months_since(column: str, as_of: date | None = None) -> Column:
    """Months with fraction: 31-day months, whole between equal days and month ends."""
    return F.months_between(today(as_of), F.col(column).cast("date"))


def weekday_name(column: str) -> Column:
    return F.date_format(F.col(column), "EEEE")
