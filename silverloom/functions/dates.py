"""Date columns. Every "today" is an explicit ``as_of``, so a rerun of a day gives that day's result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverloom.functions.keys import col

WORK_DAYS_PER_YEAR = 260
WEEKS_PER_YEAR = 52
DEFAULT_WEEK_HOURS = 40


def as_date(value: str | Column) -> Column:
    """A date from an ISO text literal or a column."""
    return F.lit(value).cast("date") if isinstance(value, str) else value.cast("date")


def day(c: str | Column) -> Column:
    return F.to_date(col(c))


def within_months(c: str | Column, months: int, as_of: str | Column) -> Column:
    """Date is not older than ``months`` months before ``as_of``."""
    return day(c) >= F.add_months(as_date(as_of), -months)


def same_year(c: str | Column, as_of: str | Column, back: int = 0) -> Column:
    return F.year(day(c)) == F.year(as_date(as_of)) - back


def active_flag(start: str | Column, end: str | Column, as_of: str | Column) -> Column:
    """Valid on ``as_of``: start included, end excluded, an open end is valid."""
    today = as_date(as_of)
    return F.coalesce((day(start) <= today) & (day(end).isNull() | (today < day(end))), F.lit(False))


def clamp(c: str | Column, first: Column, last: Column) -> Column:
    """Date moved into [first, last]; null stays null."""
    return F.when(col(c).isNotNull(), F.greatest(F.least(col(c), last), first))


def monday_boundaries(start: Column, end: Column) -> Column:
    """Number of week starts (Mondays) in (start, end]."""
    monday = lambda d: F.date_sub(d, F.weekday(d))
    return (F.datediff(monday(end), monday(start)) / 7).cast("int")


def work_days_in_year(start: str | Column, year: str | Column) -> Column:
    """Work days left in ``year`` for someone who starts on ``start``; a full year unless the start is in that year."""
    first = day(start)
    y = col(year)
    last = F.make_date(y, F.lit(12), F.lit(31))
    nxt = F.date_add(last, 1)
    left = (
        F.datediff(nxt, first)
        - monday_boundaries(first, nxt) * 2
        - F.when(F.dayofweek(first) == 1, 1).otherwise(0)
        + F.when(F.dayofweek(last) == 7, 1).otherwise(0)
    )
    full = F.lit(WORK_DAYS_PER_YEAR)
    return F.when(F.year(first) == y, F.least(left, full)).otherwise(full)


def prorate(plan: str | Column, work_days: str | Column) -> Column:
    """Yearly plan cut to the share of the year that is worked."""
    hours = F.coalesce(col(plan).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    part = (hours * col(work_days) / WORK_DAYS_PER_YEAR).cast("decimal(18,2)")
    return F.when(col(work_days) >= WORK_DAYS_PER_YEAR, hours).otherwise(part)


def per_week(plan: str | Column, work_days: str | Column) -> Column:
    """Prorated plan spread over the weeks that are worked; none left gives zero."""
    weekly = F.try_divide(col(plan).cast("decimal(18,2)") * 5, col(work_days).cast("decimal(10,0)"))
    return F.coalesce(weekly.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
