"""Date expressions. Every "today" is an explicit ``as_of`` date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_START = date(1900, 1, 1)


def as_date(as_of: date | Column | None) -> Column:
    """The as-of date as a column; the session's current date when none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def today_in(zone: str, now: Column | None = None) -> Column:
    """Calendar date in another time zone (session zone UTC), now or at a given instant."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp() if now is None else now, zone))


def month_end(day: Column | str) -> Column:
    return F.last_day(F.to_date(day))


def quarter_start(day: Column | str) -> Column:
    return F.trunc(F.to_date(day), "quarter")


def quarter_end(day: Column | str) -> Column:
    return F.last_day(F.add_months(quarter_start(day), 2))


def week_start_monday(day: Column | str) -> Column:
    return F.trunc(F.to_date(day), "week")


def week_number_sunday(day: Column | str) -> Column:
    """Week of the year with Sunday weeks; days before the first Sunday are week 0."""
    d = F.to_date(day)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(F.to_date(later), F.to_date(earlier))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole minutes crossed between two timestamps, counted on minute boundaries."""
    to_minute = lambda c: F.timestamp_diff("MINUTE", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("minute", c).cast("timestamp_ntz"))
    return to_minute(F.col(later) if isinstance(later, str) else later) - to_minute(F.col(earlier) if isinstance(earlier, str) else earlier)


def period_month(period: Column | str) -> Column:
    """First day of the month named in a period label such as ``P:1998:03``."""
    return F.make_date(F.substring(period, 3, 4).cast("int"), F.substring(period, 8, 2).cast("int"), F.lit(1))


def whole_months_window(day: Column, as_of: date | Column | None, back: int, ahead: int) -> Column:
    """True inside the months from ``back`` before to ``ahead - 1`` after the as-of month.

    Both ends are bounds on the plain column, so they reach a parquet scan.
    """
    this_month = F.trunc(as_date(as_of), "month")
    first = F.add_months(this_month, -back)
    last = F.date_sub(F.add_months(this_month, ahead), 1)
    return (day >= first) & (day <= last)
