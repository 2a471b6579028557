"""Date arithmetic on columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# A birth date with unknown month is put in July, with unknown day
# on the first of the month; ages are taken on 1 July.
DEFAULT_BIRTH_MONTH = 7
DEFAULT_BIRTH_DAY = 1
AGE_MONTH, AGE_DAY = 7, 1
DAYS_PER_YEAR = 365.25
# Fixed value: no rate starts before this day unless the caller moves it.
STUDY_FLOOR = dt.date(2012, 1, 1)


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def floor_start(value: dt.date | str, floor: dt.date | str = STUDY_FLOOR) -> dt.date:
    """A study start, moved up to the floor date if it is earlier."""
    return max(as_date(value), as_date(floor))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def month_index(day: Column) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return F.year(day) * 12 + F.month(day) - 1


def birth_date(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(
        year,
        F.coalesce(month, F.lit(DEFAULT_BIRTH_MONTH)),
        F.coalesce(day, F.lit(DEFAULT_BIRTH_DAY)),
    )


def age_in_year(dob: Column, year: Column) -> Column:
    """Completed years on 1 July of ``year``, cut off towards zero for later births.

    The reference day being the first of a month, a month is complete unless the
    birth is later than the first of its month.
    """
    months = year * 12 + (AGE_MONTH - 1) - month_index(dob)
    complete = F.when((months > 0) & (F.dayofmonth(dob) > AGE_DAY), months - 1).otherwise(months)
    return (complete / 12).cast("int")


def event_end(start: Column, *candidates: Column) -> Column:
    """First known end among the candidates, else the day after the start."""
    return F.coalesce(*candidates, F.date_add(start, 1))


def follow_up_years(start: Column, end: Column) -> Column:
    return F.round(F.datediff(end, start) / F.lit(DAYS_PER_YEAR), 0)
