"""Date and time helpers. Timestamps stay without time zone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col


@dataclass(frozen=True)
class Age:
    """Calendar distance of two dates."""

    days: Column  # with years of 365.25 and months of 30 days
    months: Column  # whole months, years included
    years: Column  # whole years


def calendar_age(later: str | Column, earlier: str | Column) -> Age:
    """Years, months and days from `earlier` to `later`, counted on the calendar.

    Whole months are taken first. A day count that would be negative borrows the length of
    the month of the first date. The sign flips when the dates come in the other order.
    """
    a, b = col(later).cast("date"), col(earlier).cast("date")
    first, last = F.least(a, b), F.greatest(a, b)
    known = a.isNotNull() & b.isNotNull()
    sign = F.when(known, F.when(a < b, -1).otherwise(1))
    short = F.dayofmonth(last) < F.dayofmonth(first)
    months = (
        (F.year(last) - F.year(first)) * 12
        + (F.month(last) - F.month(first))
        - F.when(short, 1).otherwise(0)
    )
    spare = (
        F.dayofmonth(last)
        - F.dayofmonth(first)
        + F.when(short, F.dayofmonth(F.last_day(first))).otherwise(0)
    )
    years = F.floor(months / 12).cast("int")
    days = years * F.lit(365.25) + F.pmod(months, F.lit(12)) * 30 + spare
    return Age(days=sign * days, months=sign * months, years=sign * years)


def date_part(c: str | Column) -> Column:
    return F.to_date(col(c))


def second_of_day(c: str | Column) -> Column:
    """The time of day as a number, which a hash aggregate can maximise."""
    return F.hour(col(c)) * 3600 + F.minute(col(c)) * 60 + F.second(col(c))


def clock_of(seconds: str | Column) -> Column:
    """'HH:mm:ss' of a second of the day."""
    s = col(seconds)
    parts = [F.floor(s / 3600), F.floor(s / 60) % 60, s % 60]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def time_part(c: str | Column) -> Column:
    """The time of day as 'HH:mm:ss', whatever the session's time zone; text order is time order."""
    return F.when(col(c).isNotNull(), clock_of(second_of_day(c)))


def minute_of_day(c: str | Column) -> Column:
    return F.hour(col(c)) * 60 + F.minute(col(c))


def month_start(c: str | Column) -> Column:
    return F.trunc(col(c), "month")


def week_start(c: str | Column) -> Column:
    """Monday of the week."""
    return F.trunc(col(c), "week")


def months_before(c: str | Column, n: int) -> Column:
    return F.add_months(col(c), -n)


def date_from_parts(year: int | str | Column, month_name: str | Column, day: str | Column) -> Column:
    """Date from a year, an English month abbreviation in any case, and a day."""
    y = F.lit(str(year)) if isinstance(year, int) else col(year).cast("string")
    text = F.concat_ws("-", y, F.initcap(col(month_name)), col(day).cast("string"))
    return F.to_date(text, "yyyy-MMM-d")


def ordinal_day(c: str | Column) -> Column:
    """1st, 2nd, 3rd, 4th; the days 10 to 20 all take 'th'."""
    day = F.dayofmonth(col(c))
    last = day % 10
    ending = (
        F.when(day.between(10, 20), "th")
        .when(last == 1, "st")
        .when(last == 2, "nd")
        .when(last == 3, "rd")
        .otherwise("th")
    )
    return F.concat(day.cast("string"), ending)
