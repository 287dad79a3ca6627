"""Instants, calendar cutoffs and epoch conversions.

Calendar arithmetic and date rendering follow the session time zone, which
``dormouse.session`` fixes to UTC; plans refuse a session in another zone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


# Epoch milliseconds of the years 1 to 9999; what lies beyond is no time.
FIRST_MILLIS, LAST_MILLIS = -62135596800000, 253402300799999


def instant(as_of: datetime | str | Column | None = None) -> Column:
    """The moment a rule is evaluated at; the query's own start by default.

    Text and datetimes without an offset are taken as UTC.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def months_before(as_of: datetime | str | Column | None, months: int) -> Column:
    """``as_of`` minus calendar months, clamped to the end of the month."""
    return instant(as_of) - F.make_ym_interval(F.lit(0), F.lit(months))


_DAY_MICROS = 24 * 60 * 60 * 1_000_000


def first_after_months(moment: Column, months: int) -> Column:
    """The first instant whose ``months_before`` lies after ``moment``: the inverse of the clamped cut.

    That is a microsecond past the same day and time ``months`` later, if there is such a day and the
    next instant is still on it. Else it is the next midnight whose cut is a later day: the next day,
    or the next month where the days left in the month are all cut to the end of the earlier one.
    """
    day, month = moment.cast("date"), F.trunc(moment, "month")
    later = F.add_months(month, F.lit(months))
    number, days = F.dayofmonth(day), F.dayofmonth(F.last_day(later))
    of_day = F.unix_micros(moment) - F.unix_micros(day.cast("timestamp"))
    same = F.timestamp_micros(
        F.unix_micros(later.cast("timestamp")) + (number - 1).cast("bigint") * _DAY_MICROS + of_day + 1
    )
    month_end = (number == F.dayofmonth(F.last_day(day))) | (number >= days)
    next_day = F.when(month_end, F.add_months(month, F.lit(months + 1))).otherwise(F.date_add(later, number))
    return F.when((number <= days) & (of_day < _DAY_MICROS - 1), same).otherwise(next_day.cast("timestamp"))


def years_after(moment: Column, years: int) -> Column:
    """``moment`` plus calendar years; 29 February becomes 28 February."""
    return moment + F.make_ym_interval(F.lit(years), F.lit(0))


def millis_text_to_timestamp(text: Column) -> Column:
    """Epoch milliseconds kept as text, with their fraction; NULL if no time of the years 1 to 9999."""
    millis = text.try_cast("decimal(38,6)")
    known = F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis).cast("decimal(21,6)")
    return F.timestamp_micros(F.round(known * 1000).cast("bigint"))


def millis_to_timestamp(millis: Column) -> Column:
    """Integer epoch milliseconds to a timestamp; NULL beyond the years 1 to 9999."""
    return F.timestamp_millis(F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis))


def millis_to_date(millis: Column) -> Column:
    """Integer epoch milliseconds to the day they fall on; the fraction of a second is cut."""
    return F.timestamp_seconds(F.call_function("div", millis, F.lit(1000))).cast("date")


def day_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def stale_or_never(moment: Column, cut: Column) -> Column:
    """No activity since the cutoff, or none on record."""
    return (moment < cut) | moment.isNull()
