"""Dates of filings: several notations, effective dates, period ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Notations in the order they are tried.
FORMATS = ("yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy")
LOOSE = ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-M-d", "yyyy/M/d")


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _first_of(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats))


def parse_date(text: Column) -> Column:
    """A date in any of ``FORMATS``; ``Sept`` and dotted months are understood."""
    t = F.regexp_replace(squeezed(text), r"(?i)\bSept\b", "Sep")
    return _first_of(F.regexp_replace(t, r"(?i)\b(Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\.", "$1"), FORMATS)


def loose_date(text: Column) -> Column:
    return _first_of(squeezed(text), LOOSE)


def long_date(date: Column) -> Column:
    """``January 05, 2026``."""
    return F.date_format(date, "MMMM dd, yyyy")


def effective_date(period_end: Column, filing: Column) -> Column:
    """The period's end; if it names only month and day, with the filing's year, or the year before if over 31 days past the filing; else the filing date.

    29 February without a year is no month and day that can be read, in leap
    years neither: the filing date counts.
    """
    period, filed = loose_date(period_end), loose_date(filing)
    with_year = F.concat(squeezed(period_end), F.lit(", "), F.year(filed).cast("string"))
    day = _first_of(with_year, ("MMMM d, yyyy", "MMM d, yyyy"))
    day = F.when((F.month(day) != 2) | (F.dayofmonth(day) != 29), day)
    return F.coalesce(period, F.when(day > F.date_add(filed, 31), F.add_months(day, -12)).otherwise(day), filed)


def quarter_end_like(date: Column, within: int = 7) -> Column:
    """Within some days of a calendar quarter's end."""
    ends = [F.last_day(F.add_months(F.trunc(date, "quarter"), k)) for k in (-1, 2)]
    return F.least(*(F.abs(F.date_diff(date, e)) for e in ends)) <= within


def month_end(date: Column) -> Column:
    return date == F.last_day(date)


def preferred_duration(form: Column) -> Column:
    return F.when(form.isin("10-Q", "6-K"), 90).otherwise(365)


def market_date(today: Column) -> Column:
    """The day itself, or the Friday before a weekend."""
    return F.date_sub(today, F.when(F.dayofweek(today) == 7, 1).when(F.dayofweek(today) == 1, 2).otherwise(0))


def recent_quarters(today: Column, n: int) -> Column:
    """The last ``n`` quarters, newest first, as structs (year, quarter)."""
    starts = F.sequence(F.trunc(today, "quarter"), F.add_months(F.trunc(today, "quarter"), -3 * (n - 1)), F.expr("interval -3 months"))
    return F.transform(starts, lambda d: F.struct(F.year(d).alias("year"), F.quarter(d).alias("quarter")))


def latest_of(days: Column, preferred) -> Column:
    """The newest of some dates that ``preferred`` accepts, else the newest of all; null without dates."""
    return F.coalesce(F.array_max(F.filter(days, lambda d: preferred(d))), F.array_max(days))
