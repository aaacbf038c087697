"""Dates as registers write them; every parser gives null, never an error, for what it cannot read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLIEST, LATEST = "1900-01-01", "2299-12-31"


def within_range(date: Column) -> Column:
    """date, null outside the years 1900 to 2299."""
    return F.when(date.between(F.lit(EARLIEST).cast("date"), F.lit(LATEST).cast("date")), date)


def digits_date(text: Column) -> Column:
    """The date of the first eight digits, whatever stands between them."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    return within_range(F.when(F.length(digits) >= 8, F.try_to_timestamp(F.substring(digits, 1, 8), F.lit("yyyyMMdd")).cast("date")))


def compact_date(text: Column) -> Column:
    """yyyyMMdd; a day or month of 00 is no date."""
    bare = F.trim(text)
    return within_range(F.when(bare.rlike(r"^\d{8}$") & ~bare.rlike(r"00$|^\d{4}00"), F.try_to_timestamp(bare, F.lit("yyyyMMdd")).cast("date")))


def first_format(text: Column, *formats: str) -> Column:
    """The date by the first format that fits the whole text."""
    return within_range(F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)).cast("date") for f in formats]))


def iso_prefix(text: Column) -> Column:
    """The date at the beginning of an ISO date or time."""
    return first_format(F.substring(F.trim(text), 1, 10), "yyyy-MM-dd")


def add_years(date: Column, years: Column | int) -> Column:
    """The same day so many years on, 28 February where there is none."""
    return F.add_months(date, (years if isinstance(years, Column) else F.lit(years)) * 12)


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def epoch_millis(time: Column) -> Column:
    """Milliseconds since 1970 of a timestamp_ntz, free of the session's time zone."""
    return F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), time.cast("timestamp_ntz"))
