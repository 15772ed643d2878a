"""Date arithmetic with the warehouse's counting rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the business day is the Pacific calendar day.
LOCAL_ZONE = "America/Los_Angeles"


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date in ``zone`` of a zone-less UTC timestamp (daylight saving included)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts).cast("date")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``."""
    return F.datediff(end, start)


def months_crossed(start: Column, end: Column) -> Column:
    """Month boundaries crossed: 31 January to 1 February is 1."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def tenure_months(start: Column, at: Column) -> Column:
    """Tenure in months at a date, 0 before the start."""
    return F.greatest(months_crossed(start, at), F.lit(0))


def age_years(born: Column, at: Column) -> Column:
    """Whole years by the 365.25-day rule (not the calendar birthday)."""
    return F.floor(F.datediff(at, born) / F.lit(365.25)).cast("int")


def date_key(day: Column) -> Column:
    """yyyymmdd integer key."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def key_date(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")


def day_start(ts: Column) -> Column:
    """The same day at midnight, still a zone-less timestamp."""
    return F.to_date(ts).cast("timestamp_ntz")
