"""Money, flags and safe conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal before any sum, so that totals do not depend on the order of addition."""
    return amount.cast(f"decimal({precision},{scale})")


def flag(cond: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def try_int(text: Column) -> Column:
    return text.try_cast("int")


def is_numeric(text: Column) -> Column:
    return flag(text.try_cast("double").isNotNull())


def is_date(text: Column) -> Column:
    return flag(text.try_cast("date").isNotNull())


def converted(amount: Column, rate: Column) -> Column:
    """Amount divided by a rate at the fact's money scale."""
    return (money(amount) / rate.cast("decimal(19,13)")).cast("decimal(18,2)")
