"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def after_first(text: Column, sep: str) -> Column:
    """What follows the first separator; the whole text when there is none."""
    at = F.instr(text, sep)
    return F.when(at > 0, F.substring(text, at + len(sep), F.length(text))).otherwise(text)


def before_first(text: Column, sep: str) -> Column:
    return F.substring_index(text, sep, 1)


def last_chars(text: Column, n: int) -> Column:
    """Last n characters of the trimmed text."""
    return F.right(F.trim(text), F.lit(n))


def zero_padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def label_key(text: Column) -> Column:
    """Key for case-insensitive label comparison; trailing blanks do not count."""
    return F.lower(F.rtrim(text))
