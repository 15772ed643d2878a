"""Canonical text and change-detection hashes.

Two rows get one hash exactly when their tracked columns have one canonical text, so the text
of every type is pinned here and never left to an engine's default style.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_text(df: DataFrame, name: str, money: bool = False) -> Column:
    """Text of a column with NULL as '' and one fixed style per type.

    Timestamps have their microseconds and doubles the digits that tell them apart; NaN and infinities have names of their own. With
    ``money``, doubles are decimals of two places and timestamps whole seconds, where that is what a stored hash was made of.
    """
    col, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(col, "yyyy-MM-dd HH:mm:ss" if money else "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, (T.DoubleType, T.FloatType)) and money:
        text = col.cast("decimal(18,2)").cast("string")
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(""))


def joined_text(parts: Sequence[Column], sep: str = "|") -> Column:
    """Concatenation that keeps every separator and reads NULL as ''."""
    out: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            out.append(F.lit(sep))
        out.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.concat(*out)


def escaped(text: Column, sep: str) -> Column:
    """A separator inside a value is told from one between values."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))


def row_hash(df: DataFrame, cols: Sequence[str], sep: str = "|", money: bool = False) -> Column:
    return F.sha2(joined_text([escaped(canonical_text(df, c, money), sep) for c in cols], sep), 256)


def with_row_hash(
    df: DataFrame, cols: Sequence[str], out: str = "row_hash", sep: str = "|", money: bool = False
) -> DataFrame:
    return df.withColumn(out, row_hash(df, cols, sep, money))


def text_hash(text: str) -> Column:
    return F.sha2(F.lit(text), 256)
