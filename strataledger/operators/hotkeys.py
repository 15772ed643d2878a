"""Cutting every key's rows into pieces along their order, so that no key has to be one task.

A piece is a number or text computed from the leading order column alone that never decreases along Spark's own order of that
column: NULL first, NaN last. So pieces need no counting, no look at the data and no switch: they are the same at every size, and a
window over (key, piece) plus what is carried between pieces (``ordered.py``) gives what one window over the key gives.
A day of a date, a minute of a timestamp, a 256th of an e-fold of a number and three leading characters of a text are one piece; other types
have one piece only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE = "_piece"

# Whether a key's rows are cut. False is for keys that the calendar bounds, as after ``latest_per_day``.
Split = bool
DEFAULT_SPLIT = True

FOLD = 256  # pieces in which a number grows by the factor e
BEYOND = 1_000_000  # the pieces of infinity and, one more, of NaN


def log_bucket(col: Column, per_fold: int = FOLD) -> Column:
    """A long that never decreases with the number."""
    x = col.cast("double")
    size = F.least(F.floor(F.least(F.log1p(F.abs(x)), F.lit(1_000.0)) * per_fold), F.lit(BEYOND))
    return F.when(F.isnan(x), F.lit(BEYOND + 1)).otherwise(F.when(x < 0, -size).otherwise(size)).cast("long")


def piece(df: DataFrame, order: Sequence[str]) -> Column:
    """Piece of a row by the first of the order columns."""
    kind, col = df.schema[order[0]].dataType, F.col(order[0])
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_micros(col) / F.lit(60_000_000))
    if isinstance(kind, T.TimestampNTZType):
        # by its own calendar: a time zone's clock change would bend the order
        return (F.unix_date(col.cast("date")) * 24 + F.hour(col)).cast("long") * 60 + F.minute(col)
    if isinstance(kind, T.NumericType):
        return F.when(col.isNotNull(), log_bucket(col))
    if isinstance(kind, T.StringType):
        return F.substring(col, 1, 3)
    return F.lit(0).cast("long")
