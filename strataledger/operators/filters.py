"""Row filters that are more than one comparison.

Spark's three-valued logic is the warehouse's: a comparison with NULL drops the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import key_set


def keep_unknown(cond: Column) -> Column:
    """The condition, true where it is unknown."""
    return F.coalesce(cond, F.lit(True))


def in_subquery(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in ``other``."""
    return df.join(key_set(other, keys), [*keys], "left_semi")


def exclude_list(df: DataFrame, excluded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys do not occur in ``excluded``."""
    return df.join(key_set(excluded, keys), [*keys], "left_anti")


def cutover(
    old: DataFrame, new: DataFrame | None, moves: DataFrame, key: str, date: str, moved_on: str, tag: str = "system",
    held: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Old-system rows before the key's cutover date, new-system rows on or after it.

    Keys without a cutover date stay with the old system. Rows are joined to ``moves`` (one row per key) in one equality join, whose conditions are
    residuals. Where both systems' rows lie in one table, that is ``old``, ``new`` is None and ``held`` says which rows the old and the new one hold: a
    row that both have is then joined once, and copied only if both keep it.
    """
    if new is None:
        rows, (in_old, in_new) = old, held
    else:
        rows = old.withColumn(tag, F.lit("old")).unionByName(new.withColumn(tag, F.lit("new")))
        in_old, in_new = F.col(tag) == "old", F.col(tag) == "new"
    rows = rows.withColumns({"_in_old": F.coalesce(in_old, F.lit(False)), "_in_new": F.coalesce(in_new, F.lit(False))}).filter("_in_old OR _in_new")
    dates = moves.select(F.col(key).alias("_key"), F.col(moved_on).alias("_moved")).hint("merge")  # a row for each key there is: not for the driver
    met = rows.join(dates, F.col(key) == F.col("_key"), "left")
    before = F.col("_in_old") & (F.col("_moved").isNull() | (F.col(date) < F.col("_moved")))
    after = F.col("_in_new") & (F.col(date) >= F.col("_moved"))
    systems = F.array_compact(F.array(F.when(before, F.lit("old")), F.when(after, F.lit("new"))))
    return met.select(*old.columns, F.explode(systems).alias(tag))


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Remove the rows for which the condition holds; unknown keeps the row."""
    return df.filter(~F.coalesce(cond, F.lit(False)))
