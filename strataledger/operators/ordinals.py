"""Ordinals by sampled range partitions: 1, 2, 3 ... within a key, however many rows a key or one value of its order has.

Rows are dealt by ranges of (keys, order), whose bounds Spark takes from a sample of the whole tuple, and sorted within each range; equal rows
are told apart by where they were read, so nothing forces two rows into one range. A row's place in its range and the number
of rows of its key in the ranges before give its ordinal. The sorted rows are written once, as the ranges of a second reading could differ;
what is added up per key is one row for each range that holds it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 33  # monotonically_increasing_id counts within a partition in its lower bits


def ordinals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    stage: Callable[[DataFrame], DataFrame],
    out: str = "seq",
    total: str | None = None,
) -> DataFrame:
    """``df`` with the row's ordinal within its key (a long from 1) and, if named, the key's number of rows.

    ``stage`` writes a table where driver and executors see it and reads it back. NULL keys are equal to each other, NULL comes first in the
    order; rows equal in it get their ordinals in any order. Without keys all rows are one group.
    """
    source = df.withColumn("_read", F.monotonically_increasing_id())
    by = [*[F.col(k) for k in keys], *[F.col(o) if isinstance(o, str) else o for o in order], F.col("_read")]
    laid = source.repartitionByRange(*by).sortWithinPartitions(*by)
    laid = stage(laid.withColumn("_place", F.monotonically_increasing_id()).drop("_read"))
    group = F.struct(F.lit(0).alias("k"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    laid = laid.withColumns({"_range": F.shiftright("_place", RANGE_BITS), "_group": group})
    held = laid.groupBy("_group", "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    new = {"_base": F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")}
    if total:
        new[total] = F.sum("_n").over(Window.partitionBy("_group"))
    # one row for each key and range; ranges of a key are as few as its rows fill
    held = held.withColumns(new).drop("_first", "_n")
    met = laid.join(held, ["_group", "_range"])
    return met.withColumn(out, F.col("_place") + F.col("_base") + 1).select(*df.columns, out, *([total] if total else []))
