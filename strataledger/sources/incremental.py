"""Incremental reads against a stored target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import key_set


def incremental(
    src: DataFrame, tgt: DataFrame, ts: str, overlap_days: int = 1, floor: str = "1900-01-01"
) -> DataFrame:
    """Rows changed since the target's high-water mark less the overlap; all since ``floor`` if empty.

    The mark is a scalar subquery, so it becomes a pushed-down scan filter at run time.
    """
    kind = src.schema[ts].dataType
    back = F.expr(f"interval {overlap_days} days")
    mark = F.coalesce(F.max(ts).cast(kind) - back, F.lit(floor).cast(kind)).cast(kind)
    return src.filter(F.col(ts) >= tgt.agg(mark.alias("mark")).scalar())


def late_arrivals(src: DataFrame, batch: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Back-dated rows the mark missed: keys in neither the batch nor the target."""
    return (
        src.join(key_set(tgt, keys), [*keys], "left_anti")
        .join(key_set(batch, keys), [*keys], "left_anti")
    )


def incremental_and_late(src: DataFrame, tgt: DataFrame, ts: str, keys: Sequence[str], overlap_days: int = 1, floor: str = "1900-01-01") -> DataFrame:
    """``incremental`` and the ``late_arrivals`` it misses, in one pass over the source.

    A row goes along if it is as new as the mark, or if its key is neither in the target nor on any row as new as the mark.
    """
    kind = src.schema[ts].dataType
    back = F.expr(f"interval {overlap_days} days")
    mark = F.coalesce(F.max(ts).cast(kind) - back, F.lit(floor).cast(kind)).cast(kind)
    known = key_set(tgt, keys).withColumn("_known", F.lit(1))
    recent = F.coalesce((F.col(ts) >= tgt.agg(mark.alias("mark")).scalar()).cast("int"), F.lit(0))
    flagged = src.withColumn("_recent", recent).withColumn("_any", F.max("_recent").over(Window.partitionBy(*keys)))
    met = flagged.join(known, [*keys], "left")
    return met.filter((F.col("_recent") == 1) | (F.col("_known").isNull() & (F.col("_any") == 0))).select(*src.columns)
