"""Value-in-band lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hotkeys import log_bucket

PER_FOLD = 4


def band_lookup(
    df: DataFrame, bands: DataFrame, value: str, lo: str = "lo", hi: str = "hi", how: str = "left",
    on: Sequence[str] = (),
) -> DataFrame:
    """Band with ``lo <= value < hi``; NULL ``hi`` is open. ``on``: columns of any type in which row and band must agree.

    An equality join on logarithmic buckets, each band being repeated once per bucket it covers: a few thousand times at most, for one
    from minus to plus infinity. Which side is broadcast is left to statistics.
    """
    cond = (F.col(value) >= F.col(lo)) & (F.col(hi).isNull() | (F.col(value) < F.col(hi)))
    far = F.lit(1_000 * PER_FOLD).cast("long")

    def bucket(col):
        return F.least(log_bucket(col, PER_FOLD), far)

    # a band that ends where a bucket begins is not in that bucket, but one look too many does no harm
    covered = F.sequence(bucket(F.col(lo)), F.greatest(bucket(F.col(lo)), F.coalesce(bucket(F.col(hi)), far)))
    cut = bands.filter(F.col(lo).isNotNull()).withColumn("_bb", F.explode(covered))
    seen = df.withColumn("_b", F.when(F.col(value).isNotNull(), bucket(F.col(value))))
    for k in on:
        cut, cond = cut.withColumnRenamed(k, f"_band_{k}"), cond & (F.col(k) == F.col(f"_band_{k}"))
    return seen.join(cut, (F.col("_b") == F.col("_bb")) & cond, how).drop("_b", "_bb", *[f"_band_{k}" for k in on])
