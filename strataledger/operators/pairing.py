"""Opening events and the closing events that follow them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import MAX_DATE
from .hotkeys import DEFAULT_SPLIT, Split
from .ordered import neighbours


def sequence_events(
    df: DataFrame, key: str, at: str, tie: str, opens: Column, closes: Column, extra: Sequence[str] = (),
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Opening and closing events with the event after and before them in the entity.

    One lead/lag pass replaces the self-join on the next event date.
    """
    flags = df.select(key, at, tie, *extra, opens.cast("int").alias("opens"), closes.cast("int").alias("closes"))
    flags = flags.filter((F.col("opens") == 1) | (F.col("closes") == 1))
    return neighbours(
        flags, [key], [at, tie],
        before={"prev_opens": F.col("opens"), "prev_closes": F.col("closes")},
        after={
            "next_at": F.col(at), "next_opens": F.col("opens"), "next_closes": F.col("closes"),
            **{f"next_{c}": F.col(c) for c in extra},
        },
        split=split,
    )


def pair_events(seq: DataFrame, at: str) -> DataFrame:
    """Each opener with its closing date.

    An event that opens and closes at once is complete in itself; otherwise the very next event
    must be a pure closer.
    """
    at_once = F.col("closes") == 1
    by_next = F.coalesce((F.col("next_closes") == 1) & (F.col("next_opens") == 0), F.lit(False))
    far = F.lit(MAX_DATE).cast(seq.schema[at].dataType)
    return seq.filter("opens = 1").withColumns(
        {
            "completed": (at_once | by_next).cast("int"),
            "close_at": F.when(at_once, F.col(at)).when(by_next, F.col("next_at")),
            "next_at": F.coalesce("next_at", far),
        }
    )


def unmatched_closers(seq: DataFrame) -> DataFrame:
    """Pure closing events that do not directly follow an opener left open."""
    follows = (F.col("prev_opens") == 1) & (F.col("prev_closes") == 0)
    return seq.filter((F.col("closes") == 1) & (F.col("opens") == 0) & ~F.coalesce(follows, F.lit(False)))
