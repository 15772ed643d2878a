"""Building effective-dated history from logs.

Histories have ``start_date``, ``end_date`` (exclusive, 9999-12-31 while open),
``current_record`` (0/1) and ``row_hash``. After ``latest_per_day`` an entity has at most one
row per calendar day, so the windows that follow run unsplit (``split=False``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import MAX_DATE, UNKNOWN_TEXT, max_date, min_date
from ..functions.hashing import text_hash, with_row_hash
from .hotkeys import DEFAULT_SPLIT, Split
from .joins import key_set
from .ordered import first_per_key, neighbours, numbered, running


def latest_per_day(
    audit: DataFrame, keys: Sequence[str], ts: str, tie: str, day: Column | None = None, out: str = "day"
) -> DataFrame:
    """Last change of each entity on each (local) day."""
    dated = audit.withColumn(out, F.to_date(ts) if day is None else day)
    return first_per_key(dated, [*keys, out], [F.desc(ts), F.desc(tie)])


def changes_only(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hash_col: str = "row_hash",
    first: str = UNKNOWN_TEXT, split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Rows whose hash differs from the previous row's; ``first`` stands in before the first row."""
    seen = neighbours(df, keys, order, before={"_prev_hash": F.col(hash_col)}, split=split)
    return seen.filter(F.col(hash_col) != F.coalesce("_prev_hash", text_hash(first))).drop("_prev_hash")


def forward_fill(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
    ties: str = "rows", split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Carry each column forward on its own."""
    filled = running(df, keys, order, fills={f"_f_{c}": F.col(c) for c in cols}, ties=ties, split=split)
    return filled.withColumns({c: F.col(f"_f_{c}") for c in cols}).select(*df.columns)


def close_with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str = "start_date",
    end: str = "end_date", current: str = "current_record", split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """End each row where the next one starts; the last one is current and open."""
    led = neighbours(df, keys, order, after={"_next": F.col(start), "_follows": F.lit(1)}, split=split)
    far = F.lit(MAX_DATE).cast(df.schema[start].dataType)
    return led.withColumns(
        {end: F.coalesce("_next", far), current: F.when(F.col("_follows").isNull(), 1).otherwise(0)}
    ).drop("_next", "_follows")


def build_scd2(
    audit: DataFrame, key: str, ts: str, tie: str, attrs: Sequence[str],
    sparse: Sequence[str] = (), day: Column | None = None, money: bool = False,
) -> DataFrame:
    """Full version history of an audit log: last change per day, fill, hash, keep changes, date.

    The shuffle on (entity, day) spreads a hot entity; only one row per entity and day reaches
    the shuffle on the entity, which the four windows share.
    """
    last = latest_per_day(audit, [key], ts, tie, day, out="start_date").select(key, "start_date", *attrs)
    filled = forward_fill(last, [key], ["start_date"], sparse, split=False) if sparse else last
    hashed = with_row_hash(filled, attrs, money=money)
    changed = changes_only(hashed, [key], ["start_date"], split=False)
    return close_with_next(changed, [key], ["start_date"], split=False)


def override_first_start(hist: DataFrame, base: DataFrame, key: str, created: str) -> DataFrame:
    """The first version starts when the base row was created, if that is earlier."""
    firsts = base.groupBy(key).agg(F.min(created).alias("_created"))
    seen = neighbours(hist, [key], ["start_date"], before={"_before": F.lit(1)}, split=False)
    joined = seen.join(firsts, key, "left")
    start = F.when(F.col("_before").isNull(), F.least("start_date", F.coalesce("_created", "start_date")))
    return joined.withColumn("start_date", start.otherwise(F.col("start_date"))).select(*hist.columns)


def history_from_old_new(
    log: DataFrame, base: DataFrame, key: str, at: str, tie: str, old: str, new: str, created: str, current: str,
    value: str = "value",
) -> DataFrame:
    """(key, value, at) timeline of an old/new-value log.

    The first row's old value holds from the base row's creation, every new value from its own
    time, and entities that never changed have their current value from creation on.
    """
    first = first_per_key(log, [key], [at, tie]).select(key, F.col(old).alias(value))
    opening = first.join(base.select(key, F.col(created).alias(at)), key).select(key, value, at)
    changes = log.select(key, F.col(new).alias(value), at)
    quiet = base.join(key_set(log, [key]), key, "left_anti").select(
        key, F.col(current).alias(value), F.col(created).alias(at)
    )
    return opening.unionByName(changes).unionByName(quiet).distinct()


def merge_timelines(parts: Sequence[DataFrame], key: str, at: str, cols: Sequence[str],
                    split: Split = DEFAULT_SPLIT) -> DataFrame:
    """Unite one-attribute timelines; rows of one moment see each other's value."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return forward_fill(both, [key], [at], cols, ties="range", split=split).select(key, at, *cols).distinct()


def day_spine(spans: DataFrame, key: str, first: str, last: str, day: str = "day") -> DataFrame:
    """One row per entity and calendar day of its span."""
    return spans.select(key, F.explode(F.sequence(F.col(first), F.col(last))).alias(day))


def island_fill(
    spine: DataFrame, marks: DataFrame, key: str, day: str, marked: str, out: str
) -> DataFrame:
    """Carry the date of the last mark over the following spine days."""
    joined = spine.join(marks.select(key, F.col(marked).alias(day), F.col(marked).alias("_mark")).distinct(),
                        [key, day], "left")
    return running(joined, [key], [day], fills={out: F.col("_mark")}, split=False).drop("_mark")


def stitch(
    old: DataFrame, new: DataFrame, key: str, cut: Column, attrs: Sequence[str], start: str = "start_date",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """One history from two systems.

    Each system is reduced to its changes. Old-system rows count before the cut, new-system rows
    after it, and the ordinals run on from the entity's last old row. The hash is compared again
    over the seam, so equal neighbours there make one version. Both inputs have a ``tie`` column
    that orders rows of one moment.
    """

    old, new = old.filter(F.col(start) < cut), new.filter(F.col(start) >= cut)
    def changes(df: DataFrame, system: str) -> DataFrame:
        kept = changes_only(with_row_hash(df, attrs), [key], [start, "tie"], split=split)
        return kept.withColumn("system", F.lit(system))

    # system ranks sort the old rows first, which is what offsetting the ordinals comes to
    both = changes(old, "old").withColumn("_rank", F.lit(0)).unionByName(
        changes(new, "new").withColumn("_rank", F.lit(1))
    )
    order = [start, "_rank", "tie"]
    changed = changes_only(both, [key], order, split=split)
    closed = close_with_next(changed, [key], order, start=start, split=split)
    return numbered(closed, [key], order, "ordinal", split).drop("_rank")


def end_of_day_flags(
    hist: DataFrame, key: str, at: str, tie: str, out: str = "is_end_of_day",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """1 on the last row of each (entity, day), every row kept."""
    dated = hist.withColumn("_day", F.to_date(at))
    led = neighbours(dated, [key], [at, tie], after={"_next_day": F.col("_day")}, split=split)
    last = F.col("_next_day").isNull() | (F.col("_next_day") != F.col("_day"))
    return led.withColumn(out, last.cast("int")).drop("_day", "_next_day")


def end_of_day_view(hist: DataFrame, key: str, at: str, tie: str, attrs: Sequence[str]) -> DataFrame:
    """Day-grained history: the last row of a day, changes only, whole-day windows."""
    last = latest_per_day(hist, [key], at, tie, out="start_date").select(key, "start_date", *attrs)
    changed = changes_only(with_row_hash(last, attrs), [key], ["start_date"], first="Unknown", split=False)
    return close_with_next(changed, [key], ["start_date"], split=False)


def windows_from_events(df: DataFrame, everyone: DataFrame, key: str, day: str) -> DataFrame:
    """Lifecycle windows: from the previous event to each event, an open one after the last,
    and one whole-time window for entities without events."""
    days = df.select(key, F.col(day).alias("_d")).distinct()
    upto = neighbours(days, [key], ["_d"], before={"_p": F.col("_d")}, split=False).select(
        key, F.coalesce("_p", min_date()).alias("window_start"), F.col("_d").alias("window_end")
    )
    last = days.groupBy(key).agg(F.max("_d").alias("window_start")).withColumn("window_end", max_date())
    never = everyone.select(key).distinct().join(key_set(days, [key]), key, "left_anti").select(
        key, min_date().alias("window_start"), max_date().alias("window_end")
    )
    return upto.unionByName(last).unionByName(never)


def capped_windows(
    df: DataFrame, keys: Sequence[str], start: str, days: int, order: Sequence[str] | None = None,
    out: str = "end_date", split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Windows ending at the next start or after ``days`` days, whichever is first."""
    led = neighbours(df, keys, order or [start], after={"_next": F.col(start)}, split=split)
    return led.withColumn(out, F.least(F.coalesce("_next", max_date()), F.date_add(start, days))).drop("_next")


def flip_dates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, state: str, at: Column, out: str,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """The date where ``col`` changes into ``state``, else NULL."""
    seen = neighbours(df, keys, order, before={"_was": F.col(col)}, split=split)
    flipped = (F.col(col) == state) & (F.coalesce("_was", F.lit(UNKNOWN_TEXT)) != state)
    return seen.withColumn(out, F.when(flipped, at)).drop("_was")


def over_entity(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Entity-wide aggregates on every row.

    Aggregated with map-side combine and joined back, so no task holds all rows of an entity.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(o) for o, c in stats.items()])
    return df.join(totals, [*keys], "left")
