"""Late changes in a type-2 history: a row that arrives after its day splits the version it falls in, without a new build.

A history keeps changes only, so it cannot tell that a value was seen again later. The ``day_states`` behind it can: one row for each entity
and day, with the columns as they were logged. A late row re-stitches what lies between the last complete state before it and the first
complete state after it (complete: no sparse column missing); all other versions pass by, also those of the same entity.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import with_row_hash
from .history import changes_only, close_with_next, forward_fill, latest_per_day
from .joins import key_set
from .ordered import first_per_key


def day_states(audit: DataFrame, key: str, ts: str, tie: str, attrs: Sequence[str], day: Column | None = None) -> DataFrame:
    """(key, start_date, ts, tie, attrs): the last logged row of each entity and day."""
    return latest_per_day(audit, [key], ts, tie, day, out="start_date").select(key, "start_date", ts, tie, *attrs)


def versions_of(states: DataFrame, key: str, attrs: Sequence[str], sparse: Sequence[str] = (), money: bool = False) -> DataFrame:
    """The history of day states: filled, changes only, dated."""
    rows = states.select(key, "start_date", *attrs)
    filled = forward_fill(rows, [key], ["start_date"], sparse, split=False) if sparse else rows
    changed = changes_only(with_row_hash(filled, attrs, money=money), [key], ["start_date"], split=False)
    return close_with_next(changed, [key], ["start_date"], split=False)


def news(states: DataFrame, late: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Late day states that count: of a day without one, or later in their day than the stored one. Rows that came before are none."""
    last = first_per_key(late, [key, "start_date"], [F.desc(ts), F.desc(tie)])
    known = states.select(key, "start_date", F.struct(ts, tie).alias("_known"))
    met = last.join(known, [key, "start_date"], "left")
    return met.filter(F.col("_known").isNull() | (F.struct(ts, tie) > F.col("_known"))).drop("_known")


def with_news(states: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The day states after a batch: its rows replace those of their day."""
    return states.join(key_set(fresh, [key, "start_date"]), [key, "start_date"], "left_anti").unionByName(fresh)


def restitch(
    hist: DataFrame, states: DataFrame, fresh: DataFrame, key: str, attrs: Sequence[str], sparse: Sequence[str] = (), money: bool = False,
) -> DataFrame:
    """The history after late day states: what ``versions_of(with_news(states, fresh))`` gives.

    ``hist`` is the history of ``states``, ``fresh`` the ``news`` of a batch. Only the versions of touched entities between the last complete state before their first
    late row and the first complete one after their last are built anew, from the states in between; the version valid at the lower end seeds it
    and may end earlier or later, the first version beyond the upper end stays as it is.
    """
    span = fresh.groupBy(key).agg(F.min("start_date").alias("_first"), F.max("start_date").alias("_last"))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in sparse], F.lit(True))
    day = F.col("start_date")
    near = states.join(span, key).groupBy(key).agg(
        F.max(F.when(complete & (day < F.col("_first")), day)).alias("_low"), F.min(F.when(complete & (day > F.col("_last")), day)).alias("_high")
    )
    near = span.join(near, key, "left").select(key, "_low", "_high")
    # of each touched entity: the seed, which holds at the lower end, and the versions beyond the upper end
    touched = hist.join(near, key)
    seed = (F.col("start_date") <= F.col("_low")) & (F.col("end_date") > F.col("_low"))
    beyond = F.col("_high").isNotNull() & (F.col("start_date") > F.col("_high"))
    follows = touched.filter(beyond).groupBy(key).agg(F.min("start_date").alias("_stop"))
    seeds = touched.filter(seed).select(key, "start_date", *attrs)
    inner = (F.col("_low").isNull() | (day > F.col("_low"))) & (F.col("_high").isNull() | (day <= F.col("_high")))
    between = with_news(states.join(near, key).filter(inner).drop("_low", "_high"), fresh, key).select(key, "start_date", *attrs)
    rebuilt = versions_until(seeds.unionByName(between), follows, key, attrs, sparse, money)
    before = F.col("_low").isNotNull() & (F.col("end_date") <= F.col("_low"))
    left = hist.join(near.withColumn("_near", F.lit(1)), key, "left").filter(F.col("_near").isNull() | before | beyond).select(*hist.columns)
    return left.unionByName(rebuilt.select(*hist.columns))


def versions_until(states: DataFrame, stops: DataFrame, key: str, attrs: Sequence[str], sparse: Sequence[str], money: bool) -> DataFrame:
    """``versions_of`` where an entity with a stop has its last version end there, and not current."""
    made = versions_of(states, key, attrs, sparse, money).join(stops, key, "left")
    cut = (F.col("current_record") == 1) & F.col("_stop").isNotNull()
    return made.withColumns(
        {"end_date": F.when(cut, F.col("_stop")).otherwise(F.col("end_date")), "current_record": F.when(cut, 0).otherwise(F.col("current_record"))}
    ).drop("_stop")
