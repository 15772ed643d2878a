"""Periodic snapshot: one row per entity and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY
from ..functions.dates import date_key
from ..operators.asof import carried_state, carry_forward, days_since, signal_days, within
from ..operators.joins import lookup_by_labels, lookup_key, missing
from ..operators.ordered import running
from ..operators.project import waterfall
from ..operators.upsert import update_type1
from .people import CHAIN, PEOPLE_KEYS, People, graded, people_days


def daily_snapshot(
    spine: DataFrame,
    activities: DataFrame,
    history: DataFrame,
    attributes: DataFrame,
    statuses: DataFrame,
    entity: str,
    day: str,
    activity_day: Column,
    contact: Column,
    reviews: Mapping[str, tuple[Column, int]],
    rule: Column,
    contact_limit: int,
    loaded: DataFrame | None = None,
    people: People | None = None,
    state: DataFrame | None = None,
    since: Column | None = None,
) -> DataFrame:
    """Rolling flags, contact rule and keys of every (entity, day) that is not loaded yet.

    ``history`` has (entity, version_key, start_date, end_date), ``attributes`` one row per
    entity, ``statuses`` the flag combinations with ``status_key``. Days already loaded are
    removed first, so a daily run only works on the new days. ``reviews`` maps a flag to its
    condition and look-back in days. With ``state`` (see ``snapshot_state``) of the day ``since``,
    only activity after that day is used, so a daily run need not read any older one; the spine then
    has days after it only. With ``people`` rows also have the keys of the people behind
    them. All groups are bounded by the calendar.
    """
    todo = spine if loaded is None else missing(spine, loaded, [entity, day])
    signals = _signals(contact, reviews)
    fresh = activities if since is None else activities.filter(activity_day > since)
    activity = signal_days(fresh, entity, day, activity_day, signals)
    if since is not None:
        history = history.filter(F.col("end_date") > since)
    # the version valid on a day is carried forward too, instead of pairing days with versions
    versions = history.select(
        entity, F.col("start_date").alias(day), F.struct("version_key", "end_date").alias("_version")
    )
    parts, carried = [activity, versions], [*signals, "_version"]
    if state is not None:
        parts = [*parts, state]
    if people is not None:
        parts, carried = [*parts, people_days(people, entity, day, "_people")], [*carried, "_people"]
    seen = carry_forward(todo, entity, day, parts, carried)
    seen = seen.withColumns({s: F.datediff(day, s) for s in signals})
    known = seen.join(attributes.hint("merge"), entity, "left").withColumn("rule_days", rule)
    valid = F.col("_version.end_date") > F.col(day)
    versioned = known.withColumn("version_key", F.when(valid, F.col("_version.version_key")))
    flags = {"contact": within(F.col("_contact"), contact_limit)}
    flags.update({n: within(F.col(f"_{n}"), limit) for n, (_, limit) in reviews.items()})
    flagged = versioned.withColumns(flags)
    keyed = lookup_by_labels(flagged, statuses, {n: F.col(n) for n in flags}, "status_key")
    extra = [c for c in attributes.columns if c.endswith("_key")]
    staff = []
    if people is not None:
        there = F.col("_people._until") > F.col(day)
        keyed = graded(keyed.withColumns({c: F.when(there, F.col("_people")[c]) for c in CHAIN}), entity, day, people)
        staff = PEOPLE_KEYS
    return keyed.select(
        entity, date_key(F.col(day)).alias("date_key"),
        *[F.coalesce(c, F.lit(UNKNOWN_KEY)).alias(c) for c in ["version_key", *extra]],
        "rule_days", "status_key", *flags,
        within(F.col("_contact"), F.col("rule_days")).alias("contact_in_rule"),
        F.col("_contact").alias("contact_lag"), F.lit(1).alias("client_count"), *staff,
    )


def _signals(contact: Column, reviews: Mapping[str, tuple[Column, int]]) -> dict[str, Column]:
    return {"_contact": contact, **{f"_{n}": cond for n, (cond, _) in reviews.items()}}


def snapshot_state(
    activities: DataFrame, entity: str, day: str, activity_day: Column, contact: Column, reviews: Mapping[str, tuple[Column, int]],
    upto: Column, state: DataFrame | None = None, since: Column | None = None,
) -> DataFrame:
    """One row per entity: the last day of each of the snapshot's signals up to ``upto``, to be stored with the load of that day.

    With the stored ``state`` of the day ``since`` only the activity after it is folded in. A state is the same however the days are cut into loads.
    Activity that arrives after the state of its day was stored is not in it: a backfill from before that day takes it in.
    """
    signals = _signals(contact, reviews)
    fresh = activities if since is None else activities.filter(activity_day > since)
    daily = signal_days(fresh.filter(activity_day <= upto), entity, day, activity_day, signals)
    return carried_state([daily], entity, day, list(signals), upto, state)


def lowest_active(
    spine: DataFrame, windows: DataFrame, entity: str, day: str, value: Column, out: str
) -> DataFrame:
    """(entity, day, out): the lowest value of the windows [start, end] active on a day.

    Windows are clipped to the entity's spine and unrolled into their days, which makes exactly
    the matching pairs; the lowest value per day is a map-side combined aggregate.
    """
    spans = spine.groupBy(entity).agg(F.min(day).alias("_from"), F.max(day).alias("_to"))
    first, last = F.greatest("start_date", "_from"), F.least("end_date", "_to")
    days = windows.join(spans, entity).filter(first <= last).withColumn(day, F.explode(F.sequence(first, last)))
    return days.select(entity, day, value.alias(out)).groupBy(entity, day).agg(F.min(out).alias(out))


def contact_rules(
    spine: DataFrame, attributes: DataFrame, rules: Sequence[tuple[str, DataFrame | Column]],
    entity: str, day: str, default: int,
) -> DataFrame:
    """Rule days of each spine day by priority.

    A rule is a column over ``attributes``, a frame (entity, day, name) or segments (entity,
    start_date, end_date, name) as of ``lowest_segments``, which are all carried over the spine in one
    pass; the rules are computed independently and joined once instead of being written over each other.
    """
    segments = {n: r for n, r in rules if isinstance(r, DataFrame) and "start_date" in r.columns}
    parts = [r.select(entity, F.col("start_date").alias(day), F.struct(n, "end_date").alias(f"_{n}")) for n, r in segments.items()]
    rows = carry_forward(spine, entity, day, parts, [f"_{n}" for n in segments]) if parts else spine
    rows = rows.join(attributes.hint("merge"), entity, "left")
    names = []
    for name, rule in rules:
        names.append(name)
        if name in segments:
            rows = rows.withColumn(name, F.when(F.col(f"_{name}.end_date") > F.col(day), F.col(f"_{name}.{name}")))
        elif isinstance(rule, DataFrame):
            rows = rows.join(rule, [entity, day], "left")
        else:
            rows = rows.withColumn(name, rule)
    return rows.select(entity, day, waterfall(names, default).alias("rule_days"))


def contact_violation(
    ruled: DataFrame, activities: DataFrame, entity: str, day: str, activity_day: Column,
    contact: Column, review: Column, review_id: str,
) -> DataFrame:
    """0 where a contact or the latest review falls within the day's rule, else 1.

    The latest review is the one with the largest id up to the day. A review alone is enough.
    """
    seen = days_since(ruled, activities, entity, day, activity_day, {"_contact": contact})
    reviews = activities.filter(review).select(entity, activity_day.alias(day), F.col(review_id).alias("_id"))
    top = reviews.groupBy(entity, day).agg(F.max("_id").alias("_id")).select(
        entity, day, F.struct("_id", F.col(day).alias("_on")).alias("_review"), F.lit(0).alias("_side")
    )
    both = seen.withColumn("_side", F.lit(1)).unionByName(top, allowMissingColumns=True)
    done = running(both, [entity], [day, "_side"], maxes={"_last": F.col("_review")}, split=False).filter("_side = 1")
    rule = F.col("rule_days")
    fine = (within(F.col("_contact"), rule) == 1) | (within(F.datediff(day, F.col("_last._on")), rule) == 1)
    return done.select(
        entity, date_key(F.col(day)).alias("date_key"), "rule_days", F.when(fine, 0).otherwise(1).alias("violation")
    )


def update_snapshot(fact: DataFrame, violations: DataFrame, frequencies: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Write the rule's key and the violation into the snapshot rows that exist already."""
    keyed = lookup_key(violations, frequencies, {"rule_days": "rule_days"}, "frequency_key", "frequency_key")
    return update_type1(fact, keyed, keys, ["frequency_key", "violation"])
