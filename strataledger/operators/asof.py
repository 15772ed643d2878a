"""Latest-before lookups, all by one sorted pass instead of a pairing of rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hotkeys import DEFAULT_SPLIT, Split
from .ordered import neighbours, running


def asof_latest(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_at: str,
    right_at: str,
    values: Mapping[str, str],
    strict: bool = False,
    tie: str | None = None,
    max_age_days: int | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Values of the latest right row on or before the left row; every left row is kept.

    Both sides are united and the last right row is carried forward, so the work is one sort
    per key however many snapshots it has. ``strict`` wants an earlier one, ``max_age_days``
    rejects older ones, ``tie`` orders right rows of one moment. ``values`` maps right columns
    to output names.
    """
    image = F.struct(F.col(right_at).alias("_at"), *[F.col(c).alias(o) for c, o in values.items()])
    rank = F.col(tie).cast("long") if tie else F.lit(0).cast("long")
    shots = right.select(*on, F.col(right_at).alias("_when"), image.alias("_shot"), rank.alias("_tie"),
                         F.lit(1 if strict else 0).alias("_side"))
    asks = left.select("*", F.col(left_at).alias("_when"), F.lit(0).cast("long").alias("_tie"),
                       F.lit(0 if strict else 1).alias("_side"), F.lit(1).alias("_ask"))
    both = asks.unionByName(shots, allowMissingColumns=True)
    done = running(both, on, ["_when", "_side", "_tie"], fills={"_got": F.col("_shot")}, split=split)
    got = F.col("_got")
    if max_age_days is not None:
        fresh = F.datediff(F.col(left_at), F.col("_got._at")) <= max_age_days
        got = F.when(fresh, got)
    return (
        done.filter(F.col("_ask") == 1).withColumn("_got", got)
        .select(*left.columns, *[F.col(f"_got.{o}").alias(o) for o in values.values()])
    )


def sum_of_latest(
    events: DataFrame, balances: DataFrame, entity: str, account: str, event_at: str, balance_at: str, value: str,
    max_age_days: int, tie: str | None = None, out: str = "amount",
) -> DataFrame:
    """(entity, event_at, out): at each moment, the sum over the entity's accounts of the latest balance not older than the limit.

    Linear in events plus balances, however many accounts an entity has: a balance is added when it comes and taken off when the account's
    next one comes or it has become too old, and one running sum per entity is read at the events. Moments at which no account has a
    balance are left out.
    """
    order = [balance_at, tie] if tie else [balance_at]
    seen = neighbours(balances, [entity, account], order, after={"_next": F.col(balance_at)})
    kind = balances.schema[balance_at].dataType
    old = F.date_add(F.to_date(balance_at), max_age_days + 1).cast(kind)
    seen = seen.withColumn("_off", F.least(F.col("_next"), old)).filter(F.col("_off") > F.col(balance_at))
    step = F.explode(F.array(
        F.struct(F.col(balance_at).alias("at"), F.col(value).alias("v"), F.lit(1).alias("n")),
        F.struct(F.col("_off").alias("at"), (-F.col(value)).cast(balances.schema[value].dataType).alias("v"), F.lit(-1).alias("n")),
    ))
    changes = seen.select(entity, step.alias("_s")).select(entity, F.col("_s.at").alias("_at"), "_s.v", "_s.n", F.lit(0).alias("_side"))
    asks = events.select(entity, F.col(event_at).cast(kind).alias("_at"), F.col(event_at).alias("_asked"), F.lit(1).alias("_side")).distinct()
    both = changes.unionByName(asks, allowMissingColumns=True)
    done = running(both, [entity], ["_at", "_side"], sums={out: F.col("v"), "_held": F.col("n")})
    return done.filter((F.col("_side") == 1) & (F.col("_held") > 0)).select(entity, F.col("_asked").alias(event_at), out)


def prior_within_months(
    df: DataFrame, keys: Sequence[str], date: str, id_: str, months: int = 12,
    out: str = "has_prior", split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """1 where an earlier record of the party is at most ``months`` old.

    The nearest earlier record (ties by id) is the only one that can qualify first, so the
    self-join is a lag.
    """
    seen = neighbours(df, keys, [date, id_], before={"_prior": F.col(date)}, split=split)
    near = F.col(date) <= F.add_months(F.col("_prior"), months)
    return seen.withColumn(out, F.coalesce(near.cast("int"), F.lit(0))).drop("_prior")


def recurring_lag(
    batch: DataFrame, all_: DataFrame, match: Sequence[str], date: str, out: str = "days_lag",
    stage: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Days since the last earlier transaction that agrees on ``match``.

    Dates are made distinct first, so the ordered groups are bounded by the calendar. ``stage`` may write the dates that have an earlier one
    and read them back, so that their shuffles are over before those of the batch begin.
    """
    days = all_.select(*match, F.to_date(date).alias("_day")).distinct()
    before = neighbours(days, match, ["_day"], before={"_prev": F.col("_day")}, split=False)
    before = stage(before.filter(F.col("_prev").isNotNull())).hint("merge")  # may be as many rows as there are: not for the driver
    dated = batch.withColumn("_day", F.to_date(date))
    joined = dated.join(before, [*match, "_day"], "left")
    return joined.select(*batch.columns, F.datediff("_day", "_prev").alias(out))


def carry_forward(
    spine: DataFrame, on: str, day: str, parts: Sequence[DataFrame], cols: Sequence[str]
) -> DataFrame:
    """Spine days with the latest value of each column on or before the day.

    ``parts`` have (on, day) and some of ``cols``, at most one row per (on, day) each, so groups
    are bounded by the calendar and one sorted pass serves all columns.
    """
    both = spine.withColumn("_side", F.lit(1))
    for part in parts:
        both = both.unionByName(part.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    filled = running(both, [on], [day, "_side"], fills={f"_l_{x}": F.col(x) for x in cols}, split=False)
    return filled.filter(F.col("_side") == 1).select(*spine.columns, *[F.col(f"_l_{x}").alias(x) for x in cols])


def carried_state(
    parts: Sequence[DataFrame], on: str, day: str, cols: Sequence[str], upto: Column, state: DataFrame | None = None
) -> DataFrame:
    """(on, day, cols): what ``carry_forward`` would carry out of the day ``upto``; as a further part, it stands for everything up to that day.

    ``state`` is the stored one of an earlier day; then ``parts`` need only what came after it, and rows of entities without news stay. One aggregate, combined
    before the shuffle. Rows dated after ``upto`` are left out.
    """
    both = None
    for part in [*parts, *([] if state is None else [state])]:
        rows = part.filter(F.col(day) <= upto)
        both = rows if both is None else both.unionByName(rows, allowMissingColumns=True)
    latest = [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(day).alias("d"), F.col(c).alias("v")))).alias(c) for c in cols]
    return both.groupBy(on).agg(*latest).select(on, upto.alias(day), *[F.col(c)["v"].alias(c) for c in cols])


def signal_days(events: DataFrame, on: str, day: str, event_day: Column, signals: Mapping[str, Column]) -> DataFrame:
    """One row per (entity, day) with the day itself under each signal that occurred on it."""
    seen = events.select(on, event_day.alias(day), *[F.coalesce(x, F.lit(False)).alias(s) for s, x in signals.items()])
    daily = seen.groupBy(on, day).agg(*[F.max(s).alias(s) for s in signals])
    return daily.select(on, day, *[F.when(F.col(s), F.col(day)).alias(s) for s in signals])


def days_since(
    spine: DataFrame, events: DataFrame, on: str, day: str, event_day: Column, signals: Mapping[str, Column],
) -> DataFrame:
    """For each spine day and signal, days since the entity's last event with that signal.

    Events are first reduced to the signals of one (entity, day), then carried forward over the
    spine: no day is paired with every event.
    """
    daily = signal_days(events, on, day, event_day, signals)
    done = carry_forward(spine, on, day, [daily], list(signals))
    return done.withColumns({s: F.datediff(day, s) for s in signals})


def within(days: Column, limit: Column | int) -> Column:
    """1 when the last event is 0..limit days old."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    return F.coalesce(days.between(F.lit(0), limit).cast("int"), F.lit(0))
