"""Termination events: a threat, then a save or a termination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY, UNKNOWN_TEXT, max_date
from ..functions.dates import date_key
from ..operators.asof import asof_latest, sum_of_latest
from ..operators.ordered import neighbours
from ..operators.pairing import pair_events, sequence_events, unmatched_closers
from ..operators.temporal import valid_versions
from .people import PEOPLE_KEYS, People, with_people


def termination_events(
    history: DataFrame, entity: str, state: str, threat: str, saved: list[str], lost: str
) -> DataFrame:
    """Threats with their outcome, and terminations that had no threat.

    A history has one version per day, so its ordered groups are bounded by the calendar.
    """
    was = neighbours(history, [entity], ["start_date"], before={"_was": F.col(state)}, split=False)
    was = was.withColumn("_was", F.coalesce("_was", F.lit(UNKNOWN_TEXT)))
    is_threat = (F.col(state) == threat) & (F.col("_was") != threat)
    is_term = (F.col(state) == lost) & (F.col("_was") != lost)
    # a save on the day of a termination does not count
    is_save = (F.col("_was") == threat) & F.col(state).isin(*saved) & ~is_term
    flags = was.withColumns({"term": is_term.cast("int"), "save": is_save.cast("int"), "_tie": F.lit(0)})
    seq = sequence_events(flags, entity, "start_date", "_tie", is_threat, is_term | is_save, ["term", "save", "_was"], split=False)
    paired = pair_events(seq, "start_date")
    at_once = F.col("closes") == 1
    done = F.col("completed") == 1
    term = F.when(at_once, F.col("term")).when(done, F.col("next_term")).otherwise(0)
    save = F.when(at_once, 0).when(done, F.col("next_save")).otherwise(0)
    threats = paired.select(
        entity, F.col("start_date").alias("event_date"), F.col("_was").alias("state_before"), F.lit(1).alias("threat_count"),
        save.alias("save_count"), term.alias("term_count"), F.col("start_date").alias("threat_date"),
        F.when(save == 1, F.col("close_at")).alias("save_date"), F.when(term == 1, F.col("close_at")).alias("term_date"),
        "completed",
    )
    none = F.lit(None).cast("date")
    direct = unmatched_closers(seq).filter("term = 1").select(
        entity, F.col("start_date").alias("event_date"), F.col("_was").alias("state_before"), F.lit(0).alias("threat_count"),
        F.lit(0).alias("save_count"), F.lit(1).alias("term_count"), none.alias("threat_date"), none.alias("save_date"),
        F.col("start_date").alias("term_date"), F.lit(1).alias("completed"),
    )
    return threats.unionByName(direct)


def clearance_windows(onboarding: DataFrame, entity: str, start: str, cleared: str) -> DataFrame:
    """Windows between onboarding dates with the clearance date each one has, if any."""
    led = neighbours(onboarding, [entity], [start], after={"window_end": F.col(start)}, split=False)
    return led.select(
        entity, F.col(start).alias("window_start"), F.coalesce("window_end", max_date()).alias("window_end"),
        F.col(cleared).alias("cleared_on"),
    )


def clearance_type(events: DataFrame, windows: DataFrame, entity: str, at: str) -> DataFrame:
    """'Trading' where the window around the event was cleared, else 'Non-Trading'."""
    met = valid_versions(events, windows, [entity], at, "window_start", "window_end", how="left")
    kind = F.when(F.col("cleared_on").isNull(), "Non-Trading").otherwise("Trading")
    return met.withColumn("clearance_type", kind).drop("window_start", "window_end", "cleared_on")


def amounts_at_event(
    events: DataFrame, balances: DataFrame, entity: str, account: str, event_at: str, balance_at: str, max_age_days: int
) -> DataFrame:
    """Sum over the entity's accounts of the latest balance not older than ``max_age_days``."""
    return sum_of_latest(events, balances, entity, account, event_at, balance_at, "balance", max_age_days)


def converted_amounts(
    events: DataFrame, balances: DataFrame, rates: DataFrame, entity: str, account: str, currency: str, event_at: str, balance_at: str,
    max_age_days: int, rate_at: str = "rate_date", rate: str = "rate", out: str = "amount",
) -> DataFrame:
    """(entity, event_at, out): the accounts' balances held at each event, per currency converted by the rate valid on the event's day.

    Balances of one currency are summed first (``sum_of_latest``, linear in events and balances), so a rate is applied once for an event and currency. The rate is the
    latest one up to the day; a currency without one counts at 1. ``out`` is rounded to cents per currency. Moments without balances are left out.
    """
    held = balances.withColumn("_of", F.struct(F.col(entity).alias("e"), F.col(currency).alias("c")))
    asked = events.select(entity, event_at).distinct().join(balances.select(entity, currency).distinct(), entity)
    asked = asked.withColumn("_of", F.struct(F.col(entity).alias("e"), F.col(currency).alias("c")))
    sums = sum_of_latest(asked, held, "_of", account, event_at, balance_at, "balance", max_age_days, out="_sum")
    sums = sums.select(F.col("_of.e").alias(entity), F.col("_of.c").alias(currency), event_at, "_sum")
    rated = asof_latest(sums, rates, [currency], event_at, rate_at, {rate: "_rate"})
    value = F.round(F.col("_sum") * F.coalesce("_rate", F.lit(1)), 2).cast("decimal(28,2)")
    return rated.groupBy(entity, event_at).agg(F.sum(value).cast("decimal(28,2)").alias(out))


def termination_fact(
    events: DataFrame, balances: DataFrame, history: DataFrame, windows: DataFrame,
    entity: str, account: str, balance_at: str, max_age_days: int, owner: str, owner_lag_days: int,
    people: People | None = None,
) -> DataFrame:
    """Keys and measures of the events: amount, owner some days before, clearance type, and with ``people`` the keys of the people behind the entity."""
    amounts = amounts_at_event(events, balances, entity, account, "event_date", balance_at, max_age_days)
    owners = history.select(entity, F.col(owner).alias("owner_before"), "start_date", "end_date")

    lagged = events.withColumn("_then", F.date_sub("event_date", owner_lag_days))
    owned = valid_versions(lagged, owners, [entity], "_then", how="left").drop("_then", "start_date", "end_date")
    typed = clearance_type(owned, windows, entity, "event_date")

    def key(name: str) -> Column:
        return F.coalesce(date_key(F.col(name)), F.lit(UNKNOWN_KEY)).alias(f"{name}_key")

    typed, staff = (typed, []) if people is None else (with_people(typed, entity, "event_date", people), PEOPLE_KEYS)
    return typed.join(amounts, [entity, "event_date"], "left").select(
        entity, key("event_date"), key("threat_date"), key("save_date"), key("term_date"),
        "threat_count", "save_count", "term_count", "completed", "amount",
        F.coalesce("owner_before", F.lit(UNKNOWN_TEXT)).alias("owner_before"), "clearance_type", *staff,
    )
