"""Accumulating snapshot of referrals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY
from ..functions.dates import date_key
from ..operators.asof import prior_within_months
from ..operators.filters import in_subquery
from ..operators.hotkeys import DEFAULT_SPLIT, Split
from ..operators.joins import missing
from ..operators.ordered import first_per_key
from ..operators.temporal import eligible_at, valid_versions
from ..operators.upsert import accumulate, upsert_scd2
from .people import PEOPLE_KEYS, People, with_people

SPANS = ("first_start", "last_start", "left_on")


def attribution_waterfall(explicit: DataFrame, everyone: DataFrame, derived: DataFrame, key: list[str]) -> DataFrame:
    """Explicit owners first, then the derived ones of what is left, each tagged."""
    rest = in_subquery(missing(derived, explicit, key), everyone, key)
    return explicit.withColumn("attribution", F.lit("Credited")).unionByName(
        rest.withColumn("attribution", F.lit("Derived"))
    )


def credited(refs: DataFrame, people: DataFrame, swapped: Column) -> DataFrame:
    """(source, referral_id, person_id) named in the source and employed on the referral date.

    Some sources have id and name in each other's field: there the name field is matched too.
    Two people on one referral: the smaller id.
    """
    staff = people.select(F.trim("user_id").alias("_who"), "person_id", *SPANS)

    def named(rows: DataFrame, field: str) -> DataFrame:
        asked = rows.select("source", "referral_id", "referral_date", F.trim(field).alias("_who"))
        return eligible_at(asked, staff, "_who", "referral_date", *SPANS).select("source", "referral_id", "person_id")

    hits = named(refs, "user_id").unionByName(named(refs.filter(swapped), "user_name"))
    return first_per_key(hits, ["source", "referral_id"], ["person_id"])


def assigned(
    refs: DataFrame, assignments: DataFrame, people: DataFrame, at: Column, out: str
) -> DataFrame:
    """The person assigned to the referred client at a date, if employed then; else NULL."""
    dated = refs.withColumn("_when", at)
    met = valid_versions(dated, assignments, ["client_id"], "_when", "from_date", "to_date", how="left")
    staff = people.select(F.col("person_id").alias("assigned_id"), *SPANS)
    found = eligible_at(met, staff, "assigned_id", "_when", *SPANS, how="left")
    kept = F.when(F.col("first_start").isNotNull(), F.col("assigned_id"))
    return found.withColumn(out, kept).drop("assigned_id", "from_date", "to_date", "_when", *SPANS)


def adjust(history: DataFrame, derived: DataFrame, key: list[str], tracked: list[str], as_of: Column) -> DataFrame:
    """The adjustment history after a load: a referral whose derived values changed gets a new version from the load's day."""
    return upsert_scd2(history, derived.select(*key, *tracked), key, tracked, as_of)


def fact_of(history: DataFrame, key: list[str], tracked: list[str], stored: DataFrame, closed: str) -> DataFrame:
    """The accumulating fact filled from the history's current rows: open rows are updated in full, closed ones stay, new ones are added."""
    current = history.filter("current_record = 1").select(*key, *tracked)
    still_open = F.coalesce(F.col(closed), F.lit(0)) == 0
    rule = {c: F.when(still_open, F.col(f"s_{c}")).otherwise(F.col(c)) for c in tracked}
    return accumulate(stored, current, key, [rule])


def referral_fact(
    refs: DataFrame, people: DataFrame, assignments: DataFrame, funded: DataFrame, swapped: Column,
    split: Split = DEFAULT_SPLIT, behind: People | None = None,
) -> DataFrame:
    """One row per referral with its people, twelve-month flag and funding state.

    ``refs``: source, referral_id, client_id, referral_date, user_id, user_name;
    ``funded``: referral_id, trading_date. The people named on a referral come first; the rest
    is derived in the same pass, by giving the named rows no date to look up. With ``behind``
    rows also have the keys of the people behind the client at the referral date.
    """
    key = ["source", "referral_id"]
    rows = refs.join(funded, "referral_id", "left").join(credited(refs, people, swapped), key, "left")
    named, is_funded = F.col("person_id").isNotNull(), F.col("trading_date").isNotNull()
    for at, out in (("referral_date", "_submitted"), ("trading_date", "_funded")):
        rows = assigned(rows, assignments, people, F.when(~named, F.col(at)), out)
    submitted = F.coalesce("person_id", "_submitted", F.lit(UNKNOWN_KEY))
    paid = F.coalesce(F.when(is_funded, F.col("person_id")), "_funded", F.lit(UNKNOWN_KEY))
    flagged = prior_within_months(
        rows, ["client_id", "source"], "referral_date", "referral_id", 12, "referred_in_12_months", split
    )
    flagged, staff = (flagged, []) if behind is None else (with_people(flagged, "client_id", "referral_date", behind), PEOPLE_KEYS)
    return flagged.select(
        *key, "client_id", F.when(named, "Credited").otherwise("Derived").alias("attribution"),
        submitted.alias("person_key"), paid.alias("person_funded_key"),
        date_key(F.col("referral_date")).alias("referral_date_key"),
        F.coalesce(date_key(F.col("trading_date")), F.lit(UNKNOWN_KEY)).alias("trading_date_key"),
        F.lit(1).alias("referral_count"), is_funded.cast("int").alias("funded_count"), "referred_in_12_months",
        F.datediff("trading_date", "referral_date").alias("funding_days_lag"), is_funded.cast("int").alias("completed"),
        *staff,
    )
