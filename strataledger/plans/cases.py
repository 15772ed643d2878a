"""Termination cases of the system that keeps them by status, and their load into the stored fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY
from ..functions.dates import date_key
from ..operators.machine import scan_states
from ..operators.upsert import accumulate

NONE, OPEN, SAVED, LOST = range(4)
ACTIONS = ["opened", "saved", "lost", "reopened"]
#: After an action, by the state before it: a case must be opened first; a closed one may flip to the other end or be opened again.
MOVES = [
    [OPEN, OPEN, SAVED, LOST],
    [NONE, SAVED, SAVED, SAVED],
    [NONE, LOST, LOST, LOST],
    [NONE, OPEN, OPEN, OPEN],
]


def case_states(log: DataFrame, case: str, entity: str, at: str, tie: str, action: str) -> DataFrame:
    """One row per case that was ever opened: its state, the day it was first opened and the day it came to its end, if it is at one.

    ``log`` has the actions on cases in any order of arrival; actions not in ``ACTIONS`` change nothing. The end's day is that of the last change
    into it: a case that was saved, opened again and lost is lost, at that day.
    """
    symbol = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col(action)).cast("int") - 1
    rows = scan_states(log.select(case, entity, at, tie, symbol.alias("_symbol")), case, at, tie, "_symbol", MOVES)
    day, turned = F.to_date(at), F.col("state_before") != F.col("state_after")
    last = F.max_by("state_after", F.struct(at, tie))
    made = rows.groupBy(case).agg(
        F.max_by(entity, F.struct(at, tie)).alias(entity), last.alias("state"),
        F.min(F.when(turned & (F.col("state_before") == NONE), day)).alias("opened_on"),
        F.max_by(day, F.when(turned & (F.col("state_after") != OPEN), F.struct(at, tie))).alias("ended_on"),
        F.sum((turned & (F.col("state_before") > OPEN) & (F.col("state_after") == OPEN)).cast("int")).cast("int").alias("times_reopened"),
    )
    closed = F.col("state").isin(SAVED, LOST)
    return made.filter(F.col("state") != NONE).withColumn("ended_on", F.when(closed, F.col("ended_on")))


def case_rows(states: DataFrame, case: str, entity: str, kind: Column) -> DataFrame:
    """Fact rows of cases: dated by their end, or by their opening while open; unknown keys where a day is missing."""
    saved, lost = F.col("state") == SAVED, F.col("state") == LOST

    def key(day: Column, name: str) -> Column:
        return F.coalesce(date_key(day), F.lit(UNKNOWN_KEY)).alias(name)

    return states.select(
        case, entity, key(F.coalesce("ended_on", "opened_on"), "event_date_key"), key(F.col("opened_on"), "threat_date_key"),
        key(F.when(saved, F.col("ended_on")), "save_date_key"), key(F.when(lost, F.col("ended_on")), "term_date_key"), F.lit(1).alias("threat_count"),
        saved.cast("int").alias("save_count"), lost.cast("int").alias("term_count"), (saved | lost).cast("int").alias("completed"), kind.alias("termination_type"),
    )


def load_cases(stored: DataFrame, batch: DataFrame, case: str) -> DataFrame:
    """The stored fact after a batch of case rows, in one join and this order: reopen, fill, insert.

    A completed row whose case is open again, or has flipped from one end to the other, is reopened: its ends are cleared. Then open rows take the
    batch's dates, counts and completion; completed ones stay as they are. New cases are added. The termination type is set once and not refreshed.
    """
    flipped = (F.col("save_count") != F.col("s_save_count")) | (F.col("term_count") != F.col("s_term_count"))
    again = (F.col("completed") == 1) & ((F.col("s_completed") == 0) | flipped)
    cleared = {"save_count": 0, "term_count": 0, "save_date_key": UNKNOWN_KEY, "term_date_key": UNKNOWN_KEY, "completed": 0}
    # completion goes last: the conditions of a rule see the row as it was before the rule
    reopen = {c: F.when(again, v).otherwise(F.col(c)) for c, v in cleared.items()}
    taken = ["event_date_key", "threat_date_key", "save_date_key", "term_date_key", "threat_count", "save_count", "term_count", "completed"]
    fill = {c: F.when(F.col("completed") == 0, F.col(f"s_{c}")).otherwise(F.col(c)) for c in taken}
    return accumulate(stored, batch, [case], [reopen, fill])
