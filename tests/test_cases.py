"""State scans and termination cases against loops over single events."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strataledger.operators.machine import scan_states
from strataledger.plans import cases

D = dt.date


def looped(events, moves, start=0):
    state, out = defaultdict(lambda: start), Counter()
    for k, at, i, s in sorted(events, key=lambda e: (e[1] is not None, e[1] or dt.datetime.min, e[2])):
        was = state[k]
        if s is not None and 0 <= s < len(moves):
            state[k] = moves[s][was]
        out[k, i, was, state[k]] += 1
    return out


@pytest.mark.parametrize(("kind", "spread"), [("timestamp_ntz", 400), ("timestamp_ntz", 10**9), ("date", 30), ("date", 20_000)])
def test_states_are_those_of_a_loop(spark, kind, spread):
    rng = random.Random(spread)
    moves = [[rng.randrange(5) for _ in range(5)] for _ in range(4)] + [[0, 1, 2, 3, 4]]
    events = []
    for i in range(1_500):
        at = dt.datetime(1990, 1, 1) + (dt.timedelta(seconds=rng.randrange(spread)) if kind != "date" else dt.timedelta(days=rng.randrange(spread)))
        events.append((rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([at] * 20 + [None]), i, rng.choice([None, -1, 9, 0, 1, 2, 3, 4])))
    df = spark.createDataFrame(events, "k int, at timestamp_ntz, i int, s int").repartition(4).withColumn("at", F.col("at").cast(kind))
    out = scan_states(df, "k", "at", "i", "s", moves, start=3)
    assert out.columns == ["k", "at", "i", "s", "state_before", "state_after"]
    assert rows(out, "k", "i", "state_before", "state_after") == looped(events, moves, 3)
    assert scan_states(df.limit(0), "k", "at", "i", "s", moves).isEmpty()


def test_case_states(spark):
    day = [dt.datetime(2024, 1, n) for n in range(1, 20)]
    log = [
        (1, "a", day[1], 1, "opened"), (1, "a", day[3], 2, "saved"), (1, "a", day[5], 3, "reopened"), (1, "a", day[7], 4, "lost"), (1, "a", day[8], 5, "note"),
        (2, "a", day[2], 6, "opened"), (3, "b", day[2], 7, "saved"), (4, "b", day[2], 8, "opened"), (4, "b", day[2], 9, "lost"), (4, "b", day[6], 10, "saved"),
        (5, "c", day[4], 11, "opened"), (5, "c", day[5], 12, "lost"), (5, "c", day[5], 13, "lost"), (5, "c", day[9], 14, "reopened"), (6, "d", day[1], 15, "reopened"),
    ]
    got = cases.case_states(spark.createDataFrame(log, "case_id int, who string, at timestamp_ntz, id int, action string"), "case_id", "who", "at", "id", "action")
    d = [x.date() for x in day]
    assert rows(got, "case_id", "who", "state", "opened_on", "ended_on", "times_reopened") == {
        (1, "a", cases.LOST, d[1], d[7], 1): 1, (2, "a", cases.OPEN, d[2], None, 0): 1, (4, "b", cases.SAVED, d[2], d[6], 0): 1, (5, "c", cases.OPEN, d[4], None, 1): 1,
    }


def test_load_reopens_fills_and_inserts(spark):
    cols = "case_id int, who string, event_date_key int, threat_date_key int, save_date_key int, term_date_key int, threat_count int, save_count int, term_count int, completed int, termination_type string"
    stored = [
        (1, "a", 5, 1, 5, -1, 1, 1, 0, 1, "old"), (2, "a", 5, 1, -1, 5, 1, 0, 1, 1, "old"), (3, "a", 1, 1, -1, -1, 1, 0, 0, 0, "old"),
        (4, "a", 6, 2, 6, -1, 1, 1, 0, 1, "old"), (5, "a", 6, 2, -1, 6, 1, 0, 1, 1, "old"),
    ]
    batch = [
        (1, "a", 1, 1, -1, -1, 1, 0, 0, 0, "new"),    # open again
        (2, "a", 8, 1, 8, -1, 1, 1, 0, 1, "new"),     # flipped from lost to saved
        (3, "a", 9, 1, -1, 9, 1, 0, 1, 1, "new"),     # was open, ends
        (4, "a", 7, 3, 7, -1, 1, 1, 0, 1, "new"),     # completed and unchanged: stays, whatever its dates say
        (6, "b", 4, 4, -1, -1, 1, 0, 0, 0, "new"),    # not stored yet; 5 is not in the batch
    ]
    got = cases.load_cases(spark.createDataFrame(stored, cols), spark.createDataFrame(batch, cols), "case_id")
    assert rows(got) == Counter([
        (1, "a", 1, 1, -1, -1, 1, 0, 0, 0, "old"), (2, "a", 8, 1, 8, -1, 1, 1, 0, 1, "old"), (3, "a", 9, 1, -1, 9, 1, 0, 1, 1, "old"), stored[3], stored[4], batch[4],
    ])
    again = cases.load_cases(got, spark.createDataFrame(batch, cols), "case_id")
    assert rows(again) == rows(got)
