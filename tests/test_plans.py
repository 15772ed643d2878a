"""Fact loads on small literal tables."""

import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from strataledger.plans import referrals, snapshot, terminations, transactions

D = dt.date


def day(n):
    return D(2024, 1, n)


def test_termination_events(spark):
    states = [("a", day(1), "click"), ("a", day(2), "error"), ("a", day(4), "signup"), ("a", day(6), "error"), ("a", day(7), "view"),
              ("a", day(9), "signup"), ("b", day(1), "error")]
    history = spark.createDataFrame(states, "who string, start_date date, state string")
    got = terminations.termination_events(history, "who", "state", "error", ["view", "click"], "signup")
    cols = ["who", "event_date", "threat_count", "save_count", "term_count", "save_date", "term_date", "completed"]
    assert rows(got, *cols) == {
        ("a", day(2), 1, 0, 1, None, day(4), 1): 1,
        ("a", day(6), 1, 1, 0, day(7), None, 1): 1,
        ("a", day(9), 0, 0, 1, None, day(9), 1): 1,   # no threat before it
        ("b", day(1), 1, 0, 0, None, None, 0): 1,     # still open
    }


def test_clearance_windows(spark):
    onboarding = spark.createDataFrame([("a", day(2), day(3)), ("a", day(10), None)], "who string, s date, c date")
    windows = terminations.clearance_windows(onboarding, "who", "s", "c")
    events = spark.createDataFrame([("a", day(n)) for n in (1, 2, 9, 10)] + [("z", day(5))], "who string, at date")
    got = terminations.clearance_type(events, windows, "who", "at")
    assert rows(got, "who", "at", "clearance_type") == {
        ("a", day(1), "Non-Trading"): 1, ("a", day(2), "Trading"): 1, ("a", day(9), "Trading"): 1,
        ("a", day(10), "Non-Trading"): 1, ("z", day(5), "Non-Trading"): 1,
    }


def test_lowest_active_is_clipped_and_closed(spark):
    spine = spark.createDataFrame([("a", day(n)) for n in range(1, 5)], "who string, day date")
    windows = spark.createDataFrame(
        [("a", D(2023, 1, 1), day(2), 7), ("a", day(2), D(9999, 12, 31), 9), ("a", D(2025, 1, 1), D(2025, 1, 2), 1), ("b", day(1), day(2), 1)],
        "who string, start_date date, end_date date, v int",
    )
    got = snapshot.lowest_active(spine, windows, "who", "day", F.col("v"), "v")
    assert rows(got) == {("a", day(1), 7): 1, ("a", day(2), 7): 1, ("a", day(3), 9): 1, ("a", day(4), 9): 1}


def test_a_review_alone_clears_a_violation(spark):
    ruled = spark.createDataFrame([("a", day(n), 2) for n in range(1, 9)], "who string, day date, rule_days int")
    activity = spark.createDataFrame([("a", 5, day(3), "review"), ("a", 4, day(6), "review")], "who string, id int, d date, kind string")
    got = snapshot.contact_violation(
        ruled, activity, "who", "day", F.col("d"), F.col("kind") == "contact", F.col("kind") == "review", "id"
    )
    # the review with the larger id stays the latest one although another has a later day
    want = {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1, 7: 1, 8: 1}
    assert rows(got, "date_key", "violation") == {(20240100 + n, v): 1 for n, v in want.items()}


def test_cancelled_transactions_appear_twice(spark):
    flows = spark.createDataFrame([(1, None), (2, day(5))], "id int, off date")
    got = transactions.new_and_cancelled(flows, "off")
    assert rows(got, "id", "record_type", "off") == {
        (1, "New Record", None): 1, (2, "New Record", None): 1, (2, "Cancelled Record", day(5)): 1
    }


def test_credited_people(spark):
    refs = spark.createDataFrame(
        [("US", 1, day(9), " x ", "y"), ("EU", 2, day(9), "?", "y"), ("US", 3, day(9), "?", "y"), ("US", 4, D(2020, 1, 1), "x", "?")],
        "source string, referral_id int, referral_date date, user_id string, user_name string",
    )
    people = spark.createDataFrame(
        [("x", 20, D(2021, 1, 1), D(2021, 1, 1), None), ("y", 10, D(2021, 1, 1), D(2021, 1, 1), None)],
        "user_id string, person_id int, first_start date, last_start date, left_on date",
    )
    got = referrals.credited(refs, people, F.col("source") == "US")
    # 1: both fields name someone, the smaller id; 2: names do not count in this source; 4: not employed yet
    assert rows(got) == {("US", 1, 10): 1, ("US", 3, 10): 1}


def test_attribution_waterfall(spark):
    explicit = spark.createDataFrame([(1, 7)], "id int, owner int")
    derived = spark.createDataFrame([(1, 8), (2, 9), (3, 9)], "id int, owner int")
    everyone = spark.createDataFrame([(1,), (2,)], "id int")
    got = referrals.attribution_waterfall(explicit, everyone, derived, ["id"])
    assert rows(got, "id", "owner", "attribution") == {(1, 7, "Credited"): 1, (2, 9, "Derived"): 1}


def runs(spark, tmp_path, cuts):
    """The snapshot of 24 days in loads that end at the cuts, each with the state stored by the one before and the activity after it."""
    log = [(i, "ab"[i % 2], day(1 + (i * 7) % 20), ("contact", "review", "other")[i % 3]) for i in range(24)] + [("x", "c", day(2), "contact"), (None, None, day(3), "review")]
    activity = spark.createDataFrame([(str(i), w, d, k) for i, w, d, k in log], "id string, who string, d date, kind string")
    folder = f"{tmp_path}/activity{len(cuts)}"
    activity.write.partitionBy("d").parquet(folder)
    activity = spark.read.parquet(folder)
    spine = spark.createDataFrame([(w, day(n)) for w in "abc" for n in range(1, 25)], "who string, day date")
    history = spark.createDataFrame([("a", 1, day(1), day(9)), ("a", 2, day(9), D(9999, 12, 31)), ("c", 3, day(5), day(7))], "who string, version_key int, start_date date, end_date date")
    attributes = spark.createDataFrame([("a", 4)], "who string, days int")
    statuses = spark.createDataFrame([(c, r, 10 * c + r) for c in (0, 1) for r in (0, 1)], "contact int, review int, status_key int")
    asked = {"entity": "who", "day": "day", "activity_day": F.col("d"), "contact": F.col("kind") == "contact", "reviews": {"review": (F.col("kind") == "review", 5)}}
    out, state, since = [], None, None
    for n in cuts:
        upto = F.lit(day(n))
        days = spine.filter(F.col("day") <= upto) if since is None else spine.filter((F.col("day") <= upto) & (F.col("day") > since))
        got = snapshot.daily_snapshot(days, activity, history, attributes, statuses, rule=F.col("days"), contact_limit=3, state=state, since=since, **asked)
        out.append(got)
        snapshot.snapshot_state(activity, upto=upto, state=state, since=since, **asked).write.parquet(f"{tmp_path}/state{n}-{len(cuts)}")
        state, since = spark.read.parquet(f"{tmp_path}/state{n}-{len(cuts)}"), upto
    return out, state


def test_snapshot_by_daily_runs_is_the_backfill(spark, tmp_path):
    (whole,), end = runs(spark, tmp_path, [24])
    parts, state = runs(spark, tmp_path, [6, 7, 15, 24])
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    assert rows(merged) == rows(whole, *merged.columns) and sum(rows(whole).values()) == 72
    assert rows(state) == rows(end, *state.columns)
    plan = parts[2]._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "kind" in line]
    assert scans and all("2024-01-07" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)  # no older activity is read
