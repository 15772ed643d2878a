"""Late changes: whatever the order of arrival, the history is that of the whole log, and only its neighbourhood is built anew."""

import datetime as dt
import random

import pytest
from helpers import rows, same
from pyspark.sql import functions as F

from strataledger.operators.history import build_scd2
from strataledger.operators.late import day_states, news, restitch, versions_of, with_news

START = dt.datetime(2024, 1, 1)
SCHEMA = "who string, at timestamp_ntz, id int, a string, b int"


def log(seed, n):
    rng = random.Random(seed)
    return [
        (rng.choice("xxxxyz"), START + dt.timedelta(days=rng.randrange(25), hours=rng.randrange(24)), i, rng.choice("AAB"), rng.choice([None, None, 1, 2]))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("sparse", [[], ["b"], ["a", "b"]])
def test_any_order_of_arrival(spark, tmp_path, seed, sparse):
    rng = random.Random(seed)
    whole = [r if "a" not in sparse or rng.random() < 0.6 else (*r[:3], None, r[4]) for r in log(seed, 60)]
    arriving = rng.sample(whole, len(whole))
    cuts = sorted(rng.sample(range(len(whole)), 2))
    batches = [spark.createDataFrame(b, SCHEMA) for b in (arriving[: cuts[0]], arriving[cuts[0] : cuts[1]], arriving[cuts[1] :], arriving[:20])]
    states = day_states(batches[0], "who", "at", "id", ["a", "b"])
    hist = versions_of(states, "who", ["a", "b"], sparse)
    for i, batch in enumerate(batches[1:]):
        fresh = news(states, day_states(batch, "who", "at", "id", ["a", "b"]), "who", "at", "id")
        hist, states = restitch(hist, states, fresh, "who", ["a", "b"], sparse), with_news(states, fresh, "who")
        for name, df in (("h", hist), ("s", states)):
            df.write.parquet(f"{tmp_path}/{name}{i}")
        if i == 2:
            assert fresh.isEmpty()  # all of these rows have come before
        hist, states = spark.read.parquet(f"{tmp_path}/h{i}"), spark.read.parquet(f"{tmp_path}/s{i}")
    same(hist, build_scd2(spark.createDataFrame(whole, SCHEMA), "who", "at", "id", ["a", "b"], sparse))


def test_only_the_neighbourhood_is_built(spark):
    """Versions that the late row does not touch pass by as they are stored, even if the states would say otherwise."""
    base = [("x", START + dt.timedelta(days=3 * i), i, "AB"[i % 2], 1) for i in range(10)] + [("y", START, 99, "A", 1)]
    states = day_states(spark.createDataFrame(base, SCHEMA), "who", "at", "id", ["a", "b"])
    hist = versions_of(states, "who", ["a", "b"]).withColumn("a", F.concat(F.lit("stored "), "a"))
    late = spark.createDataFrame([("x", START + dt.timedelta(days=13), 50, "C", 1)], SCHEMA)
    fresh = news(states, day_states(late, "who", "at", "id", ["a", "b"]), "who", "at", "id")
    out = restitch(hist, states, fresh, "who", ["a", "b"])
    day = [START.date() + dt.timedelta(days=d) for d in range(40)]
    assert rows(out.filter("who = 'x' and a not like 'stored%'"), "a", "start_date", "end_date", "current_record") == {
        ("C", day[13], day[15], 0): 1, ("B", day[15], day[18], 0): 1,
    }
    seed = rows(out.filter("who = 'x' and a like 'stored%'"), "start_date", "end_date")
    assert seed == {(day[3 * i], dt.date(9999, 12, 31) if i == 9 else day[13] if i == 4 else day[3 * i + 3]): 1 for i in range(10) if i != 5}
    assert rows(out.filter("who = 'y'")) == rows(hist.filter("who = 'y'"))


def test_equal_neighbours_merge_and_a_seen_value_comes_back(spark):
    base = [("x", START, 1, "A", 1), ("x", START + dt.timedelta(days=4), 2, "A", 1), ("x", START + dt.timedelta(days=8), 3, "B", 1)]
    states = day_states(spark.createDataFrame(base, SCHEMA), "who", "at", "id", ["a", "b"])
    hist = versions_of(states, "who", ["a", "b"])
    d = [START.date() + dt.timedelta(days=i) for i in range(10)]
    far = dt.date(9999, 12, 31)

    def after(days, value):
        late = spark.createDataFrame([("x", START + dt.timedelta(days=days, hours=5), 9, value, 1)], SCHEMA)
        fresh = news(states, day_states(late, "who", "at", "id", ["a", "b"]), "who", "at", "id")
        return rows(restitch(hist, states, fresh, "who", ["a", "b"]), "a", "start_date", "end_date")

    assert after(2, "B") == {("A", d[0], d[2]): 1, ("B", d[2], d[4]): 1, ("A", d[4], d[8]): 1, ("B", d[8], far): 1}
    assert after(8, "A") == {("A", d[0], far): 1}
    assert after(2, "A") == {("A", d[0], d[8]): 1, ("B", d[8], far): 1}
    assert after(9, "C") == {("A", d[0], d[8]): 1, ("B", d[8], d[9]): 1, ("C", d[9], far): 1}
