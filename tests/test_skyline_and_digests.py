"""Segments of the lowest value against a look at every day, and digests against a full comparison."""

import datetime as dt
import random
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strataledger.operators.digests import differences, differing_leaves, leaf_digests
from strataledger.operators.skyline import lowest_segments

D = dt.date
FAR = D(9999, 12, 31)
SHAPE = "who string, start_date date, end_date date, v int"


@pytest.mark.parametrize("base", [D(2024, 1, 1), D(1899, 12, 20), D(2079, 5, 25), D(2090, 1, 1)])
def test_lowest_value_on_every_day(spark, base):
    rng = random.Random(11)

    def at(n):
        return base + dt.timedelta(n)

    windows = []
    for i in range(120):
        s = rng.randrange(40)
        windows.append((rng.choice(["a", "b", "hot", "hot", None]), at(s), rng.choice([at(s + rng.randrange(-1, 12))] * 9 + [None, FAR]), rng.choice([1, 2, 3, 4, 5, None])))
    windows += [("a", None, at(3), 0), ("a", at(5), at(4), 0), ("z", at(3), None, None)]
    got = lowest_segments(spark.createDataFrame(windows, SHAPE), "who", F.col("v"), "low")
    segments = got.collect()
    days = Counter()
    for r in segments:
        for n in range(-2, 60):
            if r["start_date"] <= at(n) < r["end_date"]:
                days[r["who"], at(n), r["low"]] += 1
    want = Counter()
    for who in ("a", "b", "hot"):
        for n in range(-2, 60):
            live = [v for w, s, e, v in windows if w == who and s and v is not None and s <= at(n) <= (e or FAR)]
            if live:
                want[who, at(n), min(live)] += 1
    assert days == want
    by_start = {(r["who"], r["start_date"]): r["low"] for r in segments}
    assert all(by_start.get((r["who"], r["end_date"])) != r["low"] for r in segments)  # neighbours differ
    assert lowest_segments(spark.createDataFrame([], SHAPE), "who", F.col("v"), "low").count() == 0


def test_long_windows_give_few_rows(spark):
    windows = spark.range(200).select(F.lit("a").alias("who"), F.date_add(F.lit(D(2000, 1, 1)), F.col("id").cast("int")).alias("start_date"), F.lit(FAR).alias("end_date"), (-F.col("id")).alias("v"))
    got = lowest_segments(windows, "who", F.col("v"), "low")
    assert got.count() == 200 and got.agg(F.max("end_date")).first()[0] == FAR


def plain(a, b):
    """(key, kind, count_a, count_b) of the keys whose rows differ as multisets."""
    sides = []
    for table in (a, b):
        by = {}
        for *key, value in table:
            by.setdefault(tuple(key), Counter())[value] += 1
        sides.append(by)
    out = Counter()
    for key in {*sides[0], *sides[1]}:
        x, y = (s.get(key, Counter()) for s in sides)
        if x != y:
            out[(*key, "only_a" if not y else "only_b" if not x else "changed", sum(x.values()), sum(y.values()))] += 1
    return out


@pytest.mark.parametrize("bits", [4, 8, 16, 20])
def test_differences_are_exact(spark, bits):
    rng = random.Random(bits)
    base = [(rng.choice(["p", "q", None]), rng.choice([*range(400), None]), rng.choice(["x", "y", None])) for _ in range(1500)]
    other = [r for r in base if rng.random() > 0.02] + [("new", 1, "x"), (None, None, "z"), base[3], base[3]]
    other = [(k, n, rng.choice(["x", None])) if rng.random() < 0.02 else (k, n, v) for k, n, v in other]
    rng.shuffle(other)
    a, b = (spark.createDataFrame(t, "k string, n int, v string") for t in (base, other))
    got = differences(a, b, ["k", "n"], ["v"], bits)
    assert rows(got) == plain(base, other) and got.count() > 10
    stored = (leaf_digests(a, ["k", "n"], ["v"], bits), leaf_digests(b, ["k", "n"], ["v"], bits))
    assert rows(differences(a, b, ["k", "n"], ["v"], bits, stored)) == rows(got)
    empty = a.limit(0)
    assert rows(differences(a, empty, ["k", "n"], ["v"], bits)) == plain(base, [])
    assert differences(empty, empty, ["k", "n"], ["v"], bits).count() == 0


def test_a_null_that_moves_is_a_change(spark):
    a = spark.createDataFrame([(1, None, "x")], "k int, u string, v string")
    b = spark.createDataFrame([(1, "x", None)], "k int, u string, v string")
    assert rows(differences(a, b, ["k"], ["u", "v"])) == {(1, "changed", 1, 1): 1}


def test_equal_tables_have_no_range_that_differs(spark):
    a = spark.range(5_000).select("id", (F.col("id") % 7).alias("v"))
    b = a.repartition(7).orderBy(F.desc("id"))
    assert differing_leaves(leaf_digests(a, ["id"], ["v"]), leaf_digests(b, ["id"], ["v"])).count() == 0
    changed = b.withColumn("v", F.when(F.col("id") == 77, 9).otherwise(F.col("v")))
    assert differing_leaves(leaf_digests(a, ["id"], ["v"]), leaf_digests(changed, ["id"], ["v"])).count() == 1
