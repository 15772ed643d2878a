"""The interval index against a plain join: both closings, open ends, NULLs, overlaps, chains, and the pairs it compares."""

import datetime as dt
import random
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strataledger.operators.temporal import GRID, LEVELS, blocks_of, looked_up, temporal_join, valid_versions, with_blocks

D = dt.date


def plain(facts, versions, closed, how, shift):
    out = Counter()
    for i, k, at in facts:
        found = 0
        for vk, s, e, v in versions:
            moment = at - dt.timedelta(shift) if at else None
            if k is None or vk != k or moment is None or s is None or not s <= moment:
                continue
            if e is None and moment < D(9999, 12, 31) or e is not None and (moment < e or closed == "both" and moment == e):
                out[i, k, at, s, e, v] += 1
                found += 1
        if not found and how == "left":
            out[i, k, at, None, None, None] += 1
    return out


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("shift", [0, 9])
def test_finds_what_a_plain_join_finds(spark, closed, how, shift):
    rng = random.Random(3)
    base = D(2020, 1, 1)

    def date(wide):
        return rng.choice([base + dt.timedelta(rng.randrange(wide))] * 8 + [None, D(1850, 5, 5), D(2090, 1, 1), D(1900, 1, 1), D(2079, 6, 6), D(2079, 6, 7)])

    versions = []
    for i in range(300):
        s = date(900)
        e = rng.choice([None, D(9999, 12, 31), s, date(900), s and s + dt.timedelta(rng.choice([1, 3, 4, 15, 16, 17, 64, 400]))])
        versions.append((rng.choice([None, 1, 1, 2, 3]), s, e, i))
    facts = [(i, rng.choice([None, 1, 1, 1, 2, 4]), date(900)) for i in range(400)]
    fact = spark.createDataFrame(facts + facts[:9], "id int, k int, at date")
    hist = spark.createDataFrame(versions, "k int, start_date date, end_date date, v int")
    got = temporal_join(fact, hist, ["k"], "at", closed=closed, how=how, shift_days=shift)
    want = plain(facts + facts[:9], versions, closed, how, shift)
    assert rows(got, "id", "k", "at", "start_date", "end_date", "v") == want
    if not shift:
        direct = valid_versions(fact, hist, ["k"], "at", closed=closed, how=how)
        assert rows(direct, "id", "k", "at", "start_date", "end_date", "v") == want


def test_moments_within_a_day(spark):
    hist = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 17), "a"), (1, dt.datetime(2024, 1, 1, 17), None, "b")],
                                 "k int, start_date timestamp_ntz, end_date timestamp_ntz, v string")
    facts = spark.createDataFrame([(h, 1, dt.datetime(2024, 1, d, h)) for d, h in ((1, 8), (1, 9), (1, 16), (1, 17), (2, 3))], "h int, k int, at timestamp_ntz")
    assert rows(temporal_join(facts, hist, ["k"], "at", how="left"), "h", "v") == {(8, None): 1, (9, "a"): 1, (16, "a"): 1, (17, "b"): 1, (3, "b"): 1}


def test_every_day_lies_in_one_block_of_an_interval(spark):
    spans = [(0, 0), (0, 3), (1, 4), (3, 3), (5, 70), (0, 65_535), (17, 65_535), (63, 64), (1_000, 21_844), (9, 8)]
    first = D(1900, 1, 1)
    df = spark.createDataFrame([(a, b, first + dt.timedelta(a), first + dt.timedelta(b)) for a, b in spans], "a int, b int, s date, e date")
    found = with_blocks(df, F.col("s"), F.col("e"), "x").groupBy("a", "b").agg(F.collect_list("x").alias("blocks")).collect()
    assert {(r["a"], r["b"]) for r in found} == {s for s in spans if s[0] <= s[1]}
    for r in found:
        days = Counter()
        for x in r["blocks"]:
            size = GRID ** (x >> 20)
            days.update(range((x & 0xFFFFF) * size, (x & 0xFFFFF) * size + size) if r["b"] - r["a"] < 1000 else [])
        assert r["b"] - r["a"] >= 1000 or days == Counter(range(r["a"], r["b"] + 1))
        assert sum(GRID ** (x >> 20) for x in r["blocks"]) == r["b"] - r["a"] + 1 and len(r["blocks"]) <= 2 * GRID * LEVELS
    one = spark.range(1).select(blocks_of(F.lit(first + dt.timedelta(77))).alias("b")).first()["b"]
    assert one == [(77 // GRID**i) + (i << 20) for i in range(LEVELS)]




def test_pairs_compared_follow_the_result(spark):
    """One entity with 5,000 versions and a million facts."""
    base = F.lit("2010-01-01").cast("date")
    hist = spark.range(5_000).select(F.lit(1).alias("k"), F.date_add(base, F.col("id").cast("int")).alias("start_date"),
                                     F.date_add(base, (F.col("id") + 1 + F.col("id") % 3).cast("int")).alias("end_date"), F.col("id").alias("v"))
    facts = spark.range(1_000_000).select(F.lit(1).alias("k"), F.date_add(base, (F.col("id") % 5_000).cast("int")).alias("at"))
    out = temporal_join(facts, hist, ["k"], "at")
    asked = facts.select("k", "at").distinct().withColumn("b", F.explode(blocks_of(F.col("at"))))
    index = with_blocks(hist, F.col("start_date"), F.col("end_date"), "b").select("k", "b")
    pairs, found = asked.join(index, ["k", "b"]).count(), out.select("k", "at", "v").distinct().count()
    assert out.count() == 200 * found and pairs <= 2.1 * found  # an excluded end day is compared once


@pytest.mark.parametrize("links", [1, 2, 5])
def test_chains_read_the_fact_twice(spark, sf, links):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("k0"), F.to_date("o_orderdate").alias("at"))
    far = F.lit("9999-12-31").cast("date")

    def step(i):
        hist = spark.range(200).select(F.col("id").alias(f"k{i}"), (F.col("id") % 50).alias(f"k{i + 1}"), F.lit("1990-01-01").cast("date").alias("s"), far.alias("e"))
        return lambda df: valid_versions(df, hist, [f"k{i}"], "at", "s", "e", how="left").drop("s", "e")

    out = looked_up(orders, ["k0", "at"], [step(i) for i in range(links)])
    assert out.count() == orders.count()
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("FileScan") <= 2


def made_by_explode(df, column):
    """Rows that the explode into ``column`` made when ``df`` ran."""
    df.collect()

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        own = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" and f"[{column}#" in node.toString().splitlines()[0] else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_rows_without_date_or_key_are_not_repeated(spark):
    """They meet nothing: a left lookup keeps each of them as one row, an inner one drops it before the join."""
    history = spark.createDataFrame([(1, D(2024, 1, 1), None, "a")], "k int, start_date date, end_date date, v string")
    asked = spark.range(90).select(F.lit(1).alias("k"), F.lit(None).cast("date").alias("day"))
    asked = asked.unionByName(spark.range(5).select(F.lit(None).cast("int").alias("k"), F.lit(D(2024, 1, 1)).alias("day")))
    asked = asked.unionByName(spark.range(5).select(F.lit(1).alias("k"), F.lit(D(2024, 1, 1)).alias("day")))
    left = valid_versions(asked, history, ["k"], "day", how="left")
    assert left.count() == 100 and left.filter("v = 'a'").count() == 5
    assert made_by_explode(left, "_block") == 95 + 5 * 6
    inner = valid_versions(asked, history, ["k"], "day")
    assert inner.count() == 5 and made_by_explode(inner, "_block") == 5 * 5
