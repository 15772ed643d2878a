"""Flat histories against day-by-day lookups, and the people of a fact against the chain of joins."""

import datetime as dt
import random
from collections import Counter

from helpers import rows, same
from pyspark.sql import functions as F

from strataledger.operators.align import aligned, linked
from strataledger.operators.asof import carry_forward
from strataledger.operators.temporal import cover_sql, day_sql, point_sql
from strataledger.plans.people import CHAIN, PEOPLE_KEYS, People, graded, people_days, person_history, person_keys, with_people

D = dt.date
BASE, FAR = D(2020, 1, 1), D(9999, 12, 31)


def at(n):
    return BASE + dt.timedelta(n)


def versions(rng, keys, values, gaps=0.3, horizon=60):
    """Versions of each key without overlap, with gaps; some ends are open."""
    out = []
    for k in keys:
        cuts = sorted(rng.sample(range(horizon), rng.randrange(1, 8)))
        for a, b in zip(cuts, [*cuts[1:], None]):
            if rng.random() >= gaps:
                out.append((k, at(a), at(b) if b is not None else rng.choice([None, FAR, at(horizon)]), rng.choice(values)))
    return out


def valid(table, key, day):
    return next((v for k, s, e, v in table if k == key and k is not None and s is not None and s <= day and (e is None or day < e)), None)


def by_day(flat, key_values, cols):
    """(key, day) -> values of the segments, over the first 70 days; segments do not overlap."""
    out = Counter()
    for r in flat.collect():
        for n in range(-2, 70):
            if r["start_date"] <= at(n) < r["end_date"]:
                out[(r[key_values], at(n), *[r[c] for c in cols])] += 1
    return out


def test_aligned_is_the_active_row_of_each_history(spark):
    rng = random.Random(5)
    keys = [f"k{i}" for i in range(12)] + ["hot"]
    tables = [versions(rng, keys, ["x", "y", None]) for _ in range(3)]
    # versions of no day, without a start and of no entity count for nothing
    odd = [("k0", at(80), at(80), "z"), ("k0", None, at(9), "z"), (None, at(1), at(2), "z")]
    frames = [spark.createDataFrame(t + odd, f"k string, start_date date, end_date date, v{i} string") for i, t in enumerate(tables)]
    flat = aligned({f"h{i}": (f, [f"v{i}"]) for i, f in enumerate(frames)}, "k")
    want = Counter()
    for k in keys:
        for n in range(-2, 70):
            there = [any(kk == k and s <= at(n) and (e is None or at(n) < e) for kk, s, e, _ in t) for t in tables]
            if any(there):
                want[(k, at(n), *[valid(t, k, at(n)) for t in tables])] += 1
    assert by_day(flat, "k", ["v0", "v1", "v2"]) == want


def test_aligned_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, start_date date, end_date date, v string")
    assert aligned({"a": (empty, ["v"])}, "k").count() == 0


def test_linked_follows_the_link_at_every_date(spark):
    rng = random.Random(6)
    keys, owners = [f"k{i}" for i in range(15)], ["a", "b", "c", None, "nobody"]
    first, second = versions(rng, keys, owners), versions(rng, ["a", "b", "c"], ["x", "y"])
    second += [("a", at(90), at(90), "z"), ("b", None, at(3), "z"), (None, at(1), None, "z")]
    flat = linked(
        spark.createDataFrame(first, "k string, start_date date, end_date date, owner string"), "k",
        spark.createDataFrame(second, "owner string, start_date date, end_date date, v string"), "owner", ["v"],
    )
    assert flat.columns == ["k", "owner", "start_date", "end_date", "v"]
    want = Counter()
    for k in keys:
        for n in range(-2, 70):
            if any(kk == k and s <= at(n) and (e is None or at(n) < e) for kk, s, e, _ in first):
                owner = valid(first, k, at(n))
                want[(k, at(n), owner, valid(second, owner, at(n)))] += 1
    assert by_day(flat, "k", ["owner", "v"]) == want


def test_links_of_many_versions_compare_little(spark):
    """One owner of 4,000 versions and 2,000 entities of a few days each: pairs met stay near the result."""
    history = spark.range(2_000).select("id", F.lit("o").alias("owner"), F.date_add(F.lit(BASE), (F.col("id") * 2).cast("int")).alias("start_date"))
    history = history.withColumn("end_date", F.date_add("start_date", 3))
    follow = spark.range(4_000).select(F.lit("o").alias("owner"), F.date_add(F.lit(BASE), F.col("id").cast("int")).alias("start_date"), F.col("id").alias("v"))
    follow = follow.withColumn("end_date", F.date_add("start_date", 1))
    flat = linked(history, "id", follow, "owner", ["v"])
    assert flat.count() == 6_000
    assert flat.filter("v is null").count() == 1  # the last entity's third day lies behind the last version
    # the pairs that agree in owner, block and role, before the exact comparison
    days = {f: f"{day_sql(c)} AS {f}" for f, c in (("_first", "start_date"), ("_last", "date_sub(end_date, 1)"))}
    met = 0
    for asks, gives in ((point_sql("_first"), cover_sql("_first", "_last")), (cover_sql("_first", "_last"), point_sql("_first"))):
        sides = [df.selectExpr(*days.values()).selectExpr(f"explode({x}) AS b").groupBy("b").count() for df, x in ((history, asks), (follow, gives))]
        met += sides[0].join(sides[1].withColumnRenamed("count", "n"), "b").agg(F.sum(F.col("count") * F.col("n"))).first()[0]
    assert met < 2.5 * 6_000


def test_a_chain_of_links_reads_each_history_once(spark, tmp_path):
    frames = []
    for i in range(4):
        path = f"{tmp_path}/h{i}"
        spark.createDataFrame([(i, BASE, FAR, i + 1)], f"k{i} int, start_date date, end_date date, k{i + 1} int").write.parquet(path)
        frames.append(spark.read.parquet(path))
    flat = frames[0]
    for i in range(1, 4):
        flat = linked(flat, "k0", frames[i], f"k{i}", [f"k{i + 1}"])
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4
    assert rows(flat, "k0", "k1", "k2", "k3", "k4") == {(0, 1, 2, 3, 4): 1}


def staff(spark):
    rng = random.Random(7)
    dates = "from_date date, to_date date"

    def shaped(table, order):
        return [tuple(order(k, s, e, v)) for k, s, e, v in table]

    keys, owners = list(range(10)), [1, 2, 3]
    assignments = spark.createDataFrame(shaped(versions(rng, keys, owners), lambda k, s, e, v: (k, v, s, e)), f"client int, owner int, {dates}")
    members = spark.createDataFrame(shaped(versions(rng, owners, [7, 8, 9], gaps=0.1), lambda k, s, e, v: (k, v, s, e)), f"owner int, member_key int, {dates}")
    employees = spark.createDataFrame(
        [(7, 70, 1, at(-800), at(20), at(40)), (8, 80, 2, at(5), at(5), None), (9, 90, 1, None, at(10), FAR), (6, 60, 1, at(0), None, None)],
        "member_key int, employee_key int, specialty int, first_start date, last_start date, left_on date",
    )
    managers = spark.createDataFrame(shaped(versions(rng, [70, 80, 90], [1, 2]), lambda k, s, e, v: (k, v, s, e)), f"employee_key int, manager_key int, {dates}")
    groups = spark.createDataFrame([(s, lo, hi, s * 10 + lo) for s in (1, 2) for lo, hi in ((0, 2), (2, 24), (24, None))], "specialty int, lo int, hi int, peer_group_key int")
    return assignments, members, employees, managers, groups


def cut_from(plan, made):
    """The lines of a plan's text from the deepest explode of ``made`` down to the table that feeds it."""
    lines = plan.splitlines()
    start = max(i for i, line in enumerate(lines) if "Generate explode" in line and made in line)
    for line in lines[start + 1:]:
        yield line
        if "Range (" in line or "Relation [" in line or "LogicalRDD" in line:
            return


def test_links_are_followed_once_for_an_owner_and_time(spark):
    """Entities that share owner and dates are cut alike: blocks are made of the distinct owners and dates, not of each entity."""
    _, members, employees, managers, _ = staff(spark)
    many = spark.range(300).select(F.col("id").alias("client"), (F.col("id") % 3 + 1).alias("owner"), F.lit(at(0)).alias("from_date"), F.lit(None).cast("date").alias("to_date"))
    history = person_history("client", many, members, employees, managers)
    below = list(cut_from(history._jdf.queryExecution().optimizedPlan().toString(), "_ask"))
    assert any("Aggregate [" in line and "owner" in line for line in below), below
    found = {}
    for r in history.collect():
        found.setdefault(r["client"], []).append(tuple(r)[1:])
    assert len(found) == 300 and all(sorted(v, key=str) == sorted(found[k % 3], key=str) for k, v in found.items())
    alone = person_history("client", many.filter("client < 3"), members, employees, managers)
    same(history.filter("client < 3"), alone)


def test_assignments_without_owner_end_or_days(spark):
    _, members, employees, managers, _ = staff(spark)
    odd = spark.createDataFrame(
        [(1, None, at(0), None), (2, None, at(0), None), (3, None, at(0), at(5)), (4, 1, at(5), at(5)), (5, 1, None, at(5)), (None, 1, at(0), at(5)), (None, None, at(0), None)],
        "client int, owner int, from_date date, to_date date",
    )
    history = person_history("client", odd, members, employees, managers)
    assert rows(history, "client", "owner", "from_date", "to_date", "member_key", "manager_key") == {
        (1, None, at(0), FAR, None, None): 1, (2, None, at(0), FAR, None, None): 1, (3, None, at(0), at(5), None, None): 1,
    }


def test_one_lookup_equals_the_chain_of_joins(spark):
    """At every date, with a lag: the flat history, the carry-forward over it and the chain of five lookups agree."""
    assignments, members, employees, managers, groups = staff(spark)
    fact = spark.createDataFrame([(k, at(n)) for k in [*range(11), None] for n in range(-1, 75)] + [(1, None)], "client int, day date")
    births = spark.createDataFrame([(k, D(1980 - k, 1, 1)) for k in range(8)], "client int, born date")
    bands = spark.createDataFrame([(1, 0, 42), (2, 42, 46)], "band_key int, lo int, hi int")
    history = person_history("client", assignments, members, employees, managers)
    people = People(history, groups, births, bands, 3)
    got = with_people(fact, "client", "day", people)
    assert got.columns == ["client", "day", *PEOPLE_KEYS]
    want = person_keys(fact, "day", "client", assignments, members, employees, managers, groups, lag_days=3)
    assert same(got.drop("age_band_key"), want) == fact.count()
    assert got.filter("employee_key <> -1").count() > 50
    ages = {r["client"]: r["age_band_key"] for r in got.filter(F.col("day") == F.lit(at(1))).collect()}
    assert ages[0] == 1 and ages[3] == 2 and ages[7] == -1 and ages[9] == -1
    # over a spine the segments are carried forward
    spine = fact.filter("client is not null and day is not null")
    seen = carry_forward(spine, "client", "day", [people_days(people, "client", "day", "_p")], ["_p"])
    there = F.col("_p._until") > F.col("day")
    carried = graded(seen.select("client", "day", *[F.when(there, F.col("_p")[c]).alias(c) for c in CHAIN]), "client", "day", people)
    same(carried, got.filter("client is not null and day is not null"))


def test_people_are_looked_up_without_blocks(spark):
    """A lookup reads each segment of the flat history once; it does not repeat it for the blocks of the calendar."""
    assignments, members, employees, managers, groups = staff(spark)
    history = spark.createDataFrame(person_history("client", assignments, members, employees, managers).collect(), "client int, owner int, member_key int, "
                                    "employee_key int, specialty int, began date, from_date date, to_date date, manager_key int")
    births, bands = spark.createDataFrame([], "client int, born date"), spark.createDataFrame([], "band_key int, lo int, hi int")
    # also a day on which the last open segment ends, and moments within a day
    fact = spark.createDataFrame([(k, d) for k in range(11) for d in (at(10), FAR)], "client int, day date")
    got = with_people(fact, "client", "day", People(history, groups, births, bands, 3))
    assert "_block" not in got._jdf.queryExecution().optimizedPlan().toString()
    same(got.drop("age_band_key"), person_keys(fact, "day", "client", assignments, members, employees, managers, groups, lag_days=3))
    moments = fact.withColumn("day", F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 9 HOURS")).filter(F.col("day") < F.lit("9000-01-01").cast("timestamp_ntz"))
    daily = got.filter(F.col("day") < F.lit("9000-01-01").cast("date"))
    same(with_people(moments, "client", "day", People(history, groups, births, bands, 3)).drop("day"), daily.drop("day"))


def test_no_people_at_all(spark):
    empty = [f.limit(0) for f in staff(spark)]
    births = spark.createDataFrame([], "client int, born date")
    bands = spark.createDataFrame([], "band_key int, lo int, hi int")
    people = People(person_history("client", *empty[:4]), empty[4], births, bands)
    fact = spark.createDataFrame([(1, at(1))], "client int, day date")
    assert rows(with_people(fact, "client", "day", people)) == {(1, at(1), -1, -1, -1, -1, None, -1): 1}
