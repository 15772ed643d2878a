"""Ordinals by sampled ranges: right numbers for any order, and no task above twice the mean."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataledger.operators.ordinals import ordinals
from strataledger.sources.lake import write_table


@pytest.fixture
def stage(tmp_path):
    tables = []

    def put(df):
        tables.append(write_table(df, f"{tmp_path}/t{len(tables)}"))
        return tables[-1]

    put.tables = tables
    return put


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "name"]])
@pytest.mark.parametrize("order", [["at"], ["name", "at"], ["x", "name"]])
def test_numbers_are_those_of_one_window(spark, stage, keys, order):
    rng = random.Random(5)
    data = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, "CUSTOMER#1", "CUSTOMER#2", ""]), rng.choice([None, float("nan"), 1.5, -2.0]), rng.randrange(50), i)
            for i in range(3_000)]
    df = spark.createDataFrame(data, "k int, name string, x double, at int, id long").repartition(7)
    out = ordinals(df, keys, order, stage, "seq", "n")
    assert out.columns == [*df.columns, "seq", "n"]
    groups = defaultdict(list)
    for r in out.collect():
        groups[tuple(r[k] for k in keys)].append(r)

    def rank(v):
        return (0, 0) if v is None else (2, 0) if v != v else (1, v)

    for own in groups.values():
        own.sort(key=lambda r: r["seq"])
        assert [r["seq"] for r in own] == list(range(1, len(own) + 1)) and {r["n"] for r in own} == {len(own)}
        ranks = [tuple(rank(r[o]) for o in order) for r in own]
        assert ranks == sorted(ranks)
    assert sum(map(len, groups.values())) == len(data)


def test_empty(spark, stage):
    assert ordinals(spark.range(0), [], ["id"], stage).collect() == []


@pytest.mark.parametrize("order", ["concat('Customer#', lpad(id, 9, '0'))", "'one name'", "id", "timestamp'2020-01-01 00:00:00'"])
def test_no_range_holds_twice_the_mean(spark, stage, order):
    """Names with one prefix, one name for all, dense numbers, one burst moment."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(0, 200_000, 1, 8).select("id", F.expr(order).alias("o"))
        out = ordinals(df, [], ["o"], stage)
        assert out.agg(F.max("seq"), F.countDistinct("seq")).first() == (200_000, 200_000)
        held = [r["count"] for r in stage.tables[0].groupBy(F.shiftright("_place", 33)).count().collect()]
        assert len(held) == 16 and max(held) < 2 * 200_000 / 16
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
