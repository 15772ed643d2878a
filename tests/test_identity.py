"""Chains, cycles and hubs of id links against a plain union of sets."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from strataledger.operators.history import close_with_next
from strataledger.operators.identity import repoint, resolve_ids
from strataledger.sources.lake import write_table


@pytest.fixture
def stage(tmp_path):
    count = iter(range(1_000))
    return lambda df: write_table(df, f"{tmp_path}/t{next(count)}")


def united(links):
    of = {}
    for a, b in links:
        if a is None or b is None or a == b:
            continue
        whole = of.get(a, {a}) | of.get(b, {b})
        for x in whole:
            of[x] = whole
    return {(x, min(s)): 1 for x, s in of.items()}


def shuffled(n, seed):
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    return ids


CASES = {
    "chain down": [(i, i + 1) for i in range(60)],
    "shuffled chain and a cycle": [*zip(shuffled(80, 1), shuffled(80, 1)[1:], strict=False), (100, 101), (101, 102), (102, 100)],
    "hub with the largest id": [(10_000, i) for i in range(2_000)],
    "random": [(random.Random(i).randrange(300), random.Random(-i).randrange(300)) for i in range(150)] + [(None, 1), (2, None), (3, 3)],
    "none": [(None, 1), (5, 5)],
}


@pytest.mark.parametrize("name", CASES)
def test_masters(spark, stage, name):
    links = spark.createDataFrame(CASES[name], "a int, b int").repartition(3)
    assert rows(resolve_ids(links, "a", "b", stage), "id", "master") == united(CASES[name])


def test_versions_of_merged_entities_do_not_overlap(spark, stage):
    names = resolve_ids(spark.createDataFrame([(3, 2), (2, 1)], "a int, b int"), "a", "b", stage)
    dim = spark.createDataFrame([(1, "2024-01-01", "x"), (2, "2024-03-01", "y"), (3, "2024-02-01", "z"), (9, "2024-01-05", "w")], "id int, d string, v string")
    dim = dim.withColumn("start_date", F.to_date("d")).drop("d")
    out = close_with_next(repoint(dim, names, "id"), ["id"], ["start_date", "v"]).select("id", "v", F.col("end_date").cast("string").alias("e"), "current_record")
    assert rows(out) == {(1, "x", "2024-02-01", 0): 1, (1, "z", "2024-03-01", 0): 1, (1, "y", "9999-12-31", 1): 1, (9, "w", "9999-12-31", 1): 1}
