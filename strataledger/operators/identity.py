"""Identity over chains of ids: every id gets the smallest one it is linked to, directly or through others.

Each round points every id at the smallest of itself and its neighbours, follows these pointers to their ends by doubling (they only go down, so they
form trees whatever the cycles in the links), and contracts the links to the ends reached. A hub's links meet its one pointer in a join, never in
a list. Links, pointers and names are written between rounds; what the driver sees is whether any are left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_ids(links: DataFrame, a: str, b: str, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, master) of every id that has a link to another one; links with a NULL say nothing.

    ``stage`` writes a table where driver and executors see it and reads it back.
    """

    def simple(rows: DataFrame) -> DataFrame:
        return rows.filter("_a <> _b").select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")).distinct()

    edges = stage(simple(links.select(F.col(a).alias("_a"), F.col(b).alias("_b"))))
    names = edges.select(F.col("_a").alias("id"), F.col("_a").alias("master")).limit(0)
    first = True
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        to = stage(both.groupBy(F.col("_a").alias("_x")).agg(F.min("_b").alias("_m")).select("_x", F.least("_x", "_m").alias("_m")))
        while True:
            onward = to.select(F.col("_x").alias("_m"), F.col("_m").alias("_n"))
            longer = stage(to.join(onward, "_m").select("_x", F.col("_n").alias("_m"), (F.col("_n") < F.col("_m")).alias("_moved")))
            to = longer.drop("_moved")
            if longer.filter("_moved").isEmpty():
                break
        if first:
            names = to.select(F.col("_x").alias("id"), F.col("_m").alias("master"))
        else:
            renamed = names.join(to, F.col("master") == F.col("_x"), "left")
            names = stage(renamed.select("id", F.coalesce("_m", "master").alias("master")))
        first = False
        left = edges.join(to.toDF("_a", "_to_a"), "_a").join(to.toDF("_b", "_to_b"), "_b")
        edges = stage(simple(left.select(F.col("_to_a").alias("_a"), F.col("_to_b").alias("_b"))))
    return names


def repoint(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Rows, facts or versions, under the master of their id; ids without a link stay."""
    side = names.select(F.col("id").alias("_id"), F.col("master").alias("_master"))
    met = rows.join(side, F.col(key) == F.col("_id"), "left")
    return met.withColumn(key, F.coalesce("_master", key)).select(*rows.columns)
