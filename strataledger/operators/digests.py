"""Reconciliation of two tables by order-free digests of key ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16
STEP = 8


def _hash(seed: int, cols: Sequence[str]) -> Column:
    """A hash of values and of which of them are NULL."""
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def _leaf(keys: Sequence[str], bits: int) -> Column:
    return _hash(3, keys).bitwiseAND((1 << bits) - 1)


def leaf_digests(df: DataFrame, keys: Sequence[str], cols: Sequence[str], bits: int = BITS) -> DataFrame:
    """(leaf, n, x, s) of every key range that has rows: how many, and two order-free digests of their keys and values.

    A range is one of 2^bits of the hashed key. Rows are combined before the shuffle, so at most 2^bits rows leave a task. To be stored with a table,
    so that a later comparison need not read it. Equal values must be of one type on both sides.
    """
    every = [*keys, *cols]
    rows = df.select(_leaf(keys, bits).alias("leaf"), _hash(1, every).alias("x"), _hash(2, every).bitwiseAND(0xFFFFFFFF).alias("s"))
    return rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))


def differing_leaves(a: DataFrame, b: DataFrame, bits: int = BITS) -> DataFrame:
    """(leaf) of the key ranges whose digests differ, found from the top: ranges of 2^8, then 2^16 ... parts, each level only under differing parents."""
    sides = a.select("*", F.lit(1).alias("_m")).unionByName(b.select("*", F.lit(-1).alias("_m")))
    open_ = None
    for level in [*range(STEP, bits, STEP), bits]:
        node = F.shiftright("leaf", bits - level)
        here = sides if open_ is None else sides.join(open_, F.shiftright("leaf", bits - open_level) == F.col("node"), "left_semi")
        total = here.groupBy(node.alias("node")).agg(
            F.sum(F.col("n") * F.col("_m")).alias("n"), F.bit_xor("x").alias("x"), F.sum(F.col("s").cast("decimal(38,0)") * F.col("_m")).alias("s")
        )
        open_, open_level = total.filter("n <> 0 OR x <> 0 OR s <> 0").select("node"), level
    return open_.select(F.col("node").alias("leaf"))


def differences(
    a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str], bits: int = BITS,
    digests: tuple[DataFrame | None, DataFrame | None] = (None, None),
) -> DataFrame:
    """Keys that are not the same in both tables: (keys, kind, count_a, count_b); kind is 'only_a', 'only_b' or 'changed'.

    NULL keys and values equal each other; a key with several rows is the same if the rows are, in any order ('changed' also where the numbers differ). Only rows
    under key ranges that differ are shuffled, none for equal tables; the list of these ranges, at most 2^bits numbers, goes to all tasks. ``digests`` are stored
    ``leaf_digests`` of the two tables, made with the same arguments.
    """
    leaves = [leaf_digests(df, keys, cols, bits) if got is None else got for df, got in zip((a, b), digests)]
    wanted = F.broadcast(differing_leaves(*leaves, bits))  # 65,536 numbers by default
    every = [*keys, *cols]

    def suspects(df: DataFrame, side: int) -> DataFrame:
        rows = df.select(*keys, _leaf(keys, bits).alias("leaf"), _hash(1, every).alias("_x"), _hash(2, every).bitwiseAND(0xFFFFFFFF).alias("_s"), F.lit(side).alias("_m"))
        return rows.join(wanted, "leaf", "left_semi").drop("leaf")

    both = suspects(a, 1).unionByName(suspects(b, -1))
    met = both.groupBy(*keys).agg(
        F.count_if(F.col("_m") == 1).alias("count_a"), F.count_if(F.col("_m") == -1).alias("count_b"), F.bit_xor("_x").alias("_x"),
        F.sum(F.col("_s") * F.col("_m")).alias("_s"),
    ).filter("count_a <> count_b OR _x <> 0 OR _s <> 0")
    kind = F.when(F.col("count_b") == 0, "only_a").when(F.col("count_a") == 0, "only_b").otherwise("changed")
    return met.select(*keys, kind.alias("kind"), "count_a", "count_b")
