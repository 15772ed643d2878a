"""Key lookups, existence tests and id matching.

No join here carries a broadcast hint or counts a side: Spark
broadcasts small sides by their statistics and splits skewed sort-merge partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY
from ..functions.numbers import money
from .ordered import first_per_key


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys for the right side of a semi or anti join.

    Copies of a hot key are combined before the shuffle, and the join reuses the partitioning.
    """
    return df.select(*keys).distinct()


def lookup_key(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], key: str, out: str, unknown: int = UNKNOWN_KEY
) -> DataFrame:
    """Fact column(s) -> dimension column(s), the dimension's key or the unknown member."""
    side = dim.select(
        *[F.col(d).alias(f"_on{i}") for i, d in enumerate(on.values())], F.col(key).alias("_key")
    )
    cond = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"_on{i}") for i, f in enumerate(on)])
    found = F.coalesce(F.col("_key"), F.lit(unknown).cast(dim.schema[key].dataType))
    return fact.join(side, cond, "left").select(*fact.columns, found.alias(out))


def missing(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose keys the target does not have (NULL keys are never found)."""
    return src.join(key_set(tgt, keys), [*keys], "left_anti")


def not_exists(src: DataFrame, other: DataFrame, on: Mapping[str, str], cond: Column | None = None) -> DataFrame:
    """Rows without a partner; ``cond`` restricts the partners."""
    partners = other if cond is None else other.filter(cond)
    names = [f"_on{i}" for i in range(len(on))]
    side = key_set(partners.select(*[F.col(o).alias(n) for o, n in zip(on.values(), names)]), names)
    match = reduce(lambda a, b: a & b, [F.col(s) == F.col(f"_on{i}") for i, s in enumerate(on)])
    return src.join(side, match, "left_anti")


def reduce_to_keys(big: DataFrame, key: str, *key_frames: DataFrame) -> DataFrame:
    """Shrink a big table to the keys in play before it is joined again and again."""
    wanted = reduce(lambda a, b: a.unionByName(b), [k.select(key) for k in key_frames])
    return big.join(key_set(wanted, [key]), key, "left_semi")


def lookup_by_labels(
    df: DataFrame, dim: DataFrame, labels: Mapping[str, Column], key: str, unknown: int = UNKNOWN_KEY
) -> DataFrame:
    """Key of a combination dimension from several computed labels."""
    named = {f"_l{i}": e for i, e in enumerate(labels.values())}
    on = dict(zip(named, labels))
    return lookup_key(df.withColumns(named), dim, on, key, key, unknown).drop(*named)


def decode_labels(
    df: DataFrame,
    code_map: DataFrame,
    attributes: Mapping[str, tuple[str, str]],
    unknown: str | None = None,
) -> DataFrame:
    """Decode coded columns through one (attribute_name, attribute_value, value) map.

    ``attributes`` maps an attribute name to (code column, label column).
    """
    out = df
    for name, (code, label) in attributes.items():
        side = code_map.filter(F.col("attribute_name") == name).select(
            F.col("attribute_value").alias("_code"), F.col("value").alias("_label")
        )
        text = F.col("_label") if unknown is None else F.coalesce("_label", F.lit(unknown))
        out = out.join(side, F.col(code) == F.col("_code"), "left").withColumn(label, text).drop("_code", "_label")
    return out


def match_either(
    a: DataFrame, b: DataFrame, a_id: str, ways: Sequence[tuple[Column, Column]], b_id: str
) -> DataFrame:
    """(a_id, b_id, way): a partner found in any of several ways, the earliest way winning.

    Each way is its own equality join; an OR of them would be a nested loop.
    """
    hits = []
    for n, (left, right) in enumerate(ways, 1):
        la = a.select(F.col(a_id), left.alias("_k"))
        lb = b.select(F.col(b_id), right.alias("_k"))
        hits.append(la.join(lb, "_k").select(a_id, b_id, F.lit(n).alias("way")))
    union = reduce(lambda x, y: x.unionByName(y), hits)
    return first_per_key(union, [a_id], ["way", b_id])


def crosswalk(
    a: DataFrame, b: DataFrame, key: str, a_id: str, b_id: str, a_preferred: str, b_preferred: str,
) -> DataFrame:
    """(a_id, b_id) pairs sharing a key; an id that maps more than once keeps its rows only where it is its key's first preferred id.

    How often an id maps follows from the row counts per key, so rows that will not stay are removed from each side before any pair is
    made. Of several preferred ids on one key and side the smallest stays, so a key makes no more pairs than it has rows on one side.
    """

    def once_or_preferred(side: DataFrame, id_: str, flag: str, other: DataFrame) -> DataFrame:
        partners = other.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        first = side.groupBy(key).agg(F.min(F.when(F.col(flag) == 1, F.col(id_))).alias("_first"))
        met = side.select(key, id_, flag).join(partners, key).join(first, key)
        totals = met.groupBy(id_).agg(F.sum("_n").alias("_total"))
        stays = (F.col("_total") == 1) | F.coalesce((F.col(flag) == 1) & (F.col(id_) == F.col("_first")), F.lit(False))
        return met.join(totals, id_).filter(stays).select(key, id_)

    left = once_or_preferred(a, a_id, a_preferred, b)
    right = once_or_preferred(b, b_id, b_preferred, left)
    return left.join(right, key).select(a_id, b_id)


def join_on_exprs(
    a: DataFrame, b: DataFrame, on: Sequence[tuple[Column, Column]], how: str = "inner"
) -> DataFrame:
    """Equality join on expressions, computed first so that they are plain shuffle keys."""
    left = a.withColumns({f"_e{i}": x for i, (x, _) in enumerate(on)})
    right = b.withColumns({f"_f{i}": y for i, (_, y) in enumerate(on)})
    cond = reduce(lambda x, y: x & y, [F.col(f"_e{i}") == F.col(f"_f{i}") for i in range(len(on))])
    return left.join(right, cond, how).drop(*[f"_e{i}" for i in range(len(on))], *[f"_f{i}" for i in range(len(on))])


def fx_convert(
    df: DataFrame, rates: DataFrame, on: Sequence[str], amount: str, rate: str, own_rate: Column, out: str
) -> DataFrame:
    """Divide by the dated rate, else by the row's own rate, at money scale."""
    side = rates.select(*on, F.col(rate).cast("decimal(19,13)").alias("_rate"))
    used = F.coalesce("_rate", own_rate.cast("decimal(19,13)"))
    joined = df.join(side, [*on], "left")
    return joined.select(*df.columns, (money(F.col(amount)) / used).cast("decimal(18,2)").alias(out))
