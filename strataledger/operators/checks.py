"""Data-quality and reconciliation checks; each returns the violations (no rows = pass)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hotkeys import DEFAULT_SPLIT, Split
from .joins import key_set
from .ordered import neighbours


def grain(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def dup_current(hist: DataFrame, key: str, current: str = "current_record") -> DataFrame:
    return grain(hist.filter(F.col(current) == 1), [key])


def gaps_overlaps(
    hist: DataFrame, key: str, start: str = "start_date", end: str = "end_date",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Versions that do not end where the next one starts."""
    led = neighbours(hist, [key], [start, end], after={"next_start": F.col(start)}, split=split)
    return led.filter(F.col(end) != F.col("next_start"))


def repeated_hash(
    hist: DataFrame, key: str, order: Sequence[str], hash_col: str = "row_hash",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Versions equal to the next one."""
    led = neighbours(hist, [key], order, after={"_next_hash": F.col(hash_col)}, split=split)
    return led.filter(F.col(hash_col) == F.col("_next_hash")).drop("_next_hash")


def one_row(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(o) for o, c in measures.items()])


def tagged_counts(frames: Mapping[str, DataFrame], measures: Mapping[str, Column], tag: str = "source") -> DataFrame:
    """The same totals per table, one row each."""
    rows = [one_row(df, measures).select(F.lit(name).alias(tag), "*") for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def compare_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both row counts and whether they agree (scalar subqueries, nothing is joined)."""
    n_a = a.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = b.agg(F.count(F.lit(1)).alias("count_b"))
    return counted.select(
        n_a.alias("count_a"), "count_b", (n_a == F.col("count_b")).cast("int").alias("equal")
    )


def missing_rows(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found on one side only, tagged with the side they are found on."""
    left = a.select(*keys).join(key_set(b, keys), [*keys], "left_anti").withColumn("found_in", F.lit("a"))
    right = b.select(*keys).join(key_set(a, keys), [*keys], "left_anti").withColumn("found_in", F.lit("b"))
    return left.unionByName(right)


def mismatch_counts(
    a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Number of disagreeing values per column over the matching keys.

    The plain form compares with ``<>``, which cannot see NULL against a value; ``null_safe`` can.
    """
    right = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols])
    joined = a.select(*keys, *cols).join(right, [*keys])

    def differs(c: str) -> Column:
        x, y = F.col(c), F.col(f"_b_{c}")
        return ~x.eqNullSafe(y) if null_safe else F.coalesce(x != y, F.lit(False))

    return joined.agg(
        *[F.coalesce(F.sum(differs(c).cast("int")), F.lit(0)).cast("long").alias(f"{c}_mismatch") for c in cols]
    )


def count_delta(before: DataFrame, after: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """How far each measure moved."""
    was = before.agg(F.struct(*[c.alias(o) for o, c in measures.items()]).alias("m")).scalar()
    now = after.agg(*[c.alias(o) for o, c in measures.items()])
    return now.select(*[(F.col(o) - was.getField(o)).alias(f"{o}_delta") for o in measures])


def rerun_delta(load: Callable[[DataFrame, DataFrame], DataFrame], tgt: DataFrame, src: DataFrame,
                keys: Sequence[str], cols: Sequence[str],
                stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Rows added and values changed by running a load a second time on its own result.

    ``stage`` may write the first result to a table, as a load would.
    """
    once = stage(load(tgt, src))
    twice = load(once, src)
    n_once = once.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_twice = twice.agg(F.count(F.lit(1)).alias("n")).scalar()
    moved = mismatch_counts(once, twice, keys, cols, null_safe=True)
    return moved.select((n_twice - n_once).alias("rows_added"), *moved.columns)


def milestone_disorder(df: DataFrame, by: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    """Groups in which a later milestone happened more often than the first one."""
    names = list(counts)
    totals = df.groupBy(*by).agg(*[c.alias(o) for o, c in counts.items()])
    late = reduce(lambda a, b: a | b, [F.col(n) > F.col(names[0]) for n in names[1:]])
    return totals.filter(late)


def orphan_counts(facts: Mapping[str, tuple[DataFrame, str]], bad: DataFrame, key: str) -> DataFrame:
    """Per fact, the rows that use one of the bad dimension keys."""
    parts = []
    for name, (fact, column) in facts.items():
        hit = fact.select(F.col(column).alias(key)).join(key_set(bad, [key]), key, "left_semi")
        parts.append(hit.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("fact"), "n_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_run_audit(df: DataFrame, run_id: str, now: str) -> DataFrame:
    """Audit columns of a load; run id and time are arguments."""
    stamp = F.lit(now).cast("timestamp_ntz")
    return df.withColumns({"run_id": F.lit(run_id), "created_at": stamp, "updated_at": stamp})


def task_log(df: DataFrame, source: str, target: str, run_id: str) -> DataFrame:
    """One row per load: source, target, row count, status."""
    n = F.count(F.lit(1))
    status = F.when(n > 0, "Succeeded").otherwise("Empty")
    return df.agg(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), F.lit(target).alias("target"),
        n.alias("n_rows"), status.alias("status"),
    )


def before_after(before: DataFrame, after: DataFrame, cond: Column) -> DataFrame:
    """The same entities before and after a load."""
    return before.withColumn("state", F.lit("before")).unionByName(
        after.withColumn("state", F.lit("after"))
    ).filter(cond)
