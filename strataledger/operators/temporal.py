"""Joins to the version that was valid at a date, through an interval index.

The calendar is cut into blocks of 1, 16, 256, 4,096 and 65,536 days. A validity interval is covered by the few largest blocks that lie within it, none of them
twice; a date lies in one block of each size. So a version is valid at a date only if exactly one of the date's five blocks is one of the
version's, and the join is an equality on (key, block): what it compares follows what it finds, however many versions a key has and however
they overlap. ``temporal_join`` probes with distinct (key, date) pairs only, so an entity with a third of all rows asks once a day; narrow or
derived rows probe by themselves (``valid_versions``), which reads them once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..defaults import max_date


def valid_at(at: Column, start: Column, end: Column, closed: str = "left") -> Column:
    """[start, end) by default, [start, end] with ``closed='both'``; an open end is NULL or the maximum."""
    upper = F.coalesce(end, max_date())
    return (start <= at) & ((at <= upper) if closed == "both" else (at < upper))


GRID_BITS = 4
GRID = 1 << GRID_BITS  # a block holds so many of the next smaller size
LEVELS = 5
FIRST_DAY = 25_567  # 1900-01-01 in days before 1970; days outside the grid count as its first or last
DAYS = GRID ** (LEVELS - 1)
LEVEL_BITS = 20


def _day(at: Column) -> Column:
    return F.least(F.greatest(F.unix_date(at.cast("date")) + FIRST_DAY, F.lit(0)), F.lit(DAYS - 1))


def blocks_of(at: Column) -> Column:
    """The blocks that a date lies in, one of each size."""
    day = _day(at)
    return F.array(*[F.shiftright(day, GRID_BITS * i) + (i << LEVEL_BITS) for i in range(LEVELS)])


def with_blocks(spans: DataFrame, start: Column, end: Column, out: str = "_block") -> DataFrame:
    """One row for each of the blocks, without overlap, that cover the days from ``start`` to ``end``, both included; none if there are no such days."""
    seen = spans.withColumns({"_first": _day(start), "_last": _day(end)}).filter("_first <= _last")
    seen = seen.withColumn("_level", F.explode(F.array(*[F.lit(i) for i in range(LEVELS)])))
    # the first and last whole block of the size, and of the next larger one
    bits = GRID_BITS
    whole = seen.selectExpr(
        "*", f"(_first + shiftleft(1, {bits} * _level) - 1) >> ({bits} * _level) AS _low", f"((_last + 1) >> ({bits} * _level)) - 1 AS _high",
        f"(_first + shiftleft(1, {bits} * _level + {bits}) - 1) >> ({bits} * _level + {bits}) AS _low2", f"((_last + 1) >> ({bits} * _level + {bits})) - 1 AS _high2",
    ).filter("_low <= _high")
    # where larger blocks lie within the interval, only what is left and right of them
    wider = f"(_level < {LEVELS - 1} AND _low2 <= _high2)"
    left = f"CASE WHEN {wider} THEN IF(_low < _low2 * {GRID}, sequence(_low, _low2 * {GRID} - 1), array()) ELSE sequence(_low, _high) END"
    right = f"CASE WHEN {wider} AND (_high2 + 1) * {GRID} <= _high THEN sequence((_high2 + 1) * {GRID}, _high) ELSE array() END"
    cut = whole.withColumn("_n", F.explode(F.expr(f"concat({left}, {right})")))
    return cut.withColumn(out, F.expr(f"_n + shiftleft(_level, {LEVEL_BITS})")).drop("_first", "_last", "_level", "_low", "_high", "_low2", "_high2", "_n")


def day_sql(at: str) -> str:
    """``_day`` as a SQL expression."""
    return f"least(greatest(unix_date(CAST({at} AS DATE)) + {FIRST_DAY}, 0), {DAYS - 1})"


def point_sql(day: str) -> str:
    """``blocks_of`` as a SQL expression of a grid day."""
    return f"transform(sequence(0, {LEVELS - 1}), lv -> shiftright({day}, {GRID_BITS} * lv) + shiftleft(lv, {LEVEL_BITS}))"


def cover_sql(first: str, last: str) -> str:
    """The blocks of ``with_blocks`` as one array, as a SQL expression of two grid days, both included; empty if there are no such days."""
    bits = GRID_BITS
    own, up = f"{bits} * lv", f"{bits} * lv + {bits}"
    ends = ", ".join(
        f"shiftright({first} + shiftleft(1, {size}) - 1, {size}) AS low{n}, shiftright({last} + 1, {size}) - 1 AS high{n}" for n, size in (("", own), ("2", up))
    )
    left = f"IF(w.low < w.low2 * {GRID}, sequence(w.low, w.low2 * {GRID} - 1), array())"
    right = f"IF((w.high2 + 1) * {GRID} <= w.high, sequence((w.high2 + 1) * {GRID}, w.high), array())"
    whole = f"CASE WHEN {first} > {last} OR w.low > w.high THEN array() WHEN lv < {LEVELS - 1} AND w.low2 <= w.high2 THEN concat({left}, {right}) ELSE sequence(w.low, w.high) END"
    raised = f"transform({whole}, n -> n + shiftleft(lv, {LEVEL_BITS}))"
    return f"flatten(flatten(transform(sequence(0, {LEVELS - 1}), lv -> transform(array(struct({ends})), w -> {raised}))))"


def valid_versions(
    asked: DataFrame,
    hist: DataFrame,
    on: Sequence[str],
    at: str,
    start: str = "start_date",
    end: str = "end_date",
    closed: str = "left",
    how: str = "inner",
) -> DataFrame:
    """Each row of ``asked`` with every version of its key valid at ``at``; with ``how='left'`` rows without one stay, once, with NULLs.

    For narrow rows: every row is repeated for its blocks. Versions may overlap; those without a start or with an end before it are never
    valid, an end of NULL is open, NULL keys and dates meet nothing. ``asked`` is read once, so links can be chained; its rows need not be distinct.
    """
    until = F.coalesce(F.col(end), max_date().cast(hist.schema[end].dataType))
    right = with_blocks(hist, F.col(start), until).withColumn("_hit", F.lit(1))
    right = right.withColumnsRenamed({k: f"_h_{k}" for k in on} | {"_block": "_h_block"})
    right = right.hint("merge")  # many rows for a version: statistics take it for as small as the history and would send it through the driver
    # rows without a date or a key meet nothing, so they have no blocks to ask in
    asks = F.col(at).isNotNull()
    for k in on:
        asks = asks & F.col(k).isNotNull()
    blocks = F.when(asks, blocks_of(F.col(at))).otherwise(F.array().cast("array<int>"))
    # a probe that can meet nothing keeps the row itself; its block, below zero, spreads the rows of a key over their days
    own = F.array(-1 - F.coalesce(_day(F.col(at)), F.lit(0)))
    probes = blocks if how == "inner" else F.concat(own, blocks)
    left = asked.withColumn("_block", F.explode(probes))
    cond = valid_at(F.col(at), F.col(start), F.col(end), closed) & (F.col("_block") == F.col("_h_block"))
    for k in on:
        cond = cond & (F.col(k) == F.col(f"_h_{k}"))
    met = left.join(right, cond, "inner" if how == "inner" else "left").drop("_h_block", *[f"_h_{k}" for k in on])
    if how != "inner":
        met = met.filter("_hit is not null or _block < 0")
        found = F.max("_hit").over(Window.partitionBy(*on, at))
        met = met.withColumn("_found", found).filter("_hit is not null or _found is null").drop("_found")
    return met.drop("_block", "_hit")


def looked_up(fact: DataFrame, by: Sequence[str], steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``fact`` with the columns that a chain of lookups adds to its distinct values of ``by``.

    The chain runs over these alone and one join brings its result back, whatever the number of links; NULLs are values like others.
    Every step keeps all its rows, once unless versions overlap, and the columns ``by``.
    """
    found = chain(fact.select(*by).distinct(), steps)
    found = found.withColumnsRenamed({k: f"_by_{k}" for k in by}).hint("merge")  # a fact's compressed columns look small enough to broadcast
    cond = F.lit(True)
    for k in by:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_by_{k}"))
    return fact.join(found, cond).drop(*[f"_by_{k}" for k in by])


def temporal_join(
    fact: DataFrame,
    hist: DataFrame,
    on: Sequence[str],
    at: str,
    start: str = "start_date",
    end: str = "end_date",
    closed: str = "left",
    how: str = "inner",
    shift_days: int = 0,
) -> DataFrame:
    """Each fact row meets the version(s) of its key valid at ``at`` minus ``shift_days``.

    The distinct (key, moment) pairs probe the index; the fact then joins what they found on key and moment, which also spreads a hot key over
    its days. ``hist`` columns other than ``on`` must not clash with the fact's. The fact is read twice: for a chain use ``looked_up``.
    """
    moment = F.col(at) if not shift_days else F.date_sub(F.col(at), shift_days)
    left = fact.withColumn("_at", moment)
    asked = left.select(*on, "_at").distinct()
    found = valid_versions(asked, hist, on, "_at", start, end, closed)
    found = found.withColumnsRenamed({k: f"_h_{k}" for k in [*on, "_at"]})
    cond = F.col("_at") == F.col("_h__at")
    for k in on:
        cond = cond & (F.col(k) == F.col(f"_h_{k}"))
    return left.join(found, cond, how).drop("_at", "_h__at", *[f"_h_{k}" for k in on])


def chain(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Lookups applied one after the other, each at the row's own date."""
    for step in steps:
        df = df.transform(step)
    return df


def eligible_at(
    refs: DataFrame,
    people: DataFrame,
    on: str,
    at: str,
    first_start: str,
    last_start: str,
    left_on: str,
    how: str = "inner",
) -> DataFrame:
    """People employed at the date: a returner counts from the first start before the last one."""
    side = people.withColumnRenamed(on, "_eligible_on")
    began = F.when(F.col(at) < F.col(last_start), F.col(first_start)).otherwise(F.col(last_start))
    cond = (
        (F.col(on) == F.col("_eligible_on"))
        & (began <= F.col(at))
        & (F.coalesce(F.col(left_on), max_date()) >= F.col(at))
    )
    return refs.join(side, cond, how).drop("_eligible_on")


def overlap_capped(
    a: DataFrame,
    b: DataFrame,
    on: str,
    a_span: tuple[str, str],
    b_span: tuple[str, str],
    out: tuple[str, str],
) -> DataFrame:
    """Intervals of ``b`` that start inside an interval of ``a``; the end is the smaller end."""
    met = valid_versions(b, a, [on], b_span[0], a_span[0], a_span[1], closed="both")
    return met.withColumns({out[0]: F.col(b_span[0]), out[1]: F.least(F.col(a_span[1]), F.col(b_span[1]))})
