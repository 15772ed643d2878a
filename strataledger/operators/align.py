"""Several histories cut into one flat history, so that a fact needs one lookup instead of one for each.

``aligned`` sweeps histories of one entity together; ``linked`` follows a link into another history whose key changes over time. Both read
each input once, in one branch, so a chain of links plans each history once. Validity is [start, end) in days; an end of NULL or the maximum is open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..defaults import MAX_DATE, max_date
from .ordered import neighbours, running
from .temporal import cover_sql, day_sql, point_sql


def _closed(history: DataFrame, start: str, end: str) -> DataFrame:
    """Versions of at least one day, open ends at the maximum."""
    return history.withColumn(end, F.coalesce(end, max_date())).filter(F.col(start) < F.col(end))


def aligned(
    histories: Mapping[str, tuple[DataFrame, Sequence[str]]], key: str, start: str = "start_date", end: str = "end_date",
) -> DataFrame:
    """(key, start, end, columns of all histories): the elementary segments between the starts and ends of an entity's versions.

    A segment has the columns of the version of each history that is valid throughout it, NULL where there is none; times without any version are left
    out. Each history has at most one version of an entity valid at a date; where two start on one day, the one with the larger columns counts.
    NULL keys and versions without a start or of no day are left out. An entity has one row for a day on which anything changes: groups bounded by
    the calendar, swept unsplit.
    """
    points = None
    for name, (history, cols) in histories.items():
        version = F.struct(*[F.col(c) for c in cols], F.col(end).alias("_until"))
        rows = _closed(history.filter(F.col(key).isNotNull()), start, end).select(key, start, end, version.alias("_v"))
        none = F.lit(None).cast(rows.schema["_v"].dataType)
        ends = F.explode(F.array(F.struct(F.col(start).alias("at"), F.col("_v").alias("v")), F.struct(F.col(end).alias("at"), none.alias("v"))))
        rows = rows.select(key, ends.alias("_p")).select(key, F.col("_p.at").alias(start), F.col("_p.v").alias(f"_v_{name}"))
        points = rows if points is None else points.unionByName(rows, allowMissingColumns=True)
    if points is None:
        raise ValueError("no histories")
    daily = points.groupBy(key, start).agg(*[F.max(f"_v_{n}").alias(f"_v_{n}") for n in histories])
    filled = running(daily, [key], [start], fills={f"_f_{n}": F.col(f"_v_{n}") for n in histories}, split=False)
    cut = neighbours(filled, [key], [start], after={end: F.col(start)}, split=False).filter(F.col(end).isNotNull())
    alive = {n: F.col(f"_f_{n}._until") > F.col(start) for n in histories}
    any_alive = F.lit(False)
    for a in alive.values():
        any_alive = any_alive | F.coalesce(a, F.lit(False))
    values = [F.when(alive[n], F.col(f"_f_{n}")[c]).alias(c) for n, (_, cols) in histories.items() for c in cols]
    return cut.filter(any_alive).select(key, start, end, *values)


def linked(
    history: DataFrame, key: str, following: DataFrame, on: str, cols: Sequence[str], start: str = "start_date", end: str = "end_date",
    follow_start: str = "start_date", follow_end: str = "end_date",
) -> DataFrame:
    """``history`` cut at the changes of the version of ``following`` that its column ``on`` leads to, with that version's ``cols``.

    Segments without one keep NULLs, so what is covered stays the same. ``following`` has the column ``on`` and at most one version of it valid at a
    date; where two are, the one that starts later takes over. Two intervals overlap where one starts inside the other: an equality on the blocks
    of the interval index, in which each overlapping pair meets once, so comparisons follow the result for links of any number of versions.
    The segments of one version are cut in one group, which holds the link's versions in that time.
    """
    k, s, e, to, fs, fe = (f"`{x}`" for x in (key, start, end, on, follow_start, follow_end))
    grid = [f"{day_sql('_s')} AS _first", f"{day_sql('date_sub(_e, 1)')} AS _last"]
    at, days = point_sql("_first"), cover_sql("_first", "_last")

    def tagged(*roles: tuple[str, int]) -> str:
        return ", ".join(f"transform({blocks}, b -> named_struct('block', b, 'role', {role}))" for blocks, role in roles)

    kept = [c for c in history.columns if c not in (start, end)]
    quoted = [f"`{c}`" for c in kept] + ["_s", "_e"]
    mine = history.selectExpr(*quoted[:-2], f"{s} AS _s", f"coalesce({e}, DATE '{MAX_DATE}') AS _e").filter(f"{k} IS NOT NULL AND _s < _e")
    alone = "array(named_struct('block', CAST(NULL AS INT), 'role', 2))"
    left = mine.selectExpr("*", *grid).selectExpr(*quoted, f"explode(concat({tagged((at, 0), (days, 1))}, {alone})) AS _ask")
    other = following.selectExpr(
        f"{to} AS _on", f"{fs} AS _s", f"coalesce({fe}, DATE '{MAX_DATE}') AS _e", f"struct({', '.join(f'`{c}`' for c in cols)}) AS _cols"
    ).filter("_s < _e")
    right = other.selectExpr("*", *grid).selectExpr("_on", "_s AS _fs", "_e AS _fe", "_cols", f"explode(concat({tagged((days, 0), (at, 1))})) AS _give")
    right = right.hint("merge")  # see valid_versions
    meet = f"{to} = _on AND _ask.block = _give.block AND _ask.role = _give.role AND IF(_ask.role = 0, _fs <= _s AND _s < _fe, _s < _fs AND _fs < _e)"
    met = left.join(right, F.expr(meet), "left").filter("_ask.role = 2 OR _on IS NOT NULL")
    # a version's own row comes first and opens the time before its first link
    met = met.selectExpr(*quoted, "_fs", "_cols", "greatest(_s, _fs) AS _from", "IF(_fs IS NULL, _s, least(_e, _fe)) AS _to")
    line = f"PARTITION BY {k}, _s, _e, {to} ORDER BY _fs NULLS FIRST"
    met = met.selectExpr(*quoted[:-2], "_cols", "_from", "_to", f"coalesce(lead(_from) OVER ({line}), _e) AS _next")
    both = "array(struct(_from AS s, least(_to, _next) AS e, _cols AS v), struct(least(_to, _next) AS s, _next AS e, NULL AS v))"
    cut = met.selectExpr(*quoted[:-2], f"explode({both}) AS _seg").filter("_seg.s < _seg.e")
    return cut.selectExpr(*quoted[:-2], f"_seg.s AS {s}", f"_seg.e AS {e}", *[f"_seg.v.`{c}` AS `{c}`" for c in cols])
