"""Ordered (window) operators that survive a hot key.

``split=False`` means one plain window per key. Use it where the rows of a key are bounded by
the calendar, as after ``latest_per_day`` or on a daily spine. Otherwise every key is cut into pieces along its order (``hotkeys``): the
window runs within (key, piece), and what pieces tell each other is one or two rows of each, which meet per key. There is no look at the
data, no job before the query's own and no switch by size. Every step is one branch: rows that speak for their piece share a group of a second
window with those of the key's other pieces, while all others stay in a group of their own piece. So a plan grows by the step, not by the
power of steps, and reads its input once, for one more exchange in ``neighbours`` and two in ``running``.

Orders are ascending with NULL first and must be total for reproducible results. Rows of one key in one piece stay in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hotkeys import DEFAULT_SPLIT, PIECE, Split, piece

CELL = "_cell"
MEET = "_meet"  # the cell for rows that stay within their piece, NULL for those that speak for it


def _cells(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with their piece and the cell (key, piece): a struct, so that NULL keys are equal to each other."""
    cut = rows.withColumn(PIECE, piece(rows, order))
    return cut.withColumn(CELL, F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(PIECE).alias("p")))


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: Mapping[str, Column] | None = None,
    after: Mapping[str, Column] | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Columns of the row before / after within the key; NULL at the ends.

    ``before`` and ``after`` map an output name to an expression over the neighbouring row.
    """
    before, after = before or {}, after or {}
    given = [f"_n{i}" for i in range(len(before) + len(after))]
    named = dict(zip(given, [*before.values(), *after.values()]))
    rows = df.withColumns(named) if named else df
    prev = dict(zip(before, given))
    nxt = dict(zip(after, given[len(before):]))

    def seen(w) -> dict[str, Column]:
        return {**{o: F.lag(c).over(w) for o, c in prev.items()}, **{o: F.lead(c).over(w) for o, c in nxt.items()}}

    if not split:
        return rows.withColumns(seen(Window.partitionBy(*keys).orderBy(*order))).drop(*given)

    inside = Window.partitionBy(CELL).orderBy(*order)
    one = F.lit(1)
    made = _cells(rows, keys, order).withColumns(
        {**seen(inside), "_has_prev": F.lag(one).over(inside), "_has_next": F.lead(one).over(inside)}
    )
    # the first and last row of each piece; next to each other in the key, they are neighbours
    within = F.col("_has_prev").isNotNull() & F.col("_has_next").isNotNull()
    made = made.withColumn(MEET, F.when(within, F.col(CELL)))
    across = seen(Window.partitionBy(*keys, MEET).orderBy(*order))
    outer = {f"_o{i}": c for i, c in enumerate(across.values())}
    at = {o: (f"_o{i}", "_has_prev" if o in prev else "_has_next") for i, o in enumerate(across)}
    met = made.withColumns(outer)
    met = met.withColumns({o: F.when(F.col(side).isNull(), F.col(c)).otherwise(F.col(o)) for o, (c, side) in at.items()})
    return met.drop(CELL, MEET, PIECE, "_has_prev", "_has_next", *given, *outer)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    fills: Mapping[str, Column] | None = None,
    ties: str = "rows",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Prefix scans up to and including the current row.

    ``sums`` and ``maxes`` add up / take the maximum, ``fills`` carries the last non-NULL value
    forward. ``ties='range'`` lets rows that are equal in ``order`` see each other.
    """
    sums, maxes, fills = sums or {}, maxes or {}, fills or {}
    named = {f"_v{i}": e for i, e in enumerate([*sums.values(), *maxes.values(), *fills.values()])}
    outs = [*sums, *maxes, *fills]
    kinds = ["sum"] * len(sums) + ["max"] * len(maxes) + ["fill"] * len(fills)
    rows = df.withColumns(named)

    def scan(col: str, kind: str, w) -> Column:
        return {"sum": F.sum(col), "max": F.max(col), "fill": F.last(col, ignorenulls=True)}[kind].over(w)

    def upto(w):
        if ties == "range":
            return w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    if not split:
        w = upto(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumns({o: scan(c, k, w) for o, c, k in zip(outs, named, kinds)}).drop(*named)

    inside = Window.partitionBy(CELL).orderBy(*order)
    made = _cells(rows, keys, order).withColumns(
        {**{o: scan(c, k, upto(inside)) for o, c, k in zip(outs, named, kinds)}, "_has_next": F.lead(F.lit(1)).over(inside)}
    )
    # a piece's last row holds the piece's state; these rows are scanned over the key, and each tells its piece
    last = F.col("_has_next").isNull()
    made = made.withColumn(MEET, F.when(~last, F.col(CELL)))
    earlier = Window.partitionBy(*keys, MEET).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = {o: f"_c{i}" for i, o in enumerate(outs)}
    told = made.withColumns({carried[o]: F.when(last, scan(o, k, earlier)) for o, k in zip(outs, kinds)})
    piece_wide = Window.partitionBy(CELL)
    met = told.withColumns({c: F.first(c, ignorenulls=True).over(piece_wide) for c in carried.values()})
    done = {}
    for o, kind in zip(outs, kinds):
        own, past = F.col(o), F.col(carried[o])
        both = {"sum": own + past, "max": F.greatest(own, past), "fill": own}[kind]
        done[o] = F.coalesce(both, own, past).cast(made.schema[o].dataType)
    return met.withColumns(done).drop(CELL, MEET, PIECE, "_has_next", *carried.values(), *named)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "seq",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """1, 2, 3 … within the key."""
    done = running(df, keys, order, sums={out: F.lit(1).cast("long")}, split=split)
    return done.withColumn(out, F.col(out).cast("int"))


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str], keep: int = 1
) -> DataFrame:
    """The first ``keep`` rows of each key.

    The filter sits directly on the row number, so Spark limits every group before the shuffle
    (WindowGroupLimit) and a hot key sends at most ``keep`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= keep).drop("_rn")
