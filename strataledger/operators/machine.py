"""State machines over ordered events, for entities of any number of events.

With few states an event is a function from state to state, and a stretch of events is one too: the composition of theirs. Stretches of 64 units of
time (days of a date, seconds of a timestamp) are composed, then 64 neighbours of these, and so on to the whole of time; coming down again, each
stretch is told the state in which it begins. So an entity's events are never in one task, only those of one stretch, and no level looks
at more than 64 stretches below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 6


def _time(df: DataFrame, at: str) -> tuple[Column, int]:
    """A number that rises with time and is never negative, and the levels of 64 that hold all of its range."""
    if isinstance(df.schema[at].dataType, T.DateType):
        return F.unix_date(at).cast("long") + (1 << 22), 4
    return F.unix_seconds(F.col(at).cast("timestamp")) + (1 << 38), 7


def _composed(kids: Column, states: int) -> Column:
    """The function of a list of structs with functions ``f``, applied in their order."""
    identity = F.array(*[F.lit(s) for s in range(states)])
    return F.aggregate(kids, identity, lambda done, kid: F.transform(done, lambda s: F.get(kid["f"], s)))


def _entered(kids: Column, entry: Column, shape: str, result) -> Column:
    """One struct for each kid, made by ``result(kid, state before it)``."""
    zero = F.struct(entry.alias("s"), F.array().cast(f"array<{shape}>").alias("out"))
    step = lambda acc, kid: F.struct(F.get(kid["f"], acc["s"]).alias("s"), F.array_append(acc["out"], result(kid, acc["s"])).alias("out"))
    return F.aggregate(kids, zero, step)["out"]


def scan_states(
    events: DataFrame, key: str, at: str, tie: str, symbol: str, moves: Sequence[Sequence[int]], start: int = 0,
    before: str = "state_before", after: str = "state_after",
) -> DataFrame:
    """Events with the state of their entity before and after them.

    ``moves[k][s]`` is the state after an event with symbol k in state s; a symbol that is NULL or beyond the list changes nothing. Events of an entity are ordered by
    (at, tie), which should be total; entities begin in ``start``. Events without a time come first. NULL keys are one entity.
    """
    states = len(moves[0])
    time, levels = _time(events, at)
    table = F.array(*[F.array(*[F.lit(s) for s in m]) for m in moves])
    inside = F.col(symbol).between(0, len(moves) - 1)
    f = F.when(F.coalesce(inside, F.lit(False)), F.get(table, F.col(symbol).cast("int"))).otherwise(F.array(*[F.lit(s) for s in range(states)]))
    group = F.struct(F.col(key).alias("k"))  # NULL keys meet in joins
    base = events.select(group.alias("_k"), F.shiftright(F.coalesce(time, F.lit(0)), BITS).alias("_g"), F.col(at).alias("a"), F.col(tie).alias("t"), f.alias("f"),
                         F.struct(*events.columns).alias("row"))

    def gathered(rows: DataFrame, *cols: str) -> DataFrame:
        return rows.groupBy("_k", "_g").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("kids"))

    level = [gathered(base, "a", "t", "f").select("_k", "_g", _composed(F.col("kids"), states).alias("f"))]
    kids = []
    for i in range(1, levels):
        up = gathered(level[-1].select("_k", F.shiftright("_g", BITS).alias("_g"), F.col("_g").alias("g"), "f"), "g", "f")
        kids.append(up)
        level.append(up.select("_k", "_g", _composed(F.col("kids"), states).alias("f")))
    entry = level[-1].select("_k", "_g", F.lit(start).alias("s"))
    for up in reversed(kids):
        met = up.join(entry, ["_k", "_g"])
        told = _entered(F.col("kids"), F.col("s"), "struct<g: bigint, s: int>", lambda kid, s: F.struct(kid["g"].alias("g"), s.alias("s")))
        entry = met.select("_k", F.explode(told).alias("e")).select("_k", F.col("e.g").alias("_g"), F.col("e.s").alias("s"))
    rows = gathered(base, "a", "t", "f", "row").join(entry, ["_k", "_g"])
    row = T.StructType([T.StructField(c.name, c.dataType) for c in events.schema]).simpleString()
    told = _entered(
        F.col("kids"), F.col("s"), f"struct<row: {row}, b: int, e: int>",
        lambda kid, s: F.struct(kid["row"].alias("row"), s.alias("b"), F.get(kid["f"], s).alias("e")),
    )
    done = rows.select(F.explode(told).alias("x"))
    return done.select(*[F.col("x.row")[c].alias(c) for c in events.columns], F.col("x.b").alias(before), F.col("x.e").alias(after))
