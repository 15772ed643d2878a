"""The lowest value of the windows active at a time, as segments of constant minimum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import MAX_DATE
from .ordered import neighbours
from .temporal import DAYS, FIRST_DAY, cover_sql, day_sql, point_sql, valid_versions


def lowest_segments(windows: DataFrame, entity: str, value: Column, out: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """(entity, start_date, end_date, out): segments [start, end) in which ``out`` is the lowest value of the windows [start, end] active there.

    Neighbouring segments differ in the value; times without a window are left out. Windows overlap as they like, an end of NULL is open; those
    without entity, start or value or that end before they start count for nothing. Rows grow with the windows, not with their days: a window gives its value to the
    few blocks of the calendar that cover it, the lowest value per block is combined before the shuffle, and each start or end looks at its five blocks.
    """
    rows = windows.select(
        F.col(entity).alias("_of"), F.col(start).alias("_s"),
        F.expr(f"date_add(least(coalesce(`{end}`, DATE '{MAX_DATE}'), date_sub(DATE '{MAX_DATE}', 1)), 1)").alias("_e"), value.alias("_v"),
    ).filter("_of is not null and _s < _e and _v is not null")
    grid = rows.selectExpr("_of", "_v", f"{day_sql('_s')} AS _first", f"{day_sql('date_sub(_e, 1)')} AS _last")
    lowest = grid.selectExpr("_of", "_v", f"explode({cover_sql('_first', '_last')}) AS _block").groupBy("_of", "_block").agg(F.min("_v").alias("_v"))
    points = rows.select("_of", F.explode(F.array("_s", "_e")).alias("_at")).distinct().filter(f"_at < DATE '{MAX_DATE}'")
    # days outside the grid share its first and last day: there the windows themselves are asked
    known = f"unix_date(_at) + {FIRST_DAY} BETWEEN 1 AND {DAYS - 2}"
    asked = points.filter(known).selectExpr("_of", "_at", f"{day_sql('_at')} AS _first").selectExpr("_of", "_at", f"explode({point_sql('_first')}) AS _block")
    inner = asked.join(lowest, ["_of", "_block"], "left").select("_of", "_at", "_v")
    outer = valid_versions(points.filter(f"NOT ({known})"), rows, ["_of"], "_at", "_s", "_e", how="left").select("_of", "_at", "_v")
    met = inner.unionByName(outer).groupBy("_of", "_at").agg(F.min("_v").alias("_v"))
    # one row for an entity and day on which a window starts or ends
    turns = neighbours(met, ["_of"], ["_at"], before={"_was": F.col("_v")}, split=False).filter(~F.col("_v").eqNullSafe(F.col("_was")))
    cut = neighbours(turns, ["_of"], ["_at"], after={"_to": F.col("_at")}, split=False).filter("_v is not null")
    until = F.coalesce("_to", F.lit(MAX_DATE).cast("date"))
    return cut.select(F.col("_of").alias(entity), F.col("_at").alias("start_date"), until.alias("end_date"), F.col("_v").alias(out))
