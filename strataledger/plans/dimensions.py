"""Dimension loads end to end: type 2 from two systems' audit logs, type 1 by hash with late ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import with_row_hash
from ..operators.history import build_scd2, latest_per_day, stitch
from ..operators.upsert import Stage, assign_keys, backfill_ids, upsert_scd2, upsert_type1, with_unknown


def type2_backfill(
    logs: Sequence[DataFrame], cut: Column | None, entity: str, ts: str, tie: str, attrs: Sequence[str], key: str,
    sparse: Sequence[str] = (), day: Column | None = None,
) -> DataFrame:
    """A keyed type-2 dimension from the audit log of one system, or of two with a date from which the second counts.

    With two, each log is reduced to its last state per day, the second system's states follow the first's and equal neighbours at the seam make one version.
    Surrogate keys run over (entity, start).
    """
    if len(logs) == 1:
        hist = build_scd2(logs[0], entity, ts, tie, attrs, sparse, day)
    else:
        daily = [
            latest_per_day(log, [entity], ts, tie, day, out="start_date").select(entity, "start_date", *attrs, F.lit(0).alias("tie")) for log in logs
        ]
        hist = stitch(*daily, entity, cut, list(attrs), split=False).drop("tie", "system", "ordinal")
    none = hist.withColumn(key, F.lit(0).cast("bigint")).limit(0)
    return assign_keys(none, hist, key, [entity, "start_date"])


def type2_increment(
    dim: DataFrame, log: DataFrame, entity: str, ts: str, tie: str, attrs: Sequence[str], key: str, as_of: Column,
    type1: Sequence[str] = (),
) -> DataFrame:
    """The dimension after one day's log: the day's last states close and open versions, opened ones get new keys."""
    last = latest_per_day(log, [entity], ts, tie).select(entity, *attrs, *type1)
    return upsert_scd2(dim, last, [entity], attrs, as_of, type1=type1, key=key)


def type1_load(
    dim: DataFrame, batch: DataFrame, business_key: str, tracked: Sequence[str], key: str, late_ids: DataFrame, id_col: str,
    unknown: Mapping[str, object], stage: Stage | None = None,
) -> DataFrame:
    """Hash upsert, keys for new members, ids that turn up late, and the unknown member.

    ``late_ids`` has the business key and the id; an id fills a member whose id is still unknown, unless it is in use.
    """
    done = upsert_type1(dim, batch, [business_key], list(tracked))
    old, new = done.filter(F.col(key).isNotNull()), done.filter(F.col(key).isNull())
    keyed = assign_keys(old, new, key, [business_key], stage=stage)
    blank = F.coalesce(F.col(id_col), F.lit(unknown[id_col]))
    filled = backfill_ids(keyed.withColumn(id_col, blank), late_ids, business_key, id_col, tracked, unknown[id_col])
    return with_row_hash(with_unknown(filled, key, unknown), tracked)
