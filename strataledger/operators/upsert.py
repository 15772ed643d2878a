"""Upserts as pure functions: (target, batch) -> new target.

Parquet tables have no MERGE; the caller writes the result to a new path (``sources.lake``).
A batch must have one row per key. ``unique_batch`` makes it so by a stated order instead of
letting an arbitrary match win.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY, UNKNOWN_TEXT, max_date
from ..functions.hashing import with_row_hash
from .history import close_with_next
from .hotkeys import DEFAULT_SPLIT, Split
from .joins import missing
from .ordered import first_per_key, neighbours, numbered
from .ordinals import ordinals

NEW, MODIFIED, UNCHANGED = "NEW", "MODIFIED", "NO CHANGE"

# New values of target columns, computed from target columns and batch columns (s_<col>).
Rule = Mapping[str, Column]


def unique_batch(src: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str]) -> DataFrame:
    return first_per_key(src, keys, newest_first)


def classify(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], hash_col: str = "row_hash", out: str = "change"
) -> DataFrame:
    """NEW, MODIFIED or NO CHANGE for each batch row."""
    stored = tgt.select(*keys, F.col(hash_col).alias("_stored"), F.lit(1).alias("_hit"))
    label = (
        F.when(F.col("_hit").isNull(), NEW)
        .when(F.col("_stored") != F.col(hash_col), MODIFIED)
        .when(F.col("_stored") == F.col(hash_col), UNCHANGED)
        .otherwise(UNKNOWN_TEXT)
    )
    return src.join(stored, [*keys], "left").withColumn(out, label).drop("_stored", "_hit")


def one_per_key(src: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str] | None = None) -> DataFrame:
    """A batch with one row per key: the first by the stated order, or, without one, an error for a key that comes twice.

    Rows with a NULL in their key match nothing and are left as they are. The check runs on the shuffle that the join needs anyway.
    """
    if newest_first is not None:
        return unique_batch(src, keys, newest_first)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    twice = F.raise_error(F.lit(f"a batch has two rows for one key ({', '.join(keys)}); state their order")).cast("boolean")
    return src.withColumn("_n", n).filter(F.when(known & (F.col("_n") > 1), twice).otherwise(F.lit(True))).drop("_n")


def side_by_side(
    tgt: DataFrame, src: DataFrame, keys: Sequence[str], insert: bool, newest_first: Sequence[Column | str] | None = None
) -> DataFrame:
    """Target columns, batch columns as s_<col>, and who has the row (_t, _s).

    One join: from the left without ``insert``, full with it, which adds the rows only the batch has.
    """
    batch = one_per_key(src, keys, newest_first)
    new = batch.select(*[F.col(c).alias(f"s_{c}") for c in src.columns], F.lit(1).alias("_s"))
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"s_{k}") for k in keys])
    return tgt.withColumn("_t", F.lit(1)).join(new, cond, "full" if insert else "left")


def apply_rules(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rules in their order, on rows that both sides have."""
    both = (F.col("_t") == 1) & (F.col("_s") == 1)
    for rule in rules:
        rows = rows.withColumns({c: F.when(both, e).otherwise(F.col(c)) for c, e in rule.items()})
    return rows


def update_rows(
    tgt: DataFrame, src: DataFrame, keys: Sequence[str], rules: Sequence[Rule],
    newest_first: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Update matching target rows."""
    return apply_rules(side_by_side(tgt, src, keys, False, newest_first), rules).select(*tgt.columns)


def accumulate(
    tgt: DataFrame, src: DataFrame, keys: Sequence[str], rules: Sequence[Rule],
    newest_first: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Update matching rows by the rules and add the rows the target does not have, in one join.

    For an accumulating snapshot the order matters: rows must be reopened before they are filled.
    """
    rows = apply_rules(side_by_side(tgt, src, keys, True, newest_first), rules)
    absent = F.col("_t").isNull()
    return rows.select(
        *[F.when(absent, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in src.columns else c for c in tgt.columns]
    )


def update_type1(
    tgt: DataFrame, src: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Overwrite ``cols`` where the batch has the key."""
    return update_rows(tgt, src.select(*keys, *cols), keys, [{c: F.col(f"s_{c}") for c in cols}])


def insert_new(tgt: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append batch rows whose keys are absent; a rerun adds nothing."""
    fresh = one_per_key(missing(src, tgt, keys), keys)
    return tgt.unionByName(fresh, allowMissingColumns=True).select(*tgt.columns)


def upsert_type1(
    tgt: DataFrame, src: DataFrame, keys: Sequence[str], cols: Sequence[str],
    newest_first: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Update modified rows (told by hash) and insert new ones."""
    stored, batch = with_row_hash(tgt, cols), with_row_hash(src, cols)
    modified = F.col("row_hash") != F.col("s_row_hash")
    rule = {c: F.when(modified, F.col(f"s_{c}")).otherwise(F.col(c)) for c in [*cols, "row_hash"]}
    return accumulate(stored, batch, keys, [rule], newest_first)


def backfill_ids(
    tgt: DataFrame, mapping: DataFrame, key: str, id_col: str, hashed: Sequence[str], unknown: object = UNKNOWN_TEXT
) -> DataFrame:
    """Fill unknown ids once a mapping turns up, unless the id is already in use; hash again."""
    free = mapping.join(tgt.select(id_col).distinct(), id_col, "left_anti")
    found = free.select(key, F.col(id_col).alias("_id"))
    joined = tgt.join(found, key, "left")
    is_unknown = F.col(id_col) == F.lit(unknown)
    filled = joined.withColumn(
        id_col, F.when(is_unknown & F.col("_id").isNotNull(), F.col("_id")).otherwise(F.col(id_col))
    ).select(*tgt.columns)
    return with_row_hash(filled, hashed)


def close_versions(tgt: DataFrame, changed: DataFrame, keys: Sequence[str], end: Column) -> DataFrame:
    """End the current version of each key in ``changed``."""
    hits = changed.select(*keys).distinct().withColumn("_hit", F.lit(1))
    closing = (F.col("_hit") == 1) & (F.col("current_record") == 1)
    return tgt.join(hits, [*keys], "left").withColumns(
        {
            "end_date": F.when(closing, end).otherwise(F.col("end_date")),
            "current_record": F.when(closing, 0).otherwise(F.col("current_record")),
        }
    ).select(*tgt.columns)


def upsert_scd2(
    tgt: DataFrame, src: DataFrame, keys: Sequence[str], attrs: Sequence[str], as_of: Column,
    type1: Sequence[str] = (), key: str | None = None, newest_first: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Close the modified current versions and open new ones from ``as_of``.

    Only current versions meet the batch, once; all others, with a flag of 0 or NULL, pass through unshuffled. A pair
    that differs becomes two rows, the closed and the opened version. The target's further columns stay with their rows; an opened
    version takes the batch's value of them where the batch has the column, else the closed version's. ``type1`` columns are
    overwritten on the current version as well, closed or not. ``key`` is a surrogate key: opened versions get new ones, on from the largest.
    """
    versioned = [*keys, *attrs, "row_hash", "start_date", "end_date", "current_record"]
    further = [c for c in tgt.columns if c not in versioned]
    sent = [c for c in further if c in src.columns]
    batch = with_row_hash(src.select(*keys, *attrs, *sent, *[c for c in _columns(newest_first) if c not in {*keys, *attrs, *sent}]), attrs)
    is_current = F.coalesce(F.col("current_record"), F.lit(0)) == 1
    rows = side_by_side(tgt.filter(is_current), batch, keys, True, newest_first)
    stored, both = F.col("_t") == 1, (F.col("_t") == 1) & (F.col("_s") == 1)
    modified = both & (F.col("row_hash") != F.col("s_row_hash"))

    def version(old: bool, end: Column, flag: Column) -> Column:
        made = {"start_date": F.col("start_date") if old else as_of, "end_date": end, "current_record": flag}
        for c in tgt.columns:
            if c in made:
                continue
            if c in further:
                late = F.col(f"s_{c}") if c in sent else F.lit(None)
                mine = F.when(both & F.lit(c in type1 and c in sent), late).otherwise(F.col(c))
                theirs = F.coalesce(late, F.col(c)) if c in sent else F.col(c)
                made[c] = mine if old else F.lit(None) if c == key else theirs
            else:
                made[c] = F.col(c) if old else F.col(f"s_{c}")
        kinds = {f.name: f.dataType for f in tgt.schema.fields}
        return F.struct(*[made[c].cast(kinds[c]).alias(c) for c in tgt.columns], F.lit(not old).alias("_opened"))

    kept = version(True, F.col("end_date"), F.lit(1))
    closed = version(True, as_of, F.lit(0))
    opened = version(False, max_date(), F.lit(1))
    out = F.when(modified, F.array(closed, opened)).when(stored, F.array(kept)).otherwise(F.array(opened))
    done = rows.select(F.explode(out).alias("_v")).select("_v.*")
    if key is None:
        return tgt.filter(~is_current).unionByName(done.drop("_opened"))
    fresh = done.filter("_opened").drop("_opened", key)
    stored_rows = tgt.filter(~is_current).unionByName(done.filter("not _opened").drop("_opened"))
    return stored_rows.unionByName(_keyed(tgt, fresh, key, list(keys), DEFAULT_SPLIT).select(*tgt.columns))


def _columns(order: Sequence[Column | str] | None) -> list[str]:
    return [c for c in order or [] if isinstance(c, str)]


def fill_rule(unset: Mapping[str, object], open_rows: Column, derived: Rule | None = None) -> Rule:
    """Set a column of an open row only while it still has its unset value (-1, 0 or None).

    ``derived`` sets further columns of open rows from the batch (named s_<col>).
    """
    made = {}
    for c, blank in unset.items():
        empty = F.col(c).isNull() if blank is None else F.col(c) == F.lit(blank)
        made[c] = F.when(open_rows & empty, F.col(f"s_{c}")).otherwise(F.col(c))
    for c, expr in (derived or {}).items():
        made[c] = F.when(open_rows, expr).otherwise(F.col(c))
    return made


def late_rule(col: str) -> Rule:
    """Take a measure that arrives late, on open and closed rows alike."""
    return {col: F.coalesce(F.col(col), F.col(f"s_{col}"))}


def reopen_rule(tgt: DataFrame, cond: Column, reset: Mapping[str, object], closed_rows: Column) -> Rule:
    """Reset closed rows whose source (s_<col>) contradicts the stored outcome."""
    back = F.coalesce(closed_rows & cond, F.lit(False))
    return {c: F.when(back, F.lit(v).cast(tgt.schema[c].dataType)).otherwise(F.col(c)) for c, v in reset.items()}


def with_unknown(dim: DataFrame, key: str, values: Mapping[str, object], unknown: int = UNKNOWN_KEY) -> DataFrame:
    """Add the unknown member unless it is there."""
    row = {**values, key: unknown}
    spark = dim.sparkSession
    member = spark.range(1).select(
        *[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(missing(member, dim, [key]))


Stage = Callable[[DataFrame], DataFrame]  # writes a table that driver and executors see and reads it back


def _keyed(tgt: DataFrame, new: DataFrame, key: str, order: Sequence[str], split: Split, stage: Stage | None = None) -> DataFrame:
    top = tgt.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).scalar()
    seq = ordinals(new, [], order, stage, "_seq") if stage else numbered(new, [], order, "_seq", split)
    return seq.withColumn(key, (top + F.col("_seq")).cast(tgt.schema[key].dataType)).drop("_seq")


def assign_keys(
    tgt: DataFrame, new: DataFrame, key: str, order: Sequence[str], split: Split = DEFAULT_SPLIT, stage: Stage | None = None
) -> DataFrame:
    """Number new rows on from the target's largest key.

    Only new rows are numbered: with a ``stage`` by sampled ranges of the whole order (``ordinals``), which no prefix, dense number or burst can make uneven, else
    within pieces of its first column that are offset by the pieces before (``ordered.running``).
    """
    return tgt.unionByName(_keyed(tgt, new, key, order, split, stage).select(*tgt.columns))


def repair_scd2(
    dim: DataFrame, twins: DataFrame, key: str, master: str, fill: str, version: Sequence[str],
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Repair entities that live under two ids.

    Rows of a twin are re-pointed to its master id; the repaired entities get end dates and
    current flags again and a one-step fill of ``fill``. All other rows stay as they are.
    """
    pairs = twins.select(key, F.col(master).alias("_master"))
    pointed = dim.join(pairs, key, "left").withColumn(key, F.coalesce("_master", key)).drop("_master")
    masters = twins.select(F.col(master).alias(key)).distinct()
    broken = pointed.join(masters, key, "left_semi")
    sound = pointed.join(masters, key, "left_anti")
    seen = neighbours(broken, [key], ["start_date", *version], before={"_prev": F.col(fill)}, split=split)
    seen = seen.withColumn(fill, F.coalesce(fill, "_prev")).drop("_prev")
    fixed = close_with_next(seen, [key], ["start_date", *version], split=split)
    return sound.unionByName(fixed)


def bridge(pairs: DataFrame, dim: DataFrame, fact_key: str, label: str, dim_key: str, dim_label: str) -> DataFrame:
    """Distinct (fact key, dimension key) pairs from unpivoted labels; unknown labels get -1."""
    side = dim.select(F.col(dim_label).alias(label), dim_key)
    return (
        pairs.select(fact_key, label).join(side, label, "left")
        .select(fact_key, F.coalesce(dim_key, F.lit(UNKNOWN_KEY)).alias(dim_key)).distinct()
    )


def load(tgt: DataFrame, full: Callable[[], DataFrame], increment: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Full backfill for an empty target, else the increment."""
    return full() if tgt.isEmpty() else increment(tgt)
