"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, ``-ln(u) / quality``, with u hashed from its id and text.
Within its source, documents are ordered by key and their sizes are summed up to the source's
budget: a budget of several source sizes is first filled with complete epochs, and only the rest is
selected by key. A document of higher quality has a proportionally higher rate of coming early.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import add_offsets, fresh, uniform

#: Fixed value: symbols that count against a text.
SYMBOLS = "#*$%&|<>"


def quality(text: Column) -> Column:
    """Sampling weight from the text alone, 0.1 to 1: one less ten times the share of symbol characters."""
    t = F.coalesce(text, F.lit(""))
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(10.0) * symbols / F.greatest(F.length(t), F.lit(1)))


def weights(sources: DataFrame, cycle: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """``sources`` (src, src_known, source_size) with a ``weight`` that repeats over the sources by code point, null last.

    One row per source meets in one window, as in ``targets``: a mix is stated per source, so the list is a configuration.
    """
    at = F.row_number().over(Window.orderBy(F.col("src_known").desc(), "src")) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(at, F.lit(len(cycle))) + 1).cast("int")))


def targets(sources: DataFrame, epochs: int = 3) -> DataFrame:
    """``sources`` (…, source_size, weight) with ``target``: shares of all sizes by weight, none above ``epochs`` times its size.

    The excess of capped sources goes to the others by weight until none is above. That ends where every
    source has the smaller of its cap and one common level times its weight; ordered by cap per weight, the level is the
    first that leaves the next source uncapped. Weights must be above 0.
    """
    order = Window.orderBy(F.expr("source_size / weight"), F.col("src_known").desc(), "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    left = total - epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = left.cast("double") / F.sum("weight").over(rest)
    rows = sources.withColumn("_level", level).withColumn("_free", F.col("_level") * F.col("weight") <= epochs * F.col("source_size"))
    first = F.first(F.when(F.col("_free"), F.col("_level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    cap = (epochs * F.col("source_size")).cast("double")
    return rows.withColumn("target", F.coalesce(F.least(cap, first * F.col("weight")), cap)).drop("_level", "_free")


def mix(docs: DataFrame, size: Column, sources: DataFrame | None = None, epochs: int = 3, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", seed: int = 42, cells: int = 4096) -> DataFrame:
    """All rows and columns of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (size times the copies taken).

    ``sources`` gives own (src, weight), else weights 5, 2, 1 repeat; sources it does not list, or without a weight above 0, stay with target and
    taken 0. Complete epochs come first; of the rest a document is
    taken whole if more than half of it lies within the budget, so a source misses its target by half a document at most.
    Order: key, then id (a key that comes twice is of one id and text). Running sums are taken within logarithmic ranges of the key, ``cells`` to eight e-folds, with the ranges'
    totals added, so a source of any size and quality is spread over tasks. A null source is a source (last); null texts and texts without words have size 0 and
    are not taken unless in whole epochs, where their taken size is 0; equal rows are taken one by one; reruns agree.
    Columns named as the new ones are replaced; an empty table gives an empty one.
    """
    new = ["size", "source_size", "target", "taken"]
    base = docs.drop(*new)
    cell, key, src, known, total = (fresh(base, n) for n in ("_cell", "_key", "_src", "_known", "_total"))
    rows = base.withColumns({
        "size": size.cast("long"),
        key: -F.log(uniform(F.col(doc_id), F.col(text), F.lit(seed))) / quality(F.col(text)),
        src: F.coalesce(F.col(source).cast("string"), F.lit("")),
        known: F.col(source).isNotNull(),
    })
    # an exponential key, of whatever rate, has at most a share of 1/e of its rows in an e-fold
    rows = rows.withColumn(cell, F.floor(F.log(F.col(key)) * (cells / 8)).cast("int"))
    per = rows.groupBy(F.col(src).alias("src"), F.col(known).alias("src_known")).agg(F.sum("size").alias("source_size"))
    if sources is None:
        per = weights(per)
    else:
        own = sources.select(F.coalesce("src", F.lit("")).alias("src"), F.col("src").isNotNull().alias("src_known"), "weight")
        per = per.join(own, ["src", "src_known"], "left")
    listed = targets(per.where("weight > 0"), epochs)
    unlisted = per.where("weight is null or weight <= 0").withColumn("target", F.lit(0.0))
    per = listed.unionByName(unlisted).select(F.col("src").alias(src), F.col("src_known").alias(known), "source_size", "target")
    out = add_offsets(rows, [src, known], cell, F.col("size"), [F.col(key), F.col(doc_id)], total, per)
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    rest = F.col("target") - whole * F.col("source_size")
    picked = (F.col(total) - F.col("size") / 2.0 < rest) & (F.col("size") > 0)
    out = out.withColumn("taken", (F.col("size") * (whole + picked.cast("int"))).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in base.columns], *new)


def take_all(mixed: DataFrame) -> DataFrame:
    """Rows of a mix as often as it takes them; texts without words, which count nothing, come once for every whole epoch."""
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(whole).cast("int")
    copy = fresh(mixed, "_copy")
    rows = mixed.where(copies > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), copies)))
    return rows.drop(copy)
