"""Merkle manifest of a dataset: a hash tree per group and one over the groups' roots, with every row's proof.

Nodes are numbered along the order (``ordinals``, so no group has to be one task) and dealt in blocks of FAN ** LEVELS neighbours, which hold whole runs of
LEVELS levels. Within a block sorted once, a level's nodes lie at rows whose number is a multiple of FAN ** level: lag and lead columns of fixed offsets,
masked by the slot in the run, give a node's siblings, the partition's end gives the last run's length, and the row of a run's first
child hashes the parent. Blocks' nodes, one for 4,096, are written and climbed likewise until each group has one node left. Then paths come
down again, by a join on (group, block), by which the rows already lie.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinals import ordinals
from .common import staged

FAN, LEVELS = 8, 4
BLOCK = FAN**LEVELS
NO_PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' UTF-8 bytes, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field is ``-`` if null, else its UTF-8 byte count, ``:`` and the value as text."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def proof(path: str = "path") -> Column:
    """Digest of all siblings on the way to the root, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(F.col(path), lambda x: F.concat(x["left"], x["right"]))))


def fold(start: Column, path: str = "path") -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(F.col(path), start, lambda own, x: digest(x["left"], own, x["right"]))


def _climb(nodes: DataFrame) -> DataFrame:
    """Adds ``block``, ``own`` (siblings of the levels within the block, bottom up) and, on a block's first row, ``up``: the block's node.

    ``nodes``: g, i (from 0), n (nodes of the group), h. A level whose group has one node is none: the node stays as it is.
    """
    by = Window.partitionBy("g", "block").orderBy("i")
    above = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = nodes.withColumns({"block": F.expr(f"i div {BLOCK}"), "up": F.col("h")})
    path = []
    for level in range(LEVELS):
        step = FAN**level
        left, right = f"_l{level}", f"_r{level}"
        slot, here = F.expr(f"i div {step} % {FAN}"), F.expr(f"i % {step} = 0")
        lags = [F.when(slot >= k, F.lag("up", k * step).over(by)) for k in range(FAN - 1, 0, -1)]
        leads = [F.when(slot + k < FAN, F.lead("up", k * step).over(by)) for k in range(1, FAN)]
        rows = rows.withColumns({left: F.when(here, F.concat_ws("", *lags)), right: F.when(here, F.concat_ws("", *leads))})
        several = F.col("n") > step
        parent = F.when(several, digest("up", right)).otherwise(F.col("up"))
        rows = rows.withColumn("up", F.when(F.expr(f"i % {FAN * step} = 0"), parent))
        of = [F.col(c) if level == 0 else F.last(c, ignorenulls=True).over(above) for c in (left, right)]
        path.append((several, of))
    spread = {f"_p{k}": F.struct(of[0].alias("left"), of[1].alias("right")) for k, (_, of) in enumerate(path)}
    rows = rows.withColumns(spread)
    own = F.concat(*[F.when(several, F.array(f"_p{k}")).otherwise(F.array().cast(NO_PATH)) for k, (several, _) in enumerate(path)])
    return rows.withColumn("own", own).select(*nodes.columns, "block", "own", "up")


def _tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels climbed, bottom up, and the groups' roots (g, h)."""
    most, levels = nodes.agg(F.max("n")).first()[0] or 0, []
    while most > 1:
        levels.append(_climb(nodes))
        heads = levels[-1].where(f"i % {BLOCK} = 0")
        nodes = staged(heads.select("g", F.col("block").alias("i"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("up").alias("h")))
        most = -(-most // BLOCK)
    return levels, nodes.select("g", "h")


def _descend(levels: list[DataFrame], tops: DataFrame, given: list[str]) -> DataFrame:
    """The lowest level's rows with ``path`` and the columns ``given`` of their group's top (g, path, *given)."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for level in reversed(levels):
        near = above.select("g", "block", F.col("path").alias("_path"), *given).hint("merge")
        met = level.join(near, ["g", "block"]).withColumn("path", F.concat("own", "_path"))
        above = met.drop("own", "up", "_path", "block").withColumn("block", F.col("i"))
    return above.drop("block")


def manifest(docs: DataFrame, digest_of: Column, group: str = "lang", order: str = "doc_id", carry: Mapping[str, Column] | None = None) -> DataFrame:
    """(order column, *carry, group_key, leaf, place, subroot, root, path) of every row.

    Per group, leaves stand by the order column, null first, equal ones by their digest; while a group has several nodes, each 8 in a row
    (the last run: fewer, even one) give their parent; what remains is the group's ``subroot``. Subroots in the order of the group's text, bytewise, null
    first, give the ``root`` likewise. ``path`` lists the digests left and right of the row's node in its run, joined, for every level up to the
    root; ``fold`` and ``proof`` read it. ``carry`` maps names to more columns to compute from a row.

    A null group is a group. A lone leaf is its subroot and, as the only one, the root, with an empty path. Repeated rows are leaves of their own. An
    empty table gives an empty one. Texts are read once, by the digest; only digests and the order column are shuffled. Other columns of
    ``docs`` are not read, so their names don't matter.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # "-" sorts before "="
    extra = {f"c{i}": c for i, c in enumerate((carry or {}).values())}
    leaves = staged(docs.select(key.alias("g"), F.col(order).alias("o"), digest_of.alias("h"), *[c.alias(n) for n, c in extra.items()]))
    numbered = ordinals(leaves, ["g"], ["o", "h"], staged, "i", "n").withColumn("i", F.col("i") - 1)
    levels, subroots = _tree(numbered)
    by_group = ordinals(subroots, [], ["g"], staged, "i", "n").withColumn("i", F.col("i") - 1)
    by_group = staged(by_group.select(F.lit("").alias("g"), "i", "n", "h", F.col("g").alias("own_g")))
    upper, root = _tree(by_group)
    whole = root.select("g", F.col("h").alias("root"), F.array().cast(NO_PATH).alias("path"))
    tops = _descend(upper, whole, ["root"]) if upper else by_group.join(whole, "g")
    tops = staged(tops.select(F.col("own_g").alias("g"), F.col("h").alias("subroot"), "root", "path"))
    done = _descend(levels, tops, ["subroot", "root"]) if levels else numbered.join(tops, "g")
    return done.select(
        F.col("o").alias(order), *[F.col(n).alias(name) for n, name in zip(extra, carry or {}, strict=True)],
        F.col("g").alias("group_key"), F.col("h").alias("leaf"), F.col("i").alias("place"), "subroot", "root", "path",
    )
