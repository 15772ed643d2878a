"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard: on each level every child draws ``-ln(u) / weight`` with
u hashed from the document's id and the child's name, and the smallest draw wins. A child's draw
depends on nothing but its own name and weight, so a changed weight moves rows only between that
subtree and the rest; new capacity that comes as a new top-level subtree takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_offsets, fresh


@dataclass(frozen=True)
class Shard:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


def topology(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> list[Shard]:
    """Shards in racks in regions, filled in order: the layout of a new tree. To add shards to one in use, ``grow`` it."""
    return [
        Shard(i, f"r{i // (per_rack * racks_per_region)}", f"k{i // per_rack}")
        for i in range(shards)
    ]


def grow(shards: list[Shard], n: int = 1) -> list[Shard]:
    """The shards and n more after them, each in a region of its own, so that it takes rows only into itself, whatever the count before."""
    top = max(s.shard for s in shards) + 1
    return [*shards, *[Shard(i, f"g{i}", f"g{i}") for i in range(top, top + n)]]


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))


def _lowest(key: Column, children: dict[str, tuple[float, Column]]) -> Column:
    """The value below the child with the smallest draw, ties to the first name; children without weight get nothing."""
    live = [(name, w, below) for name, (w, below) in sorted(children.items()) if w > 0]
    if not live:
        raise ValueError("no child has a weight")
    if len(live) == 1:
        return live[0][2]
    draws = [F.struct(_draw(key, name, w).alias("draw"), F.lit(i).alias("at")) for i, (name, w, _) in enumerate(live)]
    win = F.least(*draws)["at"]
    out = live[-1][2]
    for i, (_, _, below) in reversed(list(enumerate(live[:-1]))):
        out = F.when(win == i, below).otherwise(out)
    return out


def place(key: Column, shards: list[Shard]) -> Column:
    """The shard (int) of a document key in a tree of positive weights; a null key is a key like any other."""
    key = F.coalesce(key.cast("string"), F.lit("\\N"))
    tree: dict[str, dict[str, list[Shard]]] = {}
    for s in shards:
        tree.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    regions = {}
    for region, racks in tree.items():
        below = {}
        for rack, leaves in racks.items():
            own = {f"{region}/{rack}/{s.shard}": (s.weight, F.lit(s.shard)) for s in leaves}
            below[f"{region}/{rack}"] = (sum(s.weight for s in leaves), own)
        alive = {n: (w, _lowest(key, own)) for n, (w, own) in below.items() if w > 0}
        if alive:
            regions[region] = (sum(w for w, _ in alive.values()), _lowest(key, alive))
    return _lowest(key, regions).cast("int")


def shard(docs: DataFrame, shards: list[Shard], grown: list[Shard] | None = None, doc_id: str = "doc_id",
          text: str = "text", cells: int = 4096) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (int), ``slot`` (long, gapless from 0 in a shard) and ``grown_shard``.

    ``grown_shard`` is the shard under the tree ``grown`` (null without one). The id alone decides the shard. Slots follow a
    hash of id and text, then id and text: they are counted within ``cells`` hash ranges of a shard and offset by the ranges'
    totals, so no shard is numbered in one task. Equal rows take neighbouring slots. Columns named as the new ones are
    replaced; null ids are one key, null texts allowed, an empty table gives an empty one.
    """
    new = ["shard", "slot", "grown_shard"]
    base = docs.drop(*new)
    cell = fresh(base, "_cell")
    key = F.col(doc_id)
    out = base.withColumns({
        "shard": place(key, shards),
        "grown_shard": place(key, grown) if grown else F.lit(None).cast("int"),
        cell: F.pmod(F.xxhash64(key, F.col(text)), F.lit(cells)),
    })
    out = add_offsets(out, ["shard"], cell, F.lit(1), [key, F.col(text)], "slot")
    return out.withColumn("slot", F.col("slot") - 1).select(*[F.col(f"`{c}`") for c in base.columns], *new)
