"""Suffix-array dedup with a sparse suffix array.

Only suffixes that begin at a minimiser are kept: of every run of windows with one minimiser, the one that begins there. They
are sorted over the cluster by hashes of the minimiser and of the run around it, and neighbours are compared for equality; this is no order of
the words, and no common prefix is measured. Equal runs match over their whole length; runs that differ are cut into single windows, which
are sorted and compared with their neighbours in the same way. Equality is that of 128-bit digests of the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .repeats import KEY, remove, segment_table, window_table


def neighbours(rows: DataFrame, levels: dict[str, list[str]], ties: list[str]) -> DataFrame:
    """Sorts rows over the cluster by the levels' columns, then ties, and says for each level if a neighbour is equal in it.

    ``levels``: name of the flag and its columns, longs, each level's columns being the beginning of the next's. Long runs of equal rows
    are spread over tasks by the ties. A partition's first and last row are compared over the border in a second step, of two rows for each partition.
    """
    keys = list(levels.values())[-1]
    order = [*keys, *ties]
    flags = list(levels)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shape = ", ".join(f"{c} {k}" for c, k in [*rows.dtypes, *((f, "boolean") for f in flags), ("_part", "int"), ("_edge", "int")])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, opening = TaskContext.get().partitionId(), None, True

        def flagged(pdf: pd.DataFrame, before: pd.DataFrame | None, after: pd.DataFrame | None) -> pd.DataFrame:
            out = pdf.copy()
            for flag, columns in levels.items():
                v = pdf[columns].to_numpy()
                same = (v[1:] == v[:-1]).all(axis=1)
                first = before is not None and bool((before[columns].to_numpy()[-1] == v[0]).all())
                last = after is not None and bool((after[columns].to_numpy()[0] == v[-1]).all())
                out[flag] = np.concatenate(([first], same)) | np.concatenate((same, [last]))
            out["_part"], out["_edge"] = part, 0
            return out

        before = None
        for pdf in batches:
            if not len(pdf):
                continue
            if held is not None:
                out = flagged(held, before, pdf)
                if opening:
                    out.iloc[0, out.columns.get_loc("_edge")], opening = 1, False
                yield out
                before = held.iloc[-1:]
            held = pdf
        if held is not None:
            out = flagged(held, before, None)
            at = out.columns.get_loc("_edge")
            if opening:
                out.iloc[0, at] = 1
            out.iloc[-1, at] += 2
            yield out

    done = staged(ranged.mapInPandas(compare, shape))
    inner, edges = done.where("_edge = 0"), done.where("_edge > 0")
    line = Window.orderBy("_part", "_edge")  # at most two rows for each partition
    for flag, columns in levels.items():
        same = [[F.coalesce(side(c).over(line) == F.col(c), F.lit(False)) for c in columns] for side in (F.lag, F.lead)]
        for one in same:
            both = one[0]
            for c in one[1:]:
                both = both & c
            edges = edges.withColumn(flag, F.col(flag) | both)
    return inner.unionByName(edges).drop("_part", "_edge")


def repeated_spans(docs: DataFrame, length: int = 50, gram: int = 8, text: str = "text") -> DataFrame:
    """(key1, key2, first, end) of words, by text, that lie in a match of at least ``length`` words with any other place.

    Every row of ``docs`` counts, and so do places in one text. Spans overlap and touch; together they cover exactly the matches. Null texts,
    texts shorter than a match and an empty table have none.
    """
    suffixes = segment_table(docs, length, gram, text)
    ranked = neighbours(suffixes, {"near": ["anchor"], "same": ["anchor", "seg1", "seg2"]}, [*KEY, "first"])
    ranked = staged(ranked.where("near"))
    end = F.col("first") + F.col("n") + F.lit(length - 1)
    whole = ranked.where("same").select(*KEY, "first", end.alias("end"))
    # of equal runs one stands for all; a run that differs from its neighbours may match the runs of its minimiser in part
    runs = ranked.groupBy("anchor", "seg1", "seg2").agg(*[F.first(c).alias(c) for c in (*KEY, "first", "n")], F.max("same").alias("whole"))
    runs = staged(runs)
    mixed = staged(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("anchor"))
    apart = runs.join(mixed, "anchor", "left_semi").select(*KEY, "first", "n", "whole")
    extended = neighbours(window_table(docs, apart, length, text), {"same": ["win1", "win2"]}, [*KEY, "at"])
    part = extended.where("same and not whole").select(*KEY, F.col("at").alias("first"), (F.col("at") + length).alias("end"))
    return whole.unionByName(part)


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 8, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` without the words of matches, in all their places; adds ``n_words`` and ``n_removed``."""
    return remove(docs, repeated_spans(docs, length, gram, text), text)
