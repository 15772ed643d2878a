"""Substring dedup by De Bruijn compaction.

A window of k words is an edge of the graph. Edges that follow each other in a text and share a minimiser, the node that both
contain, form a path; a path's occurrences come together on that node. Where all occurrences of a node lie on one path, the node does not
branch: the path is compacted, counted and decided as a whole. Only where paths branch are they taken apart again into single edges, which are
counted by the words at their source coordinates. Equality is always that of 128-bit digests of the words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .repeats import KEY, remove, segment_table, window_table

PATH = ["anchor", "seg1", "seg2"]


def repeated_spans(docs: DataFrame, window: int = 35, gram: int = 8, text: str = "text") -> DataFrame:
    """(key1, key2, first, end) of words, by text, that lie in a window whose words also start anywhere else.

    Every row of ``docs`` counts: two copies of a text repeat all their windows. Spans overlap and touch; together they cover
    exactly the repeated windows. Null texts, texts shorter than a window and an empty table have none.
    """
    segments = segment_table(docs, window, gram, text)
    often = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    segments = staged(segments.join(staged(often), "anchor", "left_semi"))
    paths = segments.groupBy(*PATH).agg(
        F.count(F.lit(1)).alias("c"), *[F.first(c).alias(c) for c in (*KEY, "first", "n")]
    )
    paths = staged(paths)
    end = F.col("first") + F.col("n") + F.lit(window - 1)
    compact = segments.join(paths.where("c > 1").select(*PATH), PATH, "left_semi").select(*KEY, "first", end.alias("end"))
    # of a branching node, each different path once: single edges of it may also lie on another
    branching = staged(paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("anchor"))
    apart = paths.join(branching, "anchor", "left_semi").select(*KEY, "first", "n", (F.col("c") > 1).alias("whole"))
    edges = window_table(docs, apart, window, text)
    twice = edges.groupBy("win1", "win2").agg(F.count(F.lit(1)).alias("c"), F.max("whole").alias("whole"))
    twice = staged(twice.where("c > 1 or whole").select("win1", "win2"))
    single = edges.where("not whole").join(twice, ["win1", "win2"], "left_semi")
    single = single.select(*KEY, F.col("at").alias("first"), (F.col("at") + window).alias("end"))
    return compact.unionByName(single)


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 8, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` without the words of repeated windows, in all their places; adds ``n_words`` and ``n_removed``."""
    return remove(docs, repeated_spans(docs, window, gram, text), text)
