"""Spark steps shared by the two operators on long repeated passages: segment tables, single windows, and the removal of spans.

A text is known by two 64-bit hashes; copies of a text have the same spans, so spans are kept once for each text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, staged
from .spans import Spans, covered, parts

KEY = ["key1", "key2"]


def keyed(docs: DataFrame, text: str) -> DataFrame:
    t = F.col(text)
    return docs.where(t.isNotNull()).select(F.xxhash64(t).alias("key1"), F.xxhash64(F.lit(1), t).alias("key2"), t.alias("text"))


def segment_table(docs: DataFrame, window: int, gram: int, text: str) -> DataFrame:
    """Every run of windows with one minimiser, of every row: (key1, key2, anchor, seg1, seg2, first, n), written once.

    ``first`` is the first window's first word, ``n`` the number of windows, (seg1, seg2) a digest of all words of the run.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in parts(pdf):
                s = Spans(part["text"].tolist())
                anchor, begin, n = s.segments(window, gram)
                seg = s.digests(begin, begin + n + window - 1)
                doc = s.doc[begin]
                yield pd.DataFrame({
                    "key1": part["key1"].to_numpy()[doc], "key2": part["key2"].to_numpy()[doc], "anchor": anchor,
                    "seg1": seg[:, 0], "seg2": seg[:, 1], "first": begin - s.first[doc], "n": n,
                })

    return staged(keyed(docs, text).mapInPandas(cut, "key1 long, key2 long, anchor long, seg1 long, seg2 long, first int, n int"))


def window_table(docs: DataFrame, segments: DataFrame, window: int, text: str) -> DataFrame:
    """Single windows of the given segments (key1, key2, first, n, whole): (win1, win2, key1, key2, at, whole), written once.

    Segments of a text come together with it; their number is bounded by its length.
    """
    wanted = staged(segments.groupBy(*KEY).agg(F.collect_set(F.struct("first", "n", "whole")).alias("runs")))
    rows = keyed(docs, text).join(wanted, KEY)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in parts(pdf):
                s = Spans(part["text"].tolist())
                begin, doc, whole = [], [], []
                for d, runs in enumerate(part["runs"]):
                    for run in runs:
                        begin.append(np.arange(run["first"], run["first"] + run["n"]) + s.first[d])
                        doc.append(np.full(run["n"], d))
                        whole.append(np.full(run["n"], run["whole"]))
                begin, doc, whole = map(np.concatenate, (begin, doc, whole))
                win = s.digests(begin, begin + window)
                yield pd.DataFrame({
                    "win1": win[:, 0], "win2": win[:, 1], "key1": part["key1"].to_numpy()[doc], "key2": part["key2"].to_numpy()[doc],
                    "at": begin - s.first[doc], "whole": whole,
                })

    return staged(rows.mapInPandas(cut, "win1 long, win2 long, key1 long, key2 long, at int, whole boolean"))


def remove(docs: DataFrame, spans: DataFrame, text: str) -> DataFrame:
    """All rows and columns of ``docs`` without the words in the spans (key1, key2, first, end) of their text; adds ``n_words`` and ``n_removed``.

    The kept words are joined by one space, also where nothing is removed. Null texts stay null with no words. Columns named as the new
    ones are replaced.
    """
    new = ["n_words", "n_removed"]
    base = docs.drop(*new)
    k1, k2, runs, cut = (fresh(base, n) for n in ("_key1", "_key2", "_runs", "_cut"))
    merged = staged(spans.groupBy(*KEY).agg(F.collect_set(F.struct("first", "end")).alias("runs")))
    t = F.col(text)
    rows = base.withColumn(k1, F.xxhash64(t)).withColumn(k2, F.xxhash64(F.lit(1), t))
    rows = rows.join(merged.toDF(k1, k2, runs), [k1, k2], "left")

    @F.pandas_udf("n_words long, n_removed long, text string")
    def kept(texts: pd.Series, all_runs: pd.Series) -> pd.DataFrame:
        out = []
        for value, own in zip(texts, all_runs, strict=True):
            if value is None:
                out.append((0, 0, None))
                continue
            words = value.encode("utf-8", "replace").split()
            if own is None:
                out.append((len(words), 0, b" ".join(words).decode()))
                continue
            gone = covered(len(words), [(r["first"], r["end"]) for r in own])
            left = b" ".join([words[i] for i in np.flatnonzero(~gone)])
            out.append((len(words), int(gone.sum()), left.decode()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "text"])

    rows = rows.withColumn(cut, kept(t, F.col(runs)))
    return rows.select(*[F.col(cut)["text"].alias(c) if c == text else F.col(f"`{c}`") for c in base.columns], *[F.col(cut)[c].alias(c) for c in new])
