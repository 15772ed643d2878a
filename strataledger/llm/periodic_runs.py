"""Periodic runs of words (a stretch repeated several times over), by multi-scale minimizers, and their collapse.

A run is a longest stretch whose words a period apart are equal, at least ``least`` words and ``times`` periods long. At each scale, for periods
from w/2 + 1 to w, a gram is w words long, so at least a period. Two equal grams inside a run then lie a multiple of the period
apart, since otherwise the run had a smaller one. A window of w/2 grams and the one a period later hold the same grams, so the
minimum of the first and of the second lie exactly a period apart, and nothing equal lies between: every run shows as two neighbouring
places of one minimizer, whatever its length. Such pairs are seeds, extended to both sides word by word. Periods up to ``short`` come
from a direct scan of each lag. Seeds only propose; equality is that of the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .spans import STEP, covered, mixed, parts, sliding_argmin

SHORT = 8


def stretch(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """(first, end) of the longest range around ``at`` in which words equal those a lag later; doubling steps, so linear in its length."""
    n = len(ids) - lag

    def equal(step: int) -> int:
        """Number of equal words from ``at`` on, to the right or (step -1) from the one before on to the left."""
        done, size = 0, 64
        while True:
            if step > 0:
                a, b = at + done, min(at + done + size, n)
                same = ids[a:b] == ids[a + lag : b + lag]
            else:
                a, b = max(at - done - size, 0), at - done
                same = (ids[a:b] == ids[a + lag : b + lag])[::-1]
            if not len(same):
                return done
            if not same.all():
                return done + int(same.argmin())
            done += len(same)
            size *= 2

    return at - equal(-1), at + equal(1)


def seeds(ids: np.ndarray, longest: int, short: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, lags) of neighbouring equal minimizers, scale by scale, for periods above ``short`` in texts of up to ``longest`` words."""
    h = mixed(ids.astype(np.uint64) * STEP + np.uint64(1))
    low = short
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(ids), STEP, np.uint64))), dtype=np.uint64)
        # sum of h[i] * STEP^(n - i), so that a gram's hash is a difference brought to one power
        total = np.concatenate(([np.uint64(0)], np.cumsum(h * powers[len(ids) : 0 : -1], dtype=np.uint64)))
    while times * (low + 1) <= longest:
        w = 2 * low
        n = len(ids) - w + 1
        if n < 2:
            return
        with np.errstate(over="ignore"):
            grams = mixed((total[w:] - total[:n]) * powers[:n])
        # a window is no longer than the smallest period of the scale
        at = np.unique(sliding_argmin(grams, low + 1)) if n > low else np.arange(n)
        order = at[np.argsort(grams[at], kind="stable")]
        a, b = order[:-1], order[1:]
        near = (grams[a] == grams[b]) & (b - a > low) & (b - a <= w)
        yield a[near], (b - a)[near]
        low = w


def runs(ids: np.ndarray, longest: int | None = None, least: int = 6, times: int = 4, short: int = SHORT) -> np.ndarray:
    """(start, length, period) of every run in a sequence of word numbers, by start, then period; ``longest``: no run is longer."""
    if times < 4:
        raise ValueError("minimizers meet a period apart for certain only in runs of four periods or more")
    longest = len(ids) if longest is None else longest
    found: dict[tuple[int, int], int] = {}

    def keep(first: int, end: int, lag: int) -> None:
        """A range of equal words with those a lag later is a stretch of lag more words; of its periods the smallest counts."""
        size = end - first + lag
        if size >= max(least, times * lag):
            found[first, size] = min(lag, found.get((first, size), lag))

    for lag in range(1, min(short, longest // max(times, 1)) + 1):
        same = np.concatenate(([False], ids[lag:] == ids[:-lag], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        first, end = edge[::2], edge[1::2]
        wide = end - first + lag >= max(least, times * lag)
        for a, b in zip(first[wide].tolist(), end[wide].tolist(), strict=True):
            keep(a, b, lag)
    for at, lags in seeds(ids, longest, short, times):
        order = np.lexsort((at, lags))
        done, last = -1, -1
        for p, lag in zip(at[order].tolist(), lags[order].tolist(), strict=True):
            if lag == last and p < done:
                continue  # inside the range just extended
            first, done = stretch(ids, p, lag)
            last = lag
            keep(first, done, lag)
    out = sorted((first, size, lag) for (first, size), lag in found.items())
    return np.array(out, np.int64).reshape(-1, 3)


def numbers(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of the texts, one sequence of word numbers with a number of its own after each text, and each text's place in it."""
    split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    seen: dict[bytes, int] = {}
    ids, begin = [], []
    for i, own in enumerate(split):
        begin.append(len(ids))
        ids.extend([seen.setdefault(w, len(seen)) for w in own])
        ids.append(-1 - i)
    return split, np.array(ids, np.int64), np.array(begin, np.int64)


SHAPE = "n_words long, n_removed long, runs array<struct<start: long, length: long, period: long>>, text string"


def collapse(docs: DataFrame, text: str = "text", least: int = 6, times: int = 4, out: str = "periodic") -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``out``; a column of that name is replaced.

    ``runs`` are a text's runs by start, then period; ``text`` its words, joined by one blank, without those that stand behind the first period of any
    run; ``n_words`` and ``n_removed`` count them. Overlapping runs of different periods are all listed, equal stretches once with the smallest period.

    Null texts have no words, no runs and an empty text, as have empty and blank ones. Texts are read whole: several short ones together, a long one by
    itself; time grows with the length times its logarithm squared. Repeated rows are rows like others. An empty table gives an empty
    one. No shuffle: a row's result comes from its text alone.
    """

    def of(texts: list[str | None]) -> list[tuple]:
        split, ids, begin = numbers(texts)
        got = runs(ids, max((len(w) for w in split), default=0), least, times)
        owner = np.searchsorted(begin, got[:, 0], "right") - 1
        got[:, 0] -= begin[owner]
        cut = np.searchsorted(owner, np.arange(len(texts) + 1))
        rows = []
        for i, words in enumerate(split):
            own = got[cut[i] : cut[i + 1]].tolist()
            if own:
                gone = covered(len(words), [(a + q, a + n) for a, n, q in own])
                left = [words[k] for k in np.flatnonzero(~gone)]
            else:
                left = words
            rows.append((len(words), len(words) - len(left), [tuple(r) for r in own], b" ".join(left).decode("utf-8", "surrogatepass")))
        return rows

    @F.pandas_udf(SHAPE)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = [r for part in parts(texts.to_frame("text")) for r in of(part["text"].tolist())]
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "runs", "text"])

    base = docs.drop(out)
    held = fresh(base, "_found")
    return base.withColumn(held, found(F.col(text))).withColumnRenamed(held, out)
