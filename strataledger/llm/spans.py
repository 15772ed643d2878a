"""Word windows of many texts as arrays: positions, gram hashes, minimisers, and exact digests of word spans.

Hashes of grams only choose positions and bring candidates together; what counts as equal is decided by 128-bit digests of the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash

CHARS = 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """The words of several texts, joined by single spaces; ``starts`` and ``ends`` in bytes, ``doc`` of every word."""

    def __init__(self, texts: list[str | None]):
        split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
        self.counts = np.array([len(w) for w in split], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.n = int(self.first[-1])
        self.data = b" ".join([w for ws in split for w in ws])
        gaps = np.flatnonzero(np.frombuffer(self.data, np.uint8) == 32)
        self.starts = np.concatenate(([0], gaps + 1)) if self.n else np.zeros(0, int)
        self.ends = np.concatenate((gaps, [len(self.data)])) if self.n else np.zeros(0, int)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def word_hashes(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.uint64)
        size = self.ends - self.starts
        powers = np.full(int(size.max()) + 1, STEP, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        at = np.arange(len(self.data)) - np.repeat(self.starts, np.append(size[:-1] + 1, size[-1]))
        codes = np.frombuffer(self.data, np.uint8)
        terms = _TABLE[codes] * powers[np.minimum(at, len(powers) - 1)]
        total = np.concatenate(([np.uint64(0)], np.cumsum(terms, dtype=np.uint64)))
        return mixed(total[self.ends] - total[self.starts] + size.astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all runs of so many words, those over a text's end included (callers leave these out)."""
        h = self.word_hashes()
        n = max(0, len(h) - size + 1)
        out = np.zeros(n, np.uint64)
        for j in range(size):
            out = out * STEP + h[j : j + n]
        return mixed(out)

    def digests(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """128-bit digests of the words a to b - 1 (not empty), as two columns of longs."""
        data, digest = self.data, xxhash.xxh3_128_digest
        raw = b"".join([digest(data[i:j]) for i, j in zip(self.starts[a].tolist(), self.ends[b - 1].tolist(), strict=True)])
        return np.frombuffer(raw, ">i8").astype(np.int64).reshape(-1, 2)

    def segments(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor's hash, first word, windows) of every run of windows, within a text, that have one minimiser.

        A window's minimiser is the leftmost smallest gram in it, so equal windows have equal minimisers in the same place.
        """
        n = self.n - window + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        g = self.grams(gram)
        at = sliding_argmin(g, window - gram + 1)[:n]
        ok = self.doc[:n] == self.doc[window - 1 :]
        new = ok & np.concatenate(([True], (at[1:] != at[:-1]) | ~ok[:-1]))
        begin = np.flatnonzero(new)
        # a run ends where the next begins or where windows leave their text
        stop = np.flatnonzero(ok & np.concatenate((new[1:] | ~ok[1:], [True]))) + 1
        return g[at[begin]].astype(np.int64), begin, stop - begin


def sliding_argmin(v: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value in every run of ``width`` values, by doubling."""
    at, size = np.arange(len(v)), 1
    while size < width:
        step = min(size, width - size)
        a, b = at[:-step], at[step:]
        at = np.where(v[a] <= v[b], a, b)
        size += step
    return at


def parts(pdf: pd.DataFrame, text: str = "text") -> Iterator[pd.DataFrame]:
    """Row ranges of about CHARS characters; a longer text is a range of its own."""
    size = pdf[text].str.len().fillna(0)
    for _, part in pdf.groupby((size.cumsum() // CHARS).to_numpy(), sort=False):
        yield part


def covered(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which of n words lie in one of the (first, end) spans."""
    edge = np.zeros(n + 1, np.int64)
    for a, b in spans:
        edge[a] += 1
        edge[b] -= 1
    return np.cumsum(edge[:-1]) > 0
