"""Benchmark decontamination by template canonicalisation.

Texts become token streams in which numbers, units and names are typed placeholders and other words are lower-case
without punctuation. Windows are hashed, as templates and as plain words, since what is a name depends on capitals and on
the place in a sentence; those that also occur in the benchmark are joined with it on
hash and template. Along each run of windows a name must stay one name; changed values count as found only where they map one to one,
unchanged words always. So a question with other names and numbers is found, and a text that only has the same shape is not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, staged

#: Units that count as such after a number.
UNITS = """% percent kg g mg lb lbs oz ton tons tonne tonnes km m cm mm mile miles yard yards foot feet ft inch inches in
l ml litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months
year years dollar dollars euro euros pound pounds cent cents usd eur gbp kmh mph degree degrees celsius fahrenheit kb mb gb tb""".split()
PUNCTUATION = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "%"]
NUM, UNIT, NAME, BOTH = "<num>", "<unit>", "<name>", "<num+unit>"
STEP, CHARS = np.uint64(0x9E3779B97F4A7C15), 1 << 20
_TABLE = np.random.default_rng(7).integers(1, 2**63, 4096, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, STEP, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_INVERSE = np.uint64(pow(int(STEP), -1, 2**64))


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _hash_words(codes: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """A hash of each word's characters; ``word`` is the ascending word number of every character."""
    size = np.bincount(word, minlength=n)
    ends = np.cumsum(size)
    at = np.arange(len(codes)) - np.repeat(ends - size, size)
    longest = int(size.max(initial=0))
    terms = _mix(_TABLE[codes & 4095] + codes.astype(np.uint64) * STEP) * _powers(longest)[at]
    total = np.concatenate(([np.uint64(0)], np.cumsum(terms, dtype=np.uint64)))
    return _mix(total[ends] - total[ends - size] + size.astype(np.uint64))


_KNOWN = {}


def _hash_of(word: str) -> np.uint64:
    if word not in _KNOWN:
        codes = np.array([ord(c) for c in word], np.uint32)
        _KNOWN[word] = _hash_words(codes, np.zeros(len(codes), np.int64), 1)[0]
    return _KNOWN[word]


class Stream:
    """Template tokens of several texts as arrays: ``doc`` of each token, ``kind`` (0 literal), ``hash``, ``plain`` (that of the word itself), and its characters on demand."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts)
        self.low = _lower(joined)
        a = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.frombuffer(self.low.encode("utf-32-le", "surrogatepass"), np.uint32)
        blank = (low == 32) | ((low >= 9) & (low <= 13))
        kept = ~blank & ~np.isin(low, np.array([ord(c) for c in PUNCTUATION], np.uint32))
        starts = ~blank & np.concatenate(([True], blank[:-1])) if len(a) else np.zeros(0, bool)
        raw = np.cumsum(starts) - 1  # word number of every character
        n_raw = int(starts.sum())
        first_raw = np.flatnonzero(starts)
        last_raw = np.flatnonzero(~blank & np.concatenate((blank[1:], [True]))) if len(a) else first_raw
        sizes = np.bincount(raw[kept], minlength=n_raw)
        here = np.flatnonzero(sizes > 0)  # words that keep a character
        number = np.full(n_raw, -1)
        number[here] = np.arange(len(here))
        word, codes = number[raw[kept]], low[kept]
        self.hash = _hash_words(codes, word, len(here))
        n = len(here)
        begin = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=n))))[:-1].astype(int)
        digit = (codes >= 48) & (codes <= 57)
        digits = np.bincount(word[digit], minlength=n)
        upper = (a != low)[kept]
        ups = np.bincount(word[upper], minlength=n)
        self.first, self.last = first_raw[here], last_raw[here]
        self.kind, self.plain = np.zeros(n, np.int8), self.hash.copy()
        if n:
            size = sizes[here]
            number = digits == size
            mixed = digit[begin] & ~number
            after = np.concatenate(([False], number[:-1] | mixed[:-1]))
            unit = after & np.isin(self.hash, np.array([_hash_of(u) for u in UNITS], np.uint64)) & ~number
            # a name: a capital and lower-case letters, not where a sentence or line begins
            before = np.concatenate(([ord("\n")], low))[self.first]
            closer = np.isin(np.concatenate(([ord(".")], low[self.last[:-1]])), np.array([ord(c) for c in ".!?:"], np.uint32))
            name = upper[begin] & (ups < size) & (before != ord("\n")) & ~closer
            for k, (mask, mark) in enumerate(((name, NAME), (unit, UNIT), (mixed, BOTH), (number, NUM)), 1):
                self.kind[mask] = k
                self.hash[mask] = _hash_of(mark)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.doc = np.searchsorted(offsets, self.first, "right") - 1

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First tokens, hashes and whether it is a template's hash, of all windows that lie in one text.

        Every window has the hash of its plain words; one with a literal in at least half its places has that of its template as well.
        """
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0, bool)
        literals = np.concatenate(([0], np.cumsum(self.kind == 0)))
        literals = literals[size:] - literals[:n]
        inside = self.doc[:n] == self.doc[size - 1 :]
        shaped = inside & (2 * literals >= size) & (literals < size)
        out = []
        for mask, hashes, template in ((inside, self.plain, False), (shaped, self.hash, True)):
            h = np.zeros(n, np.uint64)
            for j in range(size):
                h = h * STEP + hashes[j : j + n]
            out.append((np.flatnonzero(mask), _mix(h)[mask], np.full(int(mask.sum()), template)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def word(self, i: int) -> str:
        return "".join(c for c in self.low[self.first[i] : self.last[i] + 1] if c not in PUNCTUATION)

    def template(self, i: int, size: int, shaped: bool) -> tuple[str, list[str]]:
        """The template and the placeholders' values, or the plain words and no values; words have no punctuation, so the two never agree."""
        marks = ("", NAME, UNIT, BOTH, NUM)
        at = range(i, i + size)
        if not shaped:
            return " ".join(self.word(j) for j in at), []
        return " ".join(marks[self.kind[j]] or self.word(j) for j in at), [self.word(j) for j in at if self.kind[j]]


def _parts(pdf: pd.DataFrame, text: str) -> Iterator[pd.DataFrame]:
    """Row ranges of about CHARS characters; a longer text is a range of its own."""
    size = pdf[text].str.len().fillna(0)
    for _, part in pdf.groupby((size.cumsum() // CHARS).to_numpy(), sort=False):
        yield part


def benchmark_windows(benchmark: DataFrame, size: int, least: int, item_id: str, text: str) -> DataFrame:
    """(item_id, n, at, len, h, template, slots) of every window; an item shorter than a window is one window, below ``least`` tokens none."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for item, t in zip(pdf["item_id"], pdf["text"], strict=True):
                s = Stream([t or ""])
                n = len(s.hash)
                k = min(size, n)
                if n >= least:
                    at, h, shaped = s.windows(k)
                    out += [(item, n, int(i), k, int(x), *s.template(i, k, m)) for i, x, m in zip(at, h.astype(np.int64), shaped, strict=True)]
            yield pd.DataFrame(out, columns=["item_id", "n", "at", "len", "h", "template", "slots"])

    kind = dict(benchmark.dtypes)[item_id]
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return rows.mapInPandas(cut, f"item_id {kind}, n int, at int, len int, h long, template string, slots array<string>")


def _held(windows) -> list[int]:
    """The item's tokens that the windows of one alignment hold, judged by runs: windows that meet or overlap.

    A window with the item's own values always counts. Of the others go those that have not the name which the run mostly has for a name of the
    item. If the values left map one to one, all their tokens count, else (numbers that fall together or apart) the unchanged ones.
    """
    runs, end = [], None
    for w in sorted(windows, key=lambda w: (w["at"], w["template"], list(w["slots"]))):
        at, marks = w["at"], w["template"].split(" ")
        places = [at + j for j, m in enumerate(marks) if m in (NAME, UNIT, BOTH, NUM)] if len(w["own"]) else []
        slots = [(p, marks[p - at], a, b) for p, a, b in zip(places, w["own"], w["slots"], strict=True)]
        if end is None or at > end:
            runs.append([])
        end = max(end or 0, at + w["len"])
        runs[-1].append((set(range(at, at + w["len"])), slots))
    tokens = set()
    for run in runs:
        votes = Counter((a, b) for _, m, a, b in dict.fromkeys(x for _, slots in run for x in slots) if m == NAME)
        best = {}
        for (a, b), n in votes.items():
            if n > votes[a, best.get(a)]:
                best[a] = b
        kept = [(own, slots) for own, slots in run if all(m != NAME or best[a] == b for _, m, a, b in slots)]
        pairs = {x[1:] for _, slots in kept for x in slots}
        single = len({x[:2] for x in pairs}) == len({(m, b) for m, _, b in pairs}) == len(pairs)
        for own, slots in kept:
            tokens |= own if single else own - {p for p, _, a, b in slots if a != b}
        for own, slots in run:
            if all(a == b for _, _, a, b in slots):
                tokens |= own
    return sorted(tokens)


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 8, enough: int = 13, least: int = 4, block: int = 4_000_000,
            doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, key1, key2, item_id, n_matched, n_item) of documents that hold a passage of a benchmark item.

    A document holds an item if consistent windows cover ``enough`` of the item's tokens, or half of them where that is
    less. ``key1`` and ``key2`` are hashes of the text. All windows of all texts are looked up by
    their plain lower-case words and, unless they have too few literals, by their template; the benchmark's hashes go to the
    tasks in blocks of at most ``block`` (32 MB), one pass over the documents for each. Null and blank texts match nothing; repeated rows of one
    id and text are one row of the result; items below ``least`` tokens cannot be told from chance and match nothing.
    """
    spark = docs.sparkSession
    bench = staged(benchmark_windows(benchmark, size, least, item_id, item_text))
    n, lengths = bench.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("len"))).first()
    doc_kind = dict(docs.dtypes)[doc_id]
    schema = "doc_id string, key1 long, key2 long, pos int, h long, template string, slots array<string>"
    rows = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"), F.xxhash64(text).alias("key1"), F.xxhash64(F.lit(1), F.col(text)).alias("key2"), F.col(text).alias("text")
    ).where("text is not null")
    blocks = max(1, -(-n // block))
    found = []
    for b in range(blocks):
        own = bench.where(F.pmod("h", F.lit(blocks)) == b).select("h").distinct()
        wanted = np.sort(own.toArrow()["h"].to_numpy().view(np.uint64))
        sent = spark.sparkContext.broadcast(wanted)
        found.append(rows.mapInPandas(_looker(sent, list(lengths or [])), schema))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    hits = staged(hits)
    met = hits.join(bench.withColumnRenamed("slots", "own"), ["h", "template"]).withColumn("shift", F.col("pos") - F.col("at"))
    row = ["doc_id", "key1", "key2", "item_id"]
    # one alignment has at most one window for each token of the item
    aligned = met.groupBy(*row, "n", "shift").agg(F.collect_set(F.struct("at", "len", "template", "own", "slots")).alias("windows"))
    held = F.pandas_udf(lambda windows: windows.map(_held), "array<int>")
    covered = aligned.select(*row, "n", held("windows").alias("tokens")).select(*row, "n", F.explode("tokens").alias("token")).distinct()
    per = covered.groupBy(*row).agg(F.count(F.lit(1)).cast("int").alias("n_matched"), F.max("n").alias("n_item"))
    per = per.where(F.col("n_matched") >= F.least(F.lit(enough), F.ceil(F.col("n_item") / 2)))
    return per.withColumn("doc_id", F.col("doc_id").cast(doc_kind))


def _looker(sent, lengths: list[int]):
    """Finds the windows of texts whose hash is one of the sent ones."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = sent.value
        near = np.zeros(1 << 20, bool)
        near[(wanted >> np.uint64(44)).astype(int)] = True
        for pdf in batches:
            for part in _parts(pdf, "text"):
                texts = part["text"].tolist()
                s, out = Stream(texts), []
                begins = np.searchsorted(s.doc, np.arange(len(texts)))
                for size in lengths if len(wanted) else []:
                    at, h, shaped = s.windows(size)
                    hit = near[(h >> np.uint64(44)).astype(int)]
                    at, h, shaped = at[hit], h[hit], shaped[hit]
                    hit = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
                    for i, x, m in zip(at[hit], h[hit].astype(np.int64), shaped[hit], strict=True):
                        d = s.doc[i]
                        out.append((int(d), int(i - begins[d]), int(x), *s.template(i, size, m)))
                hits = pd.DataFrame(out, columns=["d", "pos", "h", "template", "slots"])
                ids = part[["doc_id", "key1", "key2"]].reset_index(drop=True)
                got = ids.iloc[hits["d"].to_numpy(int)].reset_index(drop=True)
                yield pd.concat([got, hits.drop(columns="d")], axis=1)

    return look


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no passage of the benchmark; null texts stay."""
    bad = staged(matches(docs, benchmark, doc_id=doc_id, text=text, **options).select("key1", "key2").distinct())
    a, b = fresh(docs, "_key1"), fresh(docs, "_key2")
    keyed = docs.withColumn(a, F.xxhash64(text)).withColumn(b, F.xxhash64(F.lit(1), F.col(text)))
    return keyed.join(bad.toDF(a, b), [a, b], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
