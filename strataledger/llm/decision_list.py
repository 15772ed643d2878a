"""Quality rules: base statistics of a text and a learned decision list over them.

The list is learned by sequential covering on labelled statistics: a rule is grown, condition by condition, as a
conjunction of thresholds that best separates the bad rows left; it is pruned on held-out rows, kept if it still tells bad from good, and
the rows it covers are taken out before the next. The result is an ordered list of Spark conditions. All text work is done with built-in
functions; the fit runs on a bounded sample of numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, words

#: Fixed value: symbol characters of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = ["n_words", "chars_per_word", "symbols_per_char", "dup_lines_per_line", "repeat_share", "upper_share", "digit_share",
            "mark_share", "words_per_line", "distinct_share"]


def _same_as_neighbour(sorted_pairs: Column) -> Column:
    """Positions, ascending, of the (h, at) pairs whose h stands at least twice in the sorted array."""
    n = F.size(sorted_pairs)

    def h(i: Column) -> Column:
        return F.get(sorted_pairs, i)["h"]

    dup = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (h(i) == h(i - 1)) | (h(i) == h(i + 1)))
    return F.array_sort(F.transform(dup, lambda i: F.get(sorted_pairs, i)["at"]))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with a struct ``stats`` of whole-text statistics; null texts count as empty.

    Base numbers are longs (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), the others shares. Repeated windows are
    found by sorting 64-bit hashes of five words within a text, so a text costs its length times a logarithm.
    """
    base = docs.drop("stats")
    names = ["_t", "_words", "_w", "_win", "_at", "_lines"]
    t, tokens, w, win, at, lines = (fresh(base, n) for n in names)
    out = base.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn(tokens, words(F.col(t)))
    out = out.withColumn(w, F.transform(F.col(tokens), lambda x: F.xxhash64(x)))
    out = out.withColumn(lines, F.filter(F.split(F.col(t), "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0))
    n = F.size(w)
    hashes = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(WINDOW)])
    )
    out = out.withColumn(win, F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
    pairs = F.array_sort(F.transform(F.col(win), lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    some = F.size(F.array_distinct(win)) < F.size(win)
    out = out.withColumn(at, F.when(some, pairs))
    out = out.withColumn(at, F.when(F.col(at).isNotNull(), _same_as_neighbour(F.col(at))))
    fill = F.aggregate(
        F.col(at), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"), p.alias("last")),
    )["n"]

    def number_of(marks: str) -> Column:
        return F.size(F.split(F.col(t), marks)) - 1

    # numbers that several statistics share are columns of their own, computed once
    shared = {
        "chars": F.length(F.array_join(F.col(tokens), "")), "symbols": number_of(f"[{SYMBOLS}]"), "digits": number_of("[0-9]"),
        "uppers": number_of("[A-Z]"), "marks": number_of(r"[!?*#$%&|<>{}\[\]=_~^@+/\\]"), "distinct": F.size(F.array_distinct(w)),
        "dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "repeated": F.coalesce(fill, F.lit(0).cast("long")),
        "words": n, "lines": F.size(lines),
    }
    names = {k: fresh(base, f"_n_{k}") for k in shared}
    out = out.withColumns({names[k]: c for k, c in shared.items()})
    x = {k: F.col(c) for k, c in names.items()}
    per_char, per_word, per_line = (F.greatest(x[k], F.lit(1)) for k in ("chars", "words", "lines"))
    stats = {
        "n_words": x["words"].cast("long"), "word_chars": x["chars"].cast("long"), "n_symbols": x["symbols"].cast("long"),
        "n_dup_lines": x["dup_lines"].cast("long"), "n_repeat_words": x["repeated"],
        "chars_per_word": x["chars"] / per_word, "symbols_per_char": x["symbols"] / per_char, "dup_lines_per_line": x["dup_lines"] / per_line,
        "repeat_share": x["repeated"] / per_word, "upper_share": x["uppers"] / per_char, "digit_share": x["digits"] / per_char,
        "mark_share": x["marks"] / per_char, "words_per_line": x["words"] / per_line, "distinct_share": x["distinct"] / per_word,
    }
    # the one-element explode keeps later filters on the statistics from being pushed into, and repeating, their computation
    out = out.withColumn("stats", F.explode(F.array(F.struct(*[c.alias(k) for k, c in stats.items()]))))
    return out.select(*[F.col(f"`{c}`") for c in base.columns], "stats")


def base_failed(stats: Column, min_words: int = 10, repeat_percent: int = 20) -> Column:
    return (stats["n_words"] < min_words) | (100 * stats["n_repeat_words"] > repeat_percent * stats["n_words"])


@dataclass
class Rule:
    """A conjunction of (feature, 'above' or 'below', threshold); rows that meet all are bad."""

    conditions: list[tuple[str, str, float]] = field(default_factory=list)
    bad: int = 0
    good: int = 0

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        hit = np.ones(len(x), bool)
        for name, side, at in self.conditions:
            v = x[:, names.index(name)]
            hit &= v > at if side == "above" else v <= at
        return hit

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for name, side, at in self.conditions:
            out = out & ((stats[name] > at) if side == "above" else (stats[name] <= at))
        return out


def _grow(x, bad, names, max_conditions):
    rule, hit = Rule(), np.ones(len(x), bool)
    while len(rule.conditions) < max_conditions and (hit & ~bad).any():
        p0, n0 = (hit & bad).sum(), (hit & ~bad).sum()
        best = None
        for j, name in enumerate(names):
            v, y = x[hit, j], bad[hit]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            cut = np.flatnonzero(v[1:] > v[:-1])  # a threshold lies between two different values
            if not len(cut):
                continue
            p_low = np.cumsum(y)[cut].astype(float)
            n_low = (cut + 1) - p_low
            for side, p, n in (("below", p_low, n_low), ("above", p0 - p_low, n0 - n_low)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - log2(p0 / (p0 + n0))), -np.inf)
                i = int(gain.argmax())
                if gain[i] > 1e-9 and (best is None or gain[i] > best[0]):
                    best = (gain[i], name, side, float((v[cut[i]] + v[cut[i] + 1]) / 2))
        if best is None:
            break
        rule.conditions.append(best[1:])
        hit = rule.covers(x, names)
    return rule


def _prune(rule, x, bad, names):
    """Drops last conditions while that does not lower (bad - good) / (bad + good) on held-out rows."""

    def worth(r):
        hit = r.covers(x, names)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    shorter = [Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)]
    return max(shorter, key=worth) if shorter else rule


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], max_rules: int = 12, max_conditions: int = 4,
          purity: float = 0.95, min_cover: int = 5) -> list[Rule]:
    """Ordered rules for bad rows by sequential covering; every third row is held out for pruning.

    A rule is kept only if at least ``purity`` of the rows it covers, and ``min_cover`` rows, are bad: good documents stay.
    """
    rules, left = [], np.ones(len(x), bool)
    held = np.arange(len(x)) % 3 == 2
    while len(rules) < max_rules and (left & ~held & bad).any():
        g, p = left & ~held, left & held
        rule = _prune(_grow(x[g], bad[g], names, max_conditions), x[p], bad[p], names)
        if not rule.conditions:
            break
        hit = rule.covers(x, names) & left
        rule.bad, rule.good = int((hit & bad).sum()), int((hit & ~bad).sum())
        if rule.bad < max(min_cover, purity * (rule.bad + rule.good)):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, limit: int = 4_000, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality") -> list[Rule]:
    """Rules learned from labelled documents (label 0 is bad, 1 is good, others and nulls are left out).

    The sample is bounded: the ``limit`` labelled rows with the lowest hashes of their ids, chosen before any text is read. Only their
    numbers come to the driver. Ids with labels that differ are left out; without both kinds of rows the list is empty.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y")).where("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
    known = known.orderBy(F.xxhash64("id"), "id").limit(limit).select("id", "y")  # a bounded sample: broadcast
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
    rows = statistics(rows).select("id", "y", *[F.col("stats")[f].cast("double").alias(f) for f in FEATURES])
    got = rows.groupBy("id", "y").agg(*[F.max(f).alias(f) for f in FEATURES]).orderBy(F.xxhash64("id"), "id").limit(limit).collect()
    x = np.array([[r[f] for f in FEATURES] for r in got], float).reshape(-1, len(FEATURES))
    bad = np.array([r["y"] == 0 for r in got], bool)
    return learn(x, bad, FEATURES) if bad.any() and not bad.all() else []


def verdict(stats: Column, rules: list[Rule]) -> Column:
    """True if no rule of the list holds: an ordered conditional expression."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.column(stats), F.lit(False)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``stats``, ``base_failed`` and ``kept``; columns of these names are replaced.

    Null, empty and blank texts fail the base rules; repeated rows stay; an empty table gives an empty one.
    """
    out = statistics(docs.drop("base_failed", "kept"), text)
    out = out.withColumn("base_failed", base_failed(F.col("stats")))
    return out.withColumn("kept", ~F.col("base_failed") & verdict(F.col("stats"), rules))
