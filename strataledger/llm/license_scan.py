"""Licence scan: notice phrases and identifier tags by Aho-Corasick, licence expressions by a shunting-yard parser.

A text's words are runs of letters, digits and non-ASCII characters, A-Z in lower case. One automaton finds all phrases in one pass over the
words joined by single blanks; a tag's words are phrases too, and only texts that hold one are searched for the tag as it is written,
by a second automaton. Behind a tag stands an expression such as ``(MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND CC-BY-4.0``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Notice phrases, in words, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    **BASE,
    "apache license": "apache", "apache 2 0": "apache", "mit license": "mit", "permission is hereby granted free of charge to any person": "mit",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "isc license": "isc", "mozilla public license": "mpl",
    "eclipse public license": "epl", "lesser general public license": "lgpl", "affero general public license": "agpl",
    "creative commons attribution": "cc-by", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by nc": "cc-by-nc", "creative commons zero": "cc0",
    "cc0": "cc0", "dedicated to the public domain": "public-domain", "free and unencumbered software released into the public domain": "public-domain",
    "may not be reproduced": "reserved", "reproduction is prohibited": "reserved", "proprietary and confidential": "reserved",
}
#: Tags before an expression, as written (in lower case).
TAGS = ("spdx-license-identifier:", "license-expression:")
#: What a label restricts, from 0 (nothing) to 1 (all). Identifiers take the label that is their longest beginning.
RESTRICTION = {
    "public-domain": 0.05, "cc0": 0.05, "unlicense": 0.05, "0bsd": 0.05, "mit": 0.2, "bsd": 0.2, "isc": 0.2, "zlib": 0.2, "apache": 0.25, "cc-by": 0.3,
    "mpl": 0.5, "epl": 0.5, "lgpl": 0.5, "cc-by-sa": 0.6, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.85, "cc-by-nc": 0.9, "other": 0.9, "reserved": 1.0,
}
WEAK = 0.5  # an exception lowers a copyleft licence to this
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9](?:[A-Za-z0-9+\-]|[.:](?=[A-Za-z0-9]))*+(?!:))")
#: Bytes that belong to no word become blanks.
FLAT = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 0x80 else 32 for c in range(256))


def label_of(identifier: str) -> str:
    """The label of a licence identifier: ``GPL-2.0-or-later`` and ``gpl-3.0+`` are ``gpl``; unknown ones are ``other``."""
    name = identifier.lower().rstrip("+")
    cut = name
    while cut and cut not in RESTRICTION:
        cut = cut.rpartition("-")[0]
    return cut if cut not in ("", "reserved", "public-domain") else "other"


def postfix(text: str, at: int = 0) -> tuple[list[str], int, bool]:
    """(postfix order, end, whole) of the longest expression that begins at ``at``; the list is empty if none does.

    ``with`` binds closest, then ``and``, then ``or``; equal ones from left to right. Reading ends where a token does not fit. Open
    brackets are closed there and operators without a right side dropped; then ``whole`` is false.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand, end = True, at
    while got := TOKEN.match(text, at):
        token = got[1]
        word = token.lower()
        if operand:
            if token == ")" or word in BINDS:
                break
            if token == "(":
                waiting.append(token)
            else:
                out.append(token)
                operand = False
        elif token == ")":
            if "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif word in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = True
        else:
            break
        at = got.end()
        end = at if out else end
    whole = bool(out) and not operand and "(" not in waiting
    while operand and waiting:  # what still lacks its right side
        if waiting.pop() != "(":
            operand = False
    return out + [w for w in reversed(waiting) if w != "("] if out else [], end, whole


def evaluate(order: list[str]) -> tuple[float, list[str], list[str], bool]:
    """(restriction, labels chosen, labels named, sound) of a postfix expression.

    ``and`` binds to both sides: the stricter counts. ``or`` leaves the choice: the freer side counts, both if equal. ``with`` and an identifier
    that names an exception lower a copyleft licence to a weak one; any other right side changes nothing and is not ``sound``.
    """
    stack: list[tuple[float, frozenset, str]] = []
    named, sound = set(), True
    for i, token in enumerate(order):
        if token not in BINDS:
            label = label_of(token)
            stack.append((RESTRICTION[label], frozenset([label]), token))
            if not (i + 1 < len(order) and order[i + 1] == "with"):
                named.add(label)
            continue
        (b, right, name), (a, left, own) = stack.pop(), stack.pop()
        if token == "with":
            known = "exception" in name.lower()
            sound &= known
            stack.append((min(a, WEAK) if known else a, left, own))
        elif token == "and":
            stack.append((max(a, b), left | right, own))
        else:
            stack.append((min(a, b), left | right if a == b else left if a < b else right, own))
    value, chosen, _ = stack[-1]
    return value, sorted(chosen), sorted(named), sound


def automaton(patterns: Mapping[str, object] | dict) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        made.add_word(pattern, value)
    made.make_automaton()
    return made


class Scanner:
    def __init__(self, notices: Mapping[str, str]):
        said = {f" {p} ": (len(p.split()), p, label) for p, label in notices.items()}
        for tag in TAGS:
            own = " ".join(tag.encode().translate(FLAT).decode().split())
            said[f" {own} "] = (0, None, None)
        self.phrases = automaton(said)
        self.tags = automaton({t: len(t) for t in TAGS})

    def scan(self, text: str | None) -> tuple:
        lower = (text or "").encode("utf-8", "surrogatepass").lower()
        flat = b" %b " % b" ".join(lower.translate(FLAT).split())
        n_words = flat.count(b" ") - 1 if len(flat) > 2 else 0
        places, tagged, seen, gaps = [], False, 0, 0
        for end, (size, phrase, label) in self.phrases.iter(flat.decode("latin-1")):
            if phrase is None:
                tagged = True
                continue
            gaps += flat.count(b" ", seen, end + 1)  # blanks up to the one that ends the phrase: one more than the words so far
            seen = end + 1
            places.append((gaps - 1 - size, phrase, label))
        places.sort()
        found = list(self.expressions(text)) if tagged else []
        values = [RESTRICTION.get(label, RESTRICTION["other"]) for _, _, label in places] + [e[1] for e in found]
        return n_words, places, found, max(values, default=0.0)

    def expressions(self, text: str):
        for end, _ in self.tags.iter("".join(c.lower() if c.isascii() else c for c in text)):
            order, stop, whole = postfix(text, end + 1)
            if order:
                value, chosen, named, sound = evaluate(order)
                yield text[end + 1 : stop].strip(), value, chosen, named, whole and sound


SHAPE = (
    "n_words long, places array<struct<word: long, phrase: string, label: string>>, "
    "expressions array<struct<text: string, value: double, chosen: array<string>, named: array<string>, sound: boolean>>, score double"
)


def scan(docs: DataFrame, text: str = "text", notices: Mapping[str, str] = NOTICES, out: str = "licences") -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``out``; a column of that name is replaced.

    ``places``: every place (first word, from 0) where a notice phrase's words stand, overlapping ones included, in order; two phrases may start
    at one word. ``expressions``: every tagged expression with its restriction, the labels chosen and named, and whether it was well formed.
    ``score``: the strictest of them, 0 where nothing is found. ``notices`` maps phrases, given in words as a text's, to labels; labels
    without a stated restriction count as ``other``.

    Null texts are empty: no words, no places, score 0. Texts are scanned whole, whatever their length, each in one pass; repeated rows and ties
    are rows like others. An empty table gives an empty one. No shuffle: a row's result comes from its text alone.
    """
    made: list[Scanner] = []
    told = dict(notices)

    @F.pandas_udf(SHAPE)
    def found(texts: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(Scanner(told))
        return pd.DataFrame([made[0].scan(t) for t in texts], columns=["n_words", "places", "expressions", "score"])

    base = docs.drop(out)
    held = fresh(base, "_found")
    return base.withColumn(held, found(F.col(text))).withColumnRenamed(held, out)


def labels(found: str = "licences"):
    """All labels of a scanned row, from phrases and expressions: distinct, in order."""
    said = F.transform(F.col(found)["places"], lambda p: p["label"])
    named = F.flatten(F.transform(F.col(found)["expressions"], lambda e: e["named"]))
    return F.array_sort(F.array_distinct(F.concat(said, named)))
