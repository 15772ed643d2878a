"""Licence scan, Merkle manifest and periodic runs against brute-force forms, on awkward rows and on an empty table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixture import frame, rows
from pyspark.sql import functions as F

from strataledger.llm import license_scan, merkle, periodic_runs, queries

DATA = rows()


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# licence scan


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def test_notices(spark):
    texts = [
        None, "", "  ", "CC BY cc-by CC  by 4.0", "under the GNU General Public License, all rights reserved.", "all rights all rights reserved reserved",
        "general\npublic\tlicense" * 3, "general public licensee", "Écc by é cc by", "MIT License and Apache License, Version 2.0", "ccby cc_by cc.by cc" + " by",
        "word " * 50_000 + "cc by " * 20_000, "CC BY-NC 4.0 KK",
    ]
    data = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, licences string")
    got = {r["doc_id"]: r for r in license_scan.scan(data).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate([*texts, texts[3]]):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(text))
        want = sorted(
            (k, p, label) for p, label in license_scan.NOTICES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()
        ) if len(words) < 1000 else None
        found = got[i]["licences"]
        assert found["n_words"] == len(words)
        if want is None:
            assert [p["word"] for p in found["places"]] == list(range(50_000, 90_000, 2))
        else:
            assert [tuple(p) for p in found["places"]] == want
            assert found["score"] == max([license_scan.RESTRICTION[x] for _, _, x in want], default=0.0)


def test_scan_takes_awkward_rows(docs, none):
    out = license_scan.scan(docs)
    assert out.columns == [*docs.columns, "licences"] and out.count() == len(DATA)
    assert out.drop("licences").exceptAll(docs).isEmpty()
    assert license_scan.scan(none).collect() == []
    again = license_scan.scan(out, text="text")
    assert again.columns == out.columns


def descent(tokens):
    """The same grammar by recursive descent: (restriction, chosen labels)."""

    def level(k):
        if k == 3:
            t = tokens.pop(0)
            if t == "(":
                got = level(1)
                tokens.pop(0)
                return got
            label = license_scan.label_of(t)
            return license_scan.RESTRICTION[label], {label}
        name = {1: "or", 2: "and"}[k]
        a = level(k + 1) if k == 1 else with_(k)
        while tokens and tokens[0].lower() == name:
            tokens.pop(0)
            b = level(k + 1) if k == 1 else with_(k)
            if k == 2:
                a = max(a[0], b[0]), a[1] | b[1]
            else:
                a = min(a[0], b[0]), a[1] | b[1] if a[0] == b[0] else min(a, b, key=lambda x: x[0])[1]
        return a

    def with_(k):
        a = level(k + 1)
        while tokens and tokens[0].lower() == "with":
            tokens.pop(0)
            tokens.pop(0)
            a = min(a[0], license_scan.WEAK), a[1]
        return a

    return level(1)


def test_expressions_against_recursive_descent():
    rng = random.Random(4)
    ids = ["MIT", "Apache-2.0", "GPL-2.0-only", "gpl-3.0+", "LGPL-2.1-or-later", "AGPL-3.0-only", "CC-BY-4.0", "CC-BY-NC-4.0", "BSD-3-Clause", "LicenseRef-own"]

    def made(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            return [rng.choice(ids), *(["WITH", "Classpath-exception-2.0"] if rng.random() < 0.3 else [])]
        if kind < 0.5:
            return ["(", *made(depth - 1), ")"]
        return [*made(depth - 1), rng.choice(["and", "OR", "AND", "or"]), *made(depth - 1)]

    for _ in range(500):
        tokens = made(4)
        text = " ".join(tokens)
        order, end, whole = license_scan.postfix(text + " , see file")
        value, chosen, _, sound = license_scan.evaluate(order)
        assert whole and sound and end == len(text)
        want = descent(list(tokens))
        assert (value, chosen) == (want[0], sorted(want[1])), text


@pytest.mark.parametrize(("text", "read", "whole", "value"), [
    ("MIT AND", ["MIT"], False, 0.2), ("(MIT OR GPL-2.0", ["MIT", "GPL-2.0", "or"], False, 0.2), (") MIT", [], False, None), ("AND", [], False, None),
    ("MIT license text", ["MIT"], True, 0.2), ("MIT)", ["MIT"], True, 0.2), ("MIT.", ["MIT"], True, 0.2), ("MIT OR Tag: x", ["MIT"], False, 0.2), ("GPL-2.0 WITH Classpath-exception-2.0 */", ["GPL-2.0", "Classpath-exception-2.0", "with"], True, 0.5),
    ("MIT OR (", ["MIT"], False, 0.2), ("", [], False, None), ("(" * 5000 + "MIT", ["MIT"], False, 0.2), ("MIT AND (GPL-3.0 OR", ["MIT", "GPL-3.0", "and"], False, 0.7),
])
def test_broken_expressions(text, read, whole, value):
    order, _, ok = license_scan.postfix(text)
    assert (order, ok) == (read, whole)
    assert value is None or license_scan.evaluate(order)[0] == value


def test_tags_in_texts(spark):
    texts = [
        "# SPDX-License-Identifier: (MIT OR GPL-2.0-only)\nAll text", "spdx-license-identifier:Apache-2.0 and License-Expression: CC-BY-NC-4.0 */",
        "spdx license identifier MIT", "SPDX-License-Identifier: ", "SPDX-License-Identifier: GPL-2.0 WITH nothing",
    ]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = license_scan.scan(data).withColumn("labels", license_scan.labels()).orderBy("doc_id").collect()
    assert [r["labels"] for r in out] == [["gpl", "mit"], ["apache", "cc-by", "cc-by-nc"], [], [], ["gpl"]]
    assert [[tuple(e)[0::2] for e in r["licences"]["expressions"]] for r in out][0] == [("(MIT OR GPL-2.0-only)", ["mit"], True)]
    assert [r["licences"]["score"] for r in out] == [0.2, 0.9, 0.0, 0.0, 0.7]
    assert not out[4]["licences"]["expressions"][0]["sound"]


# Merkle manifest


def climbed(nodes):
    """(root, sibling pairs of every node) of a list of digests."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, owned = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for k in range(len(run)):
                for i in owners[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha(*run))
            owned.append([i for k in range(len(run)) for i in owners[a + k]])
        nodes, owners = up, owned
    return (nodes[0] if nodes else None), paths


def leaf_of(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_manifest(data):
    """Counter of (doc_id, leaf, subroot, root, proof) of (doc_id, source, lang, n_chars, text) rows."""
    groups = defaultdict(list)
    for r in data:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, out = [], []
    for g in order:
        own = sorted(((r[0] is not None, r[0] or 0, leaf_of(*r), r) for r in groups[g]), key=lambda x: x[:3])
        subs.append((own, *climbed([x[2] for x in own])))
    root, tops = climbed([s[1] for s in subs])
    for (own, sub, paths), top in zip(subs, tops, strict=True):
        for (_, _, leaf, r), path in zip(own, paths, strict=True):
            whole = [*path, *top]
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            start = leaf_of(*r[:4], None if r[4] is None else low(r[4])) if touched else leaf
            for a, b in whole:
                start = sha(a, start, b)
            out.append((r[0], leaf, sub, root, sha(*[a + b for a, b in whole]), start, start == root))
    return Counter(out)


def manifest_rows(spark, tmp_path, data):
    frame_ = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    frame_.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(tuple(r) for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect())


def test_manifest_of_awkward_rows(spark, tmp_path):
    data = [(r[0], r[3], r[2], r[4], r[1]) for r in DATA]
    data += [(i, "s", "long", i, f"Text {i}") for i in range(9_000)]  # more than two blocks, a last run of less than eight
    data += [(i, "s", "of 4097", i, "x") for i in range(4_097)] + [(7, None, "lone", None, "T"), (-5, "é", "日本", -3, "É"), (10**18, "s", "eight", 1, "")]
    data += [(i, "s", f"lang{i:03}", i, "T") for i in range(70)]
    assert manifest_rows(spark, tmp_path, data) == brute_manifest(data)


@pytest.mark.parametrize("data", [[], [(1, "a", "en", 3, "Abc")], [(1, "a", "en", 3, "Abc"), (2, None, None, None, None)], [(None, None, None, None, None)] * 9])
def test_manifest_of_few_rows(spark, tmp_path, data):
    assert manifest_rows(spark, tmp_path, data) == brute_manifest(data)


def test_manifest_carries_columns_with_clashing_names(docs):
    named = docs.withColumns({c: F.lit("z") for c in ["g", "i", "n", "h", "block", "up", "own", "path", "_place"]})
    out = merkle.manifest(named, merkle.leaf(F.col("doc_id"), F.col("text")), carry={"path_of": F.col("path"), "g": F.col("g")})
    assert out.count() == len(DATA) and out.where("path_of = 'z' and g = 'z'").count() == len(DATA)
    assert out.where(merkle.fold(F.col("leaf")) != F.col("root")).isEmpty()
    assert out.groupBy("group_key").agg((F.max("place") + 1 - F.countDistinct("place")).alias("d")).where("d <> 0").isEmpty()


# periodic runs


def brute_runs(ids, least=6, times=4):
    out = {}
    for q in range(1, len(ids) // times + 1):
        i = 0
        while i + q < len(ids):
            j = i
            while j + q < len(ids) and ids[j] == ids[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in out.items())


def test_runs_of_random_sequences():
    rng, met = random.Random(1), 0
    for t in range(600):
        k, seq = rng.choice([1, 2, 3, 5, 50]), []
        while len(seq) < rng.randrange(1, 400):
            if rng.random() < 0.5:
                p = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 10, 15, 16, 17, 20, 31, 32, 33, 40, 64]))]
                seq += (p * rng.randrange(1, 9))[rng.randrange(len(p)) :]
            else:
                seq += [rng.randrange(k) for _ in range(rng.randrange(30))]
        want = brute_runs(seq)
        met += len(want)
        assert [tuple(r) for r in periodic_runs.runs(np.array(seq), short=(1, 8)[t % 2]).tolist()] == want
    assert met > 1000


def test_long_periods():
    rng = np.random.default_rng(2)
    for period in (700, 1_024, 4_097):
        tile = rng.integers(0, 300, period)
        ids = np.concatenate((rng.integers(300, 600, 100), np.tile(tile, 5)[: 4 * period + 13], rng.integers(600, 900, 50)))
        assert (100, 4 * period + 13, period) in [tuple(r) for r in periodic_runs.runs(ids).tolist()]
        assert (100, 4 * period - 1, period) not in [tuple(r) for r in periodic_runs.runs(np.delete(ids, slice(100 + 4 * period - 1, -50))).tolist()]
    with pytest.raises(ValueError, match="four periods"):
        periodic_runs.runs(ids, times=3)


def brute_periodic(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute_runs(words)
    gone = {k for a, size, q in found for k in range(a + q, a + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha(*[f"{a},{b},{c}\n" for a, b, c in found]), hashlib.sha256(kept).hexdigest())


def test_periodic_query(spark, tmp_path):
    rng = random.Random(3)
    data = [(r[0], r[1]) for r in DATA if r[1] is None or len(r[1]) < 20_000]
    data += [(i, " ".join(f"v{rng.randrange(30)}" for _ in range(rng.randrange(0, 300)))) for i in range(2_000, 2_600)]
    data += [(i, "la " * rng.randrange(1, 30) + "lo li " * 6 + "\n\tla") for i in range(30)] + [(3, None), (None, "a b " * 9)]
    spark.createDataFrame(data, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op13_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = Counter(brute_periodic(*r) for r in data)
    assert sum(1 for r in want if r[1]) > 60
    assert Counter(tuple(r) for r in out.collect()) == want


def test_collapse_takes_awkward_rows(docs, none):
    out = periodic_runs.collapse(docs.withColumn("periodic", F.lit(1)))
    assert out.columns == [*docs.columns, "periodic"] and out.drop("periodic").exceptAll(docs).isEmpty() and out.count() == len(DATA)
    assert periodic_runs.collapse(none).collect() == []


def test_license_query(spark, tmp_path):
    texts = [None, "", "This is CC BY-NC 4.0. All rights reserved; cc by", "GNU Lesser General Public License", "nothing here"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_license_scan(spark, str(tmp_path)).collect())
    assert got == [
        (0, 0, 0, None, None, "", "", 0.0), (1, 0, 0, None, None, "", "", 0.0), (2, 12, 3, 2, 10, "cc-by,reserved", "cc-by,cc-by-nc,reserved", 1.0),
        (3, 5, 1, 2, 2, "gpl", "gpl,lgpl", 0.7), (4, 2, 0, None, None, "", "", 0.0),
    ]
