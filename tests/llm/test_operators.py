"""Every operator against a brute-force form on a table of awkward rows, and on an empty table."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from fixture import frame, rows, split
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataledger.llm import (
    de_bruijn,
    decision_list,
    hash_tree,
    line_templates,
    mixing,
    queries,
    separator_scan,
    simhash_ball,
    sparse_suffix,
    template_windows,
    token_records,
)
from strataledger.llm.common import components, count_words

DATA = rows()


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def bag(found, *columns):
    return Counter(tuple(r[c] for c in columns) for r in found.collect())


# mixing


def test_mix(docs, none):
    out = mixing.mix(docs, count_words(F.col("text"))).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in DATA)
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r[0], len(split(r[1]))) for r in DATA)
    size, got, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        size[r["source"]] += r["size"]
        got[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, want, left = set(order), {}, float(sum(size.values()))
    while True:
        level = left / sum(weight[s] for s in free)
        capped = {s for s in free if level * weight[s] > 3 * size[s]}
        if not capped:
            break
        for s in capped:
            want[s] = 3 * size[s]
            left -= want[s]
        free -= capped
    want.update({s: level * weight[s] for s in free})
    for s in order:
        assert math.isclose(target[s], want[s], rel_tol=1e-9)
        assert abs(got[s] - target[s]) <= max(r["size"] for r in out if r["source"] == s) / 2 + 1
    again = mixing.mix(docs.repartition(3), count_words(F.col("text")))
    assert bag(again, "doc_id", "size", "taken") == Counter((r["doc_id"], r["size"], r["taken"]) for r in out)
    assert bag(mixing.take_all(mixing.mix(docs, count_words(F.col("text")))).groupBy("source").agg(F.sum("size").alias("n")), "source", "n") == Counter(
        {(s, n): 1 for s, n in got.items()}
    )
    assert mixing.mix(none, count_words(F.col("text"))).count() == 0


def test_mix_prefers_quality(spark):
    data = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("a b c d e f g h i j")).otherwise(F.lit("a# b# c d e f g h i j")).alias("text"),
        F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
    )
    out = mixing.mix(data, count_words(F.col("text"))).where("source = 'b' and taken > 0")
    share = {r[0]: r[1] for r in out.groupBy(F.col("doc_id") % 2).count().collect()}
    assert share[0] > 2 * share[1]  # weights 1 and 0.1


# line templates


def test_line_templates(spark, none):
    texts = [f"own line {'abcdefghijklmnop'[i]} of text\nUser bob{i} logged in from host{i % 3} today\nread the {'abcdefghijklmnop'[i]} manual page" for i in range(14)]
    texts += [texts[0], None, "", "\n\n", "unique words stand here alone"]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r["doc_id"]: r for r in line_templates.drop_recurring(data).collect()}
    for i in range(14):
        assert out[i]["n_lines"] == 3 and out[i]["n_dropped"] == 3 and out[i]["text"] == ""
    assert out[14]["text"] == "" and out[15]["text"] is None and out[15]["n_lines"] == 0
    assert out[16]["text"] == "" and out[17]["text"] == "\n\n" and out[18]["n_dropped"] == 0 and out[18]["text"] == texts[18]
    few = line_templates.drop_recurring(data.where("doc_id < 9 or doc_id = 14"))
    assert few.agg(F.sum("n_dropped")).first()[0] == 0  # nine texts and a copy are not ten texts
    assert line_templates.drop_recurring(none).count() == 0


@pytest.mark.parametrize("n", [400, 4_000, 40_000])
def test_templates_of_words_at_every_size(spark, n):
    def word(i, seed):
        return "v" + hashlib.md5(f"{i % seed}-{seed}".encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))[:8]

    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 500, n), rng.integers(0, 100, n)
    data = [(i, f"{word(i, 10**9)} own\nPosted by {word(int(x), 500)} in {word(int(y), 100)} desk today") for i, (x, y) in enumerate(zip(a, b, strict=True))]
    out = line_templates.drop_recurring(spark.createDataFrame(data, "doc_id long, text string"), least=1, generalise=True)
    assert [tuple(r) for r in out.groupBy("n_lines", "n_dropped").count().collect()] == [(2, 1, n)]


def test_short_lines_and_copies_recur(spark, none):
    letters = "abcdefghijkl"
    texts = [f"{x} stands {x} alone {x}\nRead more\nPage {i}\nShare" for i, x in enumerate(letters)] + ["rare words\nTwo here"]
    texts += ["one text with a footer line\nfirst of it"] * 9 + ["one text with a footer line\nthen another of it"] + ["a text by itself\nin many copies"] * 12
    out = line_templates.drop_recurring(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), least=1, generalise=True)
    assert [r["n_dropped"] for r in out.orderBy("doc_id").collect()] == [3] * 12 + [0] + [1] * 10 + [0] * 12
    assert line_templates.drop_recurring(none, least=1, generalise=True).count() == 0


def test_line_templates_keep_rows(docs):
    out = line_templates.drop_recurring(docs, recurring=2)
    assert bag(out, "doc_id") == Counter((r[0],) for r in DATA) and set(docs.columns) < set(out.columns)


# token files


def tokens(text):
    return Tokenizer.from_file(queries.tokenizer()).encode(text or "", add_special_tokens=False).ids


def test_token_records(docs, none):
    files = token_records.write(docs, queries.tokenizer(), 2)
    got = token_records.read(files).collect()
    want = Counter()
    for i, t, *_ in DATA:
        ids = np.array([*tokens(t), 2], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    got.sort(key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order)
    f = max(files.collect(), key=lambda f: f["n_records"])
    last = [r for r in got if r["file"] == f["file"]][-1]
    assert zlib.crc32(token_records.pick(f["data"], f["index"], last["record"])[1].astype("<u4")) == last["ids_crc32"]
    assert token_records.read(token_records.write(none, queries.tokenizer(), 2)).count() == 0


def test_damage_is_found():
    data = bytearray(token_records.frame(b"some payload"))
    assert bytes(token_records.unframe(memoryview(data), 0)[0]) == b"some payload"
    for at in (0, 9, 14, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(memoryview(bad), 0)
    with pytest.raises(ValueError):
        token_records.unframe(memoryview(data[:-3]), 0)


@pytest.mark.parametrize("block", [8, 64, 8 << 20])
def test_separator_scan(docs, none, block):
    tok = Tokenizer.from_file(queries.tokenizer())
    tok.encode_special_tokens = True
    want = Counter((i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in DATA)
    some = docs if block > 8 else docs.where("length(text) < 300")
    got = bag(separator_scan.document_tokens(some, queries.tokenizer(), queries.WORD_BPE_END, block), "doc_id", "n_tokens")
    assert got == want if block > 8 else not got - want
    if block == 64:
        assert separator_scan.document_tokens(none, queries.tokenizer(), queries.WORD_BPE_END).count() == 0


def test_separator_scan_of_given_files(spark, tmp_path):
    ids = [9, 9, 5, 6, 9, 7, 7, 7, 7, 7, 7, 7, 9, 1]
    (tmp_path / "a").write_bytes(np.array(ids, "<u4").tobytes())
    files = spark.createDataFrame([(f"file://{tmp_path}/a", 4, 4 * len(ids)), (f"file://{tmp_path}/none", 2, 0)], "data string, width int, n_bytes long")
    for block in (4, 12, 1 << 20):
        got = sorted((r["at"], r["n_tokens"], r["ended"]) for r in separator_scan.count_tokens(files, 9, block).collect())
        assert got == [(0, 0, True), (1, 0, True), (2, 2, True), (3, 7, True), (4, 1, False)]


# suffix array, De Bruijn graph


def without_repeats(k):
    counts, out = Counter(), Counter()
    for r in DATA:
        w = split(r[1])
        counts.update(tuple(w[a : a + k]) for a in range(len(w) - k + 1))
    for r in DATA:
        w = split(r[1])
        gone = {a + j for a in range(len(w) - k + 1) if counts[tuple(w[a : a + k])] > 1 for j in range(k)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
        out[r[0], len(w), len(gone), None if r[1] is None else kept] += 1
    return out


@pytest.mark.parametrize("remove,k,gram", [(sparse_suffix.remove_repeats, 50, 8), (de_bruijn.remove_repeats, 35, 8), (de_bruijn.remove_repeats, 6, 2), (sparse_suffix.remove_repeats, 5, 3)])
def test_repeats(docs, none, remove, k, gram):
    clean = docs.drop("n_words")
    got = remove(clean, k, gram)
    assert bag(got, "doc_id", "n_words", "n_removed", "text") == without_repeats(k)
    assert set(clean.columns) < set(got.columns) and bag(got, "key1") == bag(docs, "key1")
    assert remove(none, k, gram).count() == 0


# sharding


def test_shards(docs, none):
    old, new = hash_tree.topology(24), hash_tree.topology(25)
    out = hash_tree.shard(docs, old, new).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in DATA)
    slots, place = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        place[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(p) == 1 for p in place.values())
    assert hash_tree.shard(none, old).count() == 0


def test_shard_weights_move_only_their_subtree(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"))
    old = hash_tree.topology(24)
    new = [hash_tree.Shard(s.shard, s.region, s.rack, 3.0 if s.shard == 5 else 1.0) for s in old]
    moved = keys.select(hash_tree.place(F.col("doc_id"), old).alias("a"), hash_tree.place(F.col("doc_id"), new).alias("b"))
    rows = moved.collect()
    share = Counter(r["b"] for r in rows)
    assert abs(share[5] / len(rows) - 3 / 26) < 0.01 and all(abs(share[i] / len(rows) - 1 / 26) < 0.01 for i in range(24) if i != 5)
    for r in rows:  # whoever changes its region goes to region 0, whoever changes its rack inside it goes to rack 1
        assert r["a"] // 8 == r["b"] // 8 or r["b"] // 8 == 0
        assert not (r["a"] // 8 == r["b"] // 8 == 0 and r["a"] // 4 != r["b"] // 4) or r["b"] // 4 == 1
    with pytest.raises(ValueError):
        hash_tree.place(F.col("doc_id"), [hash_tree.Shard(0, "r", "k", 0.0)])


# SimHash


def fingerprint(text, k):
    w = [bytes(x) for x in (text or "").encode().lower().split()]
    grams = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_fingerprints_agree_with_spark(docs):
    got = docs.select("text", simhash_ball.fingerprint(F.col("text"), 3).alias("fp"), F.xxhash64("text").alias("h")).collect()
    for r in got:
        assert r["fp"] % 2**64 == fingerprint(r["text"], 3)
        if r["text"] is not None:
            assert r["h"] % 2**64 == xxhash.xxh64_intdigest(r["text"].encode(), 42)


def linked(prints, distance):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    prints = sorted(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin((a ^ b) % 2**64).count("1") <= distance:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_links(spark, distance):
    rng = np.random.default_rng(distance)
    prints = {int(x) for x in rng.integers(-(2**62), 2**62, 6)}
    for p in list(prints):
        for _ in range(12):
            q = p
            for b in rng.integers(0, 63, rng.integers(1, 5)):
                q ^= 1 << int(b)
            prints.add(q)
    frame_ = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = simhash_ball.links(frame_, distance)
    for r in found.collect():
        assert bin((r["a"] ^ r["b"]) % 2**64).count("1") <= distance
    root = {r["node"]: r["root"] for r in components(found).collect()}
    want = linked(prints, distance)
    sides = Counter((want[p], root.get(p, p)) for p in prints)
    assert len({a for a, _ in sides}) == len({b for _, b in sides}) == len(sides)


def test_near_duplicates(docs, none):
    got = simhash_ball.near_duplicates(docs).collect()
    want = linked({(fingerprint(r[1], 3) + 2**63) % 2**64 - 2**63 for r in DATA}, 2)
    first = {}
    for r in DATA:
        p = want[(fingerprint(r[1], 3) + 2**63) % 2**64 - 2**63]
        if r[0] is not None:
            first[p] = min(first.get(p, r[0]), r[0])
    expected = Counter((r[0], first.get(want[(fingerprint(r[1], 3) + 2**63) % 2**64 - 2**63])) for r in DATA)
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == expected
    kept = simhash_ball.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(want.values()))
    assert simhash_ball.near_duplicates(none).count() == 0 and simhash_ball.keep_one(none).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


# benchmark decontamination


BENCH = [
    (0, "Maria has 12 apples and gives Peter 5 apples before she walks 3 km to the old market near the river"),
    (1, "the quick brown fox jumps over the lazy dog while seven wizards box"),
    (2, "short one here now"), (3, "tiny"), (4, None),
]
PAGES = [
    (0, "Intro text. Maria has 12 apples and gives Peter 5 apples before she walks 3 km to the old market near the river. More"),
    (1, "so Anna has 30 apples and gives Oscar 4 apples before she walks 9 miles to the old market near the river today"),
    (2, "so Anna has 30 apples and gives Anna 4 apples before she walks 30 km and never comes near the place at all again"),
    (3, "THE QUICK brown fox, jumps over the lazy dog; while seven wizards box"),
    (4, "the quick brown fox stands over a dead cat"), (5, "a text with short one here now in it"), (6, None), (7, ""), (8, "tiny"),
    (None, "the quick brown fox jumps over the lazy dog while seven wizards box"),
    (9, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"), (0, "the quick brown fox jumps over the lazy dog while seven wizards box"),
]


@pytest.mark.parametrize("block", [4_000_000, 5])
def test_decontamination(spark, block):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    pages = spark.createDataFrame([(i, t, 1) for i, t in PAGES], "doc_id long, text string, key1 int")
    got = bag(template_windows.matches(pages, bench, block=block), "doc_id", "item_id")
    assert got == Counter([(0, 0), (1, 0), (3, 1), (5, 2), (None, 1), (0, 1)])
    left = template_windows.clean(pages, bench, block=block)
    assert left.columns == pages.columns
    assert bag(left, "doc_id") == Counter([(2,), (4,), (6,), (7,), (8,), (9,)])


def test_slots_must_map_one_to_one(spark):
    bench = spark.createDataFrame([(0, "if Anna meets Bert and Anna leaves Bert then who of them is left there alone at night")], "item_id long, text string")
    same = "so if Carl meets Dora and Carl leaves Dora then who of them is left there alone at night"
    crossed = "so if Carl meets Dora and Dora leaves Carl then nobody knows it anyway in this story"
    pages = spark.createDataFrame([(0, same), (1, crossed)], "doc_id long, text string")
    assert bag(template_windows.matches(pages, bench), "doc_id") == Counter([(0,)])


def found(spark, items, pages):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(pages)), "doc_id long, text string")
    return set(bag(template_windows.matches(docs, bench), "doc_id", "item_id"))


def test_windows_of_few_literals_match_word_for_word(spark):
    items = ["Solve 3 x 4 + 5 = 17 and 6 x 2 - 8 = 4", "Calculate 45 * 67 + 12", "Ann Bo Cy Dee Eve Flo Gus Hal Ida Jon Kim Lea Moe Ned Ole"]
    pages = [f"Some words first\n{t}\nand some after" for t in items] + ["Solve 4 x 5 + 6 = 26 and 7 x 3 - 9 = 12", "Calculate 46 * 67 + 12"]
    assert found(spark, items, pages) == {(0, 0), (1, 1), (2, 2)}


def test_one_conflict_leaves_the_other_windows(spark):
    fruit = "in the shop a box holds 3 apples and {} pears so how many pieces of fruit does it hold in all"
    items = [
        "we start with 3 red balls and then put each of them into a box and after a while we take 3 blue cups and sell them all",
        fruit.format(5), fruit.format(3).replace("shop", "house"),
        "so Anna walks to the old market near the river and buys some fresh fish for the dinner before the rain sets in and then Anna goes home",
    ]
    pages = [
        items[0].replace("3 blue", "4 blue"), fruit.format(4).replace("3", "4"), items[2].replace("3 apples", "4 apples").replace("3 pears", "6 pears"),
        items[3].replace("Anna walks", "Carl walks").replace("Anna goes", "Dora goes"),
    ]
    assert found(spark, items, pages) >= {(i, i) for i in range(4)}


def test_copies_in_other_case_and_lines(spark):
    items = [
        "What is the capital of France", "Clara Schumann met Johannes Brahms in Hamburg before Robert Schumann went to Bonn with Joseph Joachim",
        "the road from Lyon over Dijon and on to Paris passes Auxerre and Sens",
    ]
    pages = [
        "a quiz: then he asked What is the capital of France and left", "what is the capital of france", "so " + items[1].lower(), "SO " + items[1].upper(),
        "so " + items[2].replace(" Dijon", "\nDijon").replace(" Auxerre", "\nAuxerre"),
    ]
    assert found(spark, items, pages) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)}


def test_decontamination_of_empty_tables(spark, none, docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert template_windows.matches(none, bench).count() == 0
    assert template_windows.clean(docs, bench.limit(0)).count() == len(DATA)


# quality rules


def base(text):
    t = text or ""
    w = split(t)
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c = Counter(win)
    covered = {i + j for i, x in enumerate(win) if c[x] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if split(x)]
    chars = sum(len(x.decode()) for x in w)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), chars, sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_base_rules(docs, none):
    out = decision_list.judge(docs, [])
    s = F.col("stats")
    got = bag(out.select("doc_id", *[s[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept"),
              "doc_id", "stats.n_words", "stats.word_chars", "stats.n_symbols", "stats.n_dup_lines", "stats.n_repeat_words", "base_failed", "kept")
    assert got == Counter((r[0], *base(r[1]), not base(r[1])[-1]) for r in DATA)
    assert decision_list.judge(none, []).count() == 0


def test_learned_list():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    bad = ((x[:, 0] > 0.8) & (x[:, 1] < 0.5)) | (x[:, 2] > 0.9)
    rules = decision_list.learn(x, bad, ["a", "b", "c"])
    y = rng.random((3000, 3))
    said = np.zeros(3000, bool)
    for r in rules:
        said |= r.covers(y, ["a", "b", "c"])
    truth = ((y[:, 0] > 0.8) & (y[:, 1] < 0.5)) | (y[:, 2] > 0.9)
    assert (said == truth).mean() > 0.97 and rules
    assert decision_list.learn(x, rng.random(3000) < 0.5, ["a", "b", "c"]) == []  # nothing to learn


def test_fit_and_held_out_accuracy(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    docs, labels = queries.read(spark, folder, "documents"), queries.read(spark, folder, "labels")
    odd = labels.where("doc_id % 2 = 1")
    rules = decision_list.fit(docs, odd)
    out = decision_list.judge(docs, rules).join(labels.where("doc_id % 2 = 0"), "doc_id")
    n = {(r["kept"], r["quality"]): r["count"] for r in out.groupBy("kept", "quality").count().collect()}
    assert rules and n.get((False, 0), 0) >= 0.8 * (n.get((True, 0), 0) + n.get((False, 0), 0))
    assert n.get((False, 1), 0) <= 0.1 * (n.get((True, 1), 0) + n.get((False, 1), 0))
    assert decision_list.fit(docs, labels.limit(0)) == [] and decision_list.fit(docs.limit(0), labels) == []
    twice = labels.union(labels.selectExpr("doc_id", "1 - quality", "toxic"))
    assert decision_list.fit(docs, twice) == []


def test_kept_digest_is_sha256(spark):
    out = queries._kept(spark.createDataFrame([(1, "a b", 2, 0), (2, None, 0, 0)], "doc_id long, text string, n_words int, n_removed int"))
    assert [r["kept_sha256"] for r in out.collect()] == [hashlib.sha256(x).hexdigest() for x in (b"a b", b"")]
