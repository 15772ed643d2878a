"""Tokenizers decide how they are fed, staged tables outlive other queries, growing trees and mixes keep their laws."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from fixture import frame
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from strataledger.llm import hash_tree, mixing, queries, separator_scan  # noqa: E402
from strataledger.llm.common import read, scope, staged  # noqa: E402
from strataledger.llm.tokens import KNOWN, Encoder, encoder  # noqa: E402

AWKWARD = [
    "", " ", "a", "  a  b\t\nc\r\n", "It's l'été aujourd'hui 'tis 's 'S 'RE", "ÉTÉ Été ÇA İstanbul ẞ ſ ß × ÷ a×b é÷2", "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|",
    "日本語 テスト 한국어 עברית العربية ไทย", "é áb ́x x​z  a b c", "1234 a1b2 ½ ² Ⅷ ٣٤ 1,2.3e-4", "foo_bar __x__ %%% !!??.. ---- ~~ \x00\x01\x1c\x1d a\x7fb", "😀 a😀b ™ © ® …",
    "Ǆ ǅ ǆ Ʃ ɏ Ɏ ɐ ʼn ŉ ĳ", "CAPITALS and Mixed CaSe WORDS", "don't DON'T we've WE'VE o'clock", "\x0b\x0cx\x85y z",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("special", [False, True])
def test_ids_are_the_librarys(name, special):
    enc = Encoder(queries.tokenizer(name), None, special)
    assert (enc.by_words, enc.by_pieces) == ((True, True) if name.startswith("word") else (False, False))
    rng = random.Random(1)
    texts = AWKWARD + [" ".join(rng.choices(AWKWARD, k=5)) for _ in range(50)]
    for _ in range(2):  # learned, then remembered
        assert enc.encode(texts) == [enc._ids(t).tobytes() for t in texts]
    enc.by_pieces, enc.young, enc.old = False, {}, {}  # whole words
    assert enc.encode(texts) == [enc._ids(t).tobytes() for t in texts]
    assert enc.encode([]) == []


def test_generations_change():
    enc = encoder(queries.tokenizer(), None, False)
    words = [f"w{''.join(chr(97 + (i // 26**k) % 26) for k in range(5))}" for i in range(KNOWN + 10)]
    enc.encode([" ".join(words)])
    assert enc.encode(["wabcde waaaaa"]) == [enc._ids("wabcde waaaaa").tobytes()] and len(enc.young) < 10 < len(enc.old)


def test_unfit_tokenizer_is_refused():
    with pytest.raises(ValueError, match="single words"):
        Encoder(queries.tokenizer("byte_bpe_50k.json"), True)


def test_results_outlive_other_queries(spark, sf):
    a, b = queries.QUERIES["op7_simhash_near_dups"](spark, sf), queries.QUERIES["op9_substring_dedup"](spark, sf)
    n = read(spark, sf, "documents").count()
    corpus_pipeline.run(spark, sf).count()
    assert a.count() == b.count() == n


def test_scopes_delete_their_own(spark):
    kept = staged(spark.range(3))
    with scope(spark):
        gone = staged(spark.range(4))
        with scope(spark):
            inner, over = staged(spark.range(5)), staged(spark.range(6), keep=True)
            assert inner.count() == 5
        assert gone.count() == 4
    assert kept.count() == 3 and over.count() == 6
    for df in (gone, inner):
        with pytest.raises(Exception, match="(?i)not.exist"):
            spark.read.parquet(df.inputFiles()[0]).count()


def test_no_broadcast_holds_documents(spark, sf):
    out = separator_scan.document_tokens(read(spark, sf, "documents"), queries.tokenizer(), queries.WORD_BPE_END)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 5, 8, 23, 25, 31, 32])
def test_grown_trees_take_rows_only_into_new_shards(spark, n):
    old = hash_tree.topology(n)
    grown = hash_tree.grow(old, 2)
    assert [s.shard for s in grown] == list(range(n + 2))
    rows = spark.range(20_000).select(hash_tree.place(F.col("id"), old).alias("a"), hash_tree.place(F.col("id"), hash_tree.grow(old)).alias("b"), hash_tree.place(F.col("id"), grown).alias("c"))
    assert rows.where(f"a <> b and b <> {n}").isEmpty() and rows.where(f"b <> c and c <> {n + 1}").isEmpty()
    moved = rows.where(f"b = {n}").count()
    assert abs(moved - 20_000 / (n + 1)) < 6 * np.sqrt(20_000 / (n + 1))


def test_mix_keeps_sources_that_are_not_listed(spark):
    docs = frame(spark)
    given = spark.createDataFrame([("src0", 2.0), ("src1", 0.0), (None, 1.0)], "src string, weight double")
    out = mixing.mix(docs, F.size(F.split("text", " ")), given)
    assert out.count() == docs.count()
    left = {r["source"]: (r["t"], r["n"]) for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("n")).collect()}
    assert all(left[s] == (0, 0.0) for s in ("src1", "src2", "src3")) and left["src0"][0] > 0 and left[None][0] > 0


@pytest.mark.parametrize("symbols", [0, 1, 3])
def test_mix_fills_its_ranges_alike(spark, symbols):
    """Whatever the quality of a source, no range of its keys holds a large share."""
    text = "word " * 6 + "#" * symbols
    keys = spark.range(50_000).select((-F.log(mixing.uniform(F.col("id"))) / mixing.quality(F.lit(text))).alias("key"))
    cells = keys.groupBy(F.floor(F.log("key") * (4096 / 8))).count()
    assert cells.agg(F.max("count")).first()[0] < 0.003 * 50_000
