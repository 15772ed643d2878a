"""A small documents table with every awkward case, and brute-force forms of the operators."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside or add
    T.StructField("_fp", T.StringType()), T.StructField("taken", T.StringType()), T.StructField("shard", T.StringType()),
    T.StructField("key1", T.LongType()), T.StructField("stats", T.StringType()), T.StructField("n_words", T.StringType()),
])


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


def rows(seed=1, n=60):
    rng = random.Random(seed)
    passage, long_ = prose(rng, 80), prose(rng, 9_000, 5_000)
    out = []
    for i in range(n):
        text = prose(rng, rng.randrange(1, 200))
        if i % 7 == 0:
            text = f"{prose(rng, 20)}\n{passage}\n{prose(rng, 15)}"
        out.append((i, text, "en", f"src{i % 4}" if i % 9 else None, len(text)))
    texts = [None, "", " \t\n\x0b ", "one", "one two", long_, long_ + " end", passage, passage, "Été é ÉTÉ 'tis <|endoftext|> 日本 é x" * 9,
             "a b c d e " * 40, "Same line here 1\nother\n" * 3]
    out += [(1000 + i, t, None, "src0", None) for i, t in enumerate(texts)]
    out += [(None, "no id " + passage, "en", "src1", 1), (None, None, None, None, None), out[3], out[3], (3, "another text of the same id", "en", "src3", 9)]
    return [(*r, "x", "y", "z", 7, "s", "q") for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(5)


def split(text):
    return (text or "").encode().split()
