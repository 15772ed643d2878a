"""The operators as named queries over the whole ``documents`` table, with SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import (
    de_bruijn,
    decision_list,
    hash_tree,
    license_scan,
    line_templates,
    merkle,
    mixing,
    periodic_runs,
    separator_scan,
    simhash_ball,
    sparse_suffix,
    template_windows,
    token_records,
)
from .common import count_words, read

#: Names of files of the public tokenizers; where they lie is the installation's affair.
WORD_BPE, WORD_BPE_END = "word_bpe_49k.json", 49407

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed from their sources by weights 5, 2, 1, at most three epochs each."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "source")
    out = mixing.mix(docs, count_words(F.col("text")))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


ORACLES["op1_mix_sources"] = r"""
WITH d AS (SELECT *, coalesce(text, '') AS t FROM documents),
r AS (SELECT doc_id, text, source, coalesce(source, '') AS src, source IS NOT NULL AS known,
  len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
  -ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\N') || '|' || coalesce(text, '\N') || '|42'), 1, 13))::BIGINT + 0.5::DOUBLE)
    / 4503599627370496::DOUBLE)
  / greatest(0.1::DOUBLE, 1::DOUBLE - 10::DOUBLE * (length(t) - length(translate(t, '#*$%&|<>', ''))) / greatest(length(t), 1)) AS key
  FROM d),
s AS (SELECT src, known, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY ALL),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY known DESC, src) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv, row_number() OVER o AS pos
  FROM w WINDOW o AS (ORDER BY source_size / weight, known DESC, src)),
f AS (SELECT arg_min(lv, pos) AS level FROM l WHERE lv * weight <= 3 * source_size),
g AS (SELECT src, known, source_size, coalesce(least((3 * source_size)::DOUBLE, level * weight), (3 * source_size)::DOUBLE) AS target FROM l, f),
c AS (SELECT r.*, source_size, target, floor(target / greatest(source_size, 1)) AS whole,
  sum(size) OVER (PARTITION BY src, known ORDER BY key, doc_id, text ROWS UNBOUNDED PRECEDING) AS total FROM r JOIN g USING (src, known))
SELECT doc_id, source, size, source_size, target,
  CAST(size * (whole + CASE WHEN size > 0 AND total - size / 2.0::DOUBLE < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c"""


@query
def op2_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines whose template recurs in ten texts or more."""
    out = line_templates.drop_recurring(read(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op2_line_templates"] = r"""
WITH t AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
s AS (SELECT text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM t),
l AS (SELECT text, no, line, regexp_extract_all(regexp_replace(line, '[^ 	-
]*[0-9][^ 	-
]*', '<*>', 'g'), '[^ 	-
]+') AS w FROM s),
m AS (SELECT text, no, line, w, len(w) AS n, w[1:2] AS lead FROM l WHERE len(w) >= 3),
f AS (SELECT n, lead FROM m GROUP BY n, lead HAVING count(DISTINCT text) >= 10),
k AS (SELECT n, lead, w, count(DISTINCT text) AS c FROM m JOIN f USING (n, lead) GROUP BY n, lead, w),
p AS (SELECT n, lead, w, c, unnest(w) AS token, unnest(range(len(w))) AS pos FROM k),
u AS (SELECT n, lead, pos, token FROM p GROUP BY n, lead, pos, token HAVING sum(c) >= 10),
a AS (SELECT n, w, list((pos, token) ORDER BY pos) AS kept FROM p JOIN u USING (n, lead, pos, token) WHERE token <> '<*>'
  GROUP BY n, w HAVING count(*) >= 0.6::DOUBLE * n),
b AS (SELECT n, kept FROM m JOIN a USING (n, w) GROUP BY n, kept HAVING count(DISTINCT text) >= 10),
d AS (SELECT DISTINCT text, no FROM m JOIN a USING (n, w) JOIN b USING (n, kept)),
r AS (SELECT s.text, count(d.no) AS n_dropped, count(*) FILTER (regexp_matches(line, '[^ 	-
]')) AS n_lines,
  coalesce(string_agg(line, chr(10) ORDER BY s.no) FILTER (d.no IS NULL), '') AS kept FROM s LEFT JOIN d ON s.text = d.text AND s.no = d.no GROUP BY s.text)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN r USING (text)"""


@query
def op2_recurring_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines, of any length, of which a generalisation recurs in ten documents or more."""
    out = line_templates.drop_recurring(read(spark, folder, "documents").select("doc_id", "text"), least=1, generalise=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op3_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' token ids written as framed records in id order, and read back."""
    files = token_records.write(read(spark, folder, "documents"), tokenizer(), end_id=2)
    return token_records.read(files).select("doc_id", "start", "n_tokens", "ids_crc32")


def _kept(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words of matches of 50 words or more."""
    return _kept(sparse_suffix.remove_repeats(read(spark, folder, "documents").select("doc_id", "text")))


@query
def op5_shard_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 23 by id; what would move to a 25th; numbered within their shard."""
    docs = read(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    out = hash_tree.shard(docs, hash_tree.topology(24), hash_tree.grow(hash_tree.topology(24)), text="text_crc32")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, counted between the separators of flat token files."""
    return separator_scan.document_tokens(read(spark, folder, "documents"), tokenizer(), WORD_BPE_END)


@query
def op7_simhash_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document, three-word shingles, at most two bits apart."""
    out = simhash_ball.near_duplicates(read(spark, folder, "documents"), 3, 2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the number of its tokens found."""
    out = template_windows.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return out.select("doc_id", "item_id", "n_matched", "n_item")


@query
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words of windows of 35 words that occur elsewhere."""
    return _kept(de_bruijn.remove_repeats(read(spark, folder, "documents").select("doc_id", "text")))


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics, base rules and the verdict of the decision list learned from the labels."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    rules = decision_list.fit(docs, read(spark, folder, "labels"))
    out = decision_list.judge(docs, rules)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *[F.col("stats")[c].alias(c) for c in base], "base_failed", "kept")


@query
def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices and tagged expressions of every document, as labels with the strictest restriction as score."""
    out = license_scan.scan(read(spark, folder, "documents").select("doc_id", "text"))
    held = F.col("licences")
    base = F.filter(held["places"], lambda p: p["phrase"].isin(*license_scan.BASE))
    starts = F.transform(base, lambda p: p["word"])
    named = F.array_sort(F.array_distinct(F.transform(base, lambda p: p["label"])))
    return out.select(
        "doc_id", held["n_words"].alias("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.concat_ws(",", named).alias("base_labels"),
        F.concat_ws(",", license_scan.labels()).alias("labels"), held["score"].alias("score"),
    )


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; a third of the leaves is folded from a lower-cased text and must fail unless nothing changed."""
    docs = read(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    meta = [F.col(c) for c in docs.columns[:-1]]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = merkle.manifest(docs, merkle.leaf(*meta, F.col("text")), carry={"tampered": F.when(touched, merkle.leaf(*meta, lower))})
    folded = out.withColumns({"proof_sha256": merkle.proof(), "folded_root": merkle.fold(F.coalesce("tampered", "leaf"))})
    return folded.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )

ORACLES["op12_merkle_manifest"] = r"""
WITH RECURSIVE a AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
  list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, k: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)) AS crc
  FROM documents),
e AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, xor(crc, 4294967295) % 3 = 0 AS touched, concat(
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS meta, coalesce(strlen(text) || ':' || text, '-') AS own, coalesce(strlen(low) || ':' || low, '-') AS bad FROM a),
f AS (SELECT doc_id, g, sha256(meta || own) AS leaf, CASE WHEN touched THEN sha256(meta || bad) ELSE sha256(meta || own) END AS start FROM e),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM f),
t AS (SELECT g, 0 AS lvl, i, leaf AS h FROM l UNION ALL
  SELECT g, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM t) WHERE c > 1 GROUP BY g, lvl, i // 8),
sub AS (SELECT g, arg_max(h, lvl) AS h FROM t WHERE i = 0 GROUP BY g),
u AS (SELECT 0 AS lvl, row_number() OVER (ORDER BY g) - 1 AS i, h FROM sub UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS c FROM u) WHERE c > 1 GROUP BY lvl, i // 8),
s AS (SELECT g, lvl, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || ',' ||
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS x
  FROM (SELECT *, max(lvl) OVER (PARTITION BY g) AS top FROM (SELECT * FROM t UNION ALL SELECT '', lvl, i, h FROM u)) WHERE lvl < top
  WINDOW w AS (PARTITION BY g, lvl, i // 8 ORDER BY i)),
k AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS j FROM sub),
o AS (SELECT l.g, l.i, list(x ORDER BY lvl) AS xs FROM l JOIN s ON s.g = l.g AND s.i = l.i // (8 ** lvl)::BIGINT GROUP BY ALL),
q AS (SELECT k.g, list(x ORDER BY lvl) AS xs FROM k JOIN s ON s.g = '' AND s.i = k.j // (8 ** lvl)::BIGINT GROUP BY ALL),
p AS (SELECT l.*, k.h AS subroot, (SELECT arg_max(h, lvl) FROM u) AS root, list_concat(coalesce(o.xs, []::VARCHAR[]), coalesce(q.xs, []::VARCHAR[])) AS path
  FROM l JOIN k USING (g) LEFT JOIN o ON o.g = l.g AND o.i = l.i LEFT JOIN q ON q.g = l.g),
z AS (SELECT *, sha256(replace(array_to_string(path, ''), ',', '')) AS proof_sha256, list_reduce(list_prepend(start, path),
  lambda h, x: sha256(concat(split_part(x, ',', 1), h, split_part(x, ',', 2)))) AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z"""


@F.pandas_udf(T.StringType())
def planted(checks: pd.Series, texts: pd.Series) -> pd.Series:
    """The texts; where an id's checksum ends in 0, the words from a place on repeat a stretch of them (both drawn from the checksum)."""
    out = texts.copy()
    for at in np.flatnonzero((checks % 10 == 0).to_numpy()):
        words = (texts.iat[at] or "").encode().split()
        g, n = int(checks.iat[at]) // 10, len(words)
        if n:
            a = g % n
            tile = words[a : a + 1 + (n - a) // (3 + g % 8)]
            out.iat[at] = b" ".join((words[:a] + tile * (-(-(n - a) // len(tile))))[:n]).decode()
    return out


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, after runs are planted in a tenth of them, and the digest of its text without the repeats."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    check = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))  # nothing is planted without an id
    out = periodic_runs.collapse(docs.withColumn("text", planted(check, F.col("text"))))
    held = F.col("periodic")
    best = F.aggregate(
        held["runs"], F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda b, r: F.when(b.isNull() | (r["length"] > b["length"]), r).otherwise(b),
    )
    listed = F.array_join(F.transform(held["runs"], lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    n_runs = F.size(held["runs"])
    out = out.select("doc_id", held.alias("periodic"), best.alias("best"), listed.alias("listed"), n_runs.cast("long").alias("n_runs"))
    return out.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat("listed", F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.text"), 256).alias("collapsed_sha256"),
    )
