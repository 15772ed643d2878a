"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most d bits apart have a value within d/2 bits of both. So every distinct
fingerprint emits all variants within half the distance (rounded down and up for an odd d), the
variants are shuffled, and fingerprints that meet on one are deduplicated and verified. A variant's
bucket holds distinct fingerprints of one small ball, whatever the number of documents, so no copy
group or hot key lands there; copies are joined back by fingerprint.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import components, fresh, staged

SEED = 42
ROWS = 1 << 16


def simhash(text: str | None, shingle: int) -> int:
    """Signed 64-bit fingerprint of one text's word shingles, repeats included; 0 without words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], ends + 1)).tolist()
    ends = ends.tolist() + [len(joined)]
    size, digest = min(shingle, len(tokens)), xxhash.xxh64_digest
    counts, n = np.zeros(64, np.int64), len(tokens) - size + 1
    for at in range(0, n, ROWS):
        spans = zip(starts[at : min(at + ROWS, n)], ends[at + size - 1 : min(at + ROWS, n) + size - 1], strict=True)
        hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint column (long): a bit is 1 if set in over half the shingles' XXH64; A-Z are lower-cased first.

    Fewer words than a shingle: the whole sequence is the one shingle. Null or blank text: 0.
    """

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of(text)


def ball(prints: DataFrame, flips: int) -> DataFrame:
    """(fp, variant, flips): every value at most so many bits from fp, itself included."""
    level = prints.select("fp", F.col("fp").alias("variant"), F.lit(0).alias("flips"), F.lit(-1).alias("last"))
    out = level
    for k in range(1, flips + 1):
        level = level.where("last < 63").select("fp", "variant", F.explode(F.sequence(F.col("last") + 1, F.lit(63))).alias("last"))
        level = level.select("fp", F.expr("variant ^ shiftleft(1L, last)").alias("variant"), F.lit(k).alias("flips"), "last")
        out = out.unionByName(level)
    return out.drop("last")


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints ``fp`` that keep exactly what reaches what within the distance.

    In a bucket, all that lie within the smaller half-radius of the variant link to their minimum, and so does all
    within the larger one: each such pair is at most ``distance`` apart, and pairs beyond are linked through it.
    """
    low, high = distance // 2, distance - distance // 2
    inner = F.min(F.when(F.col("flips") <= low, F.col("fp"))).over(Window.partitionBy("variant"))
    met = ball(prints.select("fp").distinct(), high).select("fp", inner.alias("anchor"))
    pairs = met.where("anchor is not null and anchor <> fp")
    pairs = pairs.select(F.least("anchor", "fp").alias("a"), F.greatest("anchor", "fp").alias("b")).distinct()
    return pairs.where(F.bit_count(F.expr("a ^ b")) <= distance)


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``: its fingerprint and the smallest doc_id reachable over links.

    Null texts have fingerprint 0 and are linked like any other; null ids count as no id (a component of nulls only has
    a null id); repeated rows stay; an empty table gives an empty one. Columns beyond the two named are not read.
    """
    rows = staged(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp")))
    return rows.join(groups(rows, distance), "fp", "left").select("doc_id", "fp", "component_id")


def groups(rows: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of (doc_id, fp), as a written table."""
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(prints, distance)).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = staged(rooted)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return staged(rooted.join(least, "root").select("fp", "root", "component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all columns of ``docs``: the smallest id, null ids last, any one of equal rows."""
    fp, rid = fresh(docs, "_fp"), fresh(docs, "_rid")
    rows = staged(docs.withColumn(fp, fingerprint(F.col(text), shingle)).withColumn(rid, F.monotonically_increasing_id()))
    slim = rows.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"), F.col(rid).alias("rid"))
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "rid")
    per_print = staged(slim.groupBy("fp").agg(F.min(rank).alias("best")))
    rooted = staged(per_print.join(groups(slim, distance), "fp").select("fp", "root", "best"))
    best = rooted.groupBy("root").agg(F.min("best").alias("best")).select("root", F.col("best.rid").alias("best_rid"))
    goes = slim.join(staged(rooted.join(best, "root").select("fp", "best_rid")), "fp").where("rid <> best_rid")
    lost = staged(goes.select(F.col("rid").alias(rid)))  # the rows that go: in a corpus, fewer than those that stay
    return rows.join(lost, rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
