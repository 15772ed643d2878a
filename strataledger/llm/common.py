"""Helpers shared by the operators: words, row keys, the shared folder, prefix sums, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: what separates words (the complement of ``[^\x20\x09-\x0D]``).
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def trimmed(text: Column) -> Column:
    """Text without leading and trailing blanks; null becomes empty."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))


def words(text: Column) -> Column:
    """Array of words; empty for null, empty and blank texts."""
    t = trimmed(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, BLANK_RUN))


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) decided by the parts' values alone, so that reruns agree; null counts as a value."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(2**52))


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, a temporary one, for a single-machine session only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="strataledger-")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


_SCOPE: ContextVar[list[str] | None] = ContextVar("staged tables of the innermost scope", default=None)


def staged(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write the rows as Parquet in the shared folder and read them back: computed once, no lineage, safe from lost executors.

    Inside a ``scope`` the table goes with it unless it is to be kept; elsewhere it stays, as results not yet read may need it.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    if not keep and _SCOPE.get() is not None:
        _SCOPE.get().append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged in the block are deleted when it ends: for a caller that writes, inside it, all that is built from them.

    Scopes are the caller's own: other threads, queries and enclosing scopes keep theirs.
    """
    own: list[str] = []
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in own:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def spread(rows: DataFrame, tasks: int, most: int = 20_000) -> DataFrame:
    """Rows that each stand for much work, such as files or blocks, dealt evenly to so many tasks.

    The number is stated, since a shuffle of few small rows would otherwise be gathered into one task.
    """
    return rows.repartition(max(1, min(tasks, most)))


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def add_offsets(df: DataFrame, group: list[str], cell: str, value: Column, order: list[Column], total: str,
                per_group: DataFrame | None = None) -> DataFrame:
    """Adds the inclusive running sum of ``value`` per group, without a window over a whole group.

    ``cell`` is a number that rises with the order: rows are summed within (group, cell), and the
    cells' totals, one row each, are summed over the group. Rows must have non-null group columns.
    Columns of ``per_group``, one row a group, come along with the cells' totals; groups it lacks go.
    """
    cells = df.groupBy(*group, cell).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*group, cell, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    if per_group is not None:
        cells = cells.join(per_group, group)
    inside = Window.partitionBy(*group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("_inside", F.sum(value).over(inside)).join(cells, [*group, cell])
    return out.withColumn(total, (F.col("_before") + F.col("_inside")).cast("long")).drop("_before", "_inside")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node reachable.

    Edges (a, b) are replaced by stars, large and small in turn, until nothing changes; each round is
    written to the shared folder. A hub's edges meet its minimum in a join, which adaptive execution
    can split, never in one collected list. Nulls and loops are ignored.
    """

    def stars(e: DataFrame, to_smaller: bool) -> DataFrame:
        if to_smaller:
            near = e
        else:
            near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        met = near.join(low, "a")
        if to_smaller:
            linked = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        else:
            linked = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return linked.where("a <> b").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = staged(e)
    seen = mark(e)
    while seen[0]:
        e = staged(stars(stars(e, False), True))
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
