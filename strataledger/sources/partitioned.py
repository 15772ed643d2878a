"""Upserts that rewrite only the partitions a batch touches.

A table is Parquet in folders by one partition column, whose value follows from a row's key (or is one of its columns). A batch names the
partitions it touches; only these are read, changed by a pure function of (stored rows, batch) and written to a staging folder beside the table. Then
they are swapped in, each by renaming its old folder away and its new one to its place. A marker, written when all staged rows are there, says what is
to be swapped: a load that failed before it leaves the table as it was, one that failed after it is finished by ``recover``, at any point and
any number of times. Partitions whose rows did not change are not touched, so a rerun changes nothing.

One writer at a time; readers that began before a swap must begin anew, as with any rewritten Parquet table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STAGED, OLD, MARKER = "_staged", "_old", "_ready.json"  # names with an underscore are no data to Spark


class _Files:
    """The table's file system, whatever the store."""

    def __init__(self, spark: SparkSession, path: str):
        self.of = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.jvm = spark._jvm

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.of(path))

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.of(path))] if self.exists(path) else []

    def rename(self, a: str, b: str) -> None:
        self.fs.mkdirs(self.of(b).getParent())
        if not self.fs.rename(self.of(a), self.of(b)):
            raise OSError(f"could not rename {a} to {b}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.of(path), True)

    def put(self, path: str, text: str) -> None:
        """Written beside and renamed, so it is there as a whole or not at all."""
        out = self.fs.create(self.of(path + ".tmp"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.rename(path + ".tmp", path)

    def get(self, path: str) -> str:
        stream = self.fs.open(self.of(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def create(df: DataFrame, path: str, partition: str) -> None:
    """A new table; rows are dealt by partition, so that each is written by as few tasks as its rows need."""
    df.repartition(partition).write.partitionBy(partition).parquet(path)


def recover(spark: SparkSession, path: str) -> list[str]:
    """Finishes the swap that an earlier load left behind, or clears what it staged in vain; the partitions swapped."""
    files = _Files(spark, path)
    marker = f"{path}/{STAGED}/{MARKER}"
    done = []
    if files.exists(marker):
        for folder in json.loads(files.get(marker))["partitions"]:
            new, old, place = f"{path}/{STAGED}/data/{folder}", f"{path}/{OLD}/{folder}", f"{path}/{folder}"
            if files.exists(new):
                # a place that has the old rows gives way first; one already cleared by a failed attempt is filled
                if files.exists(place):
                    files.delete(old)
                    files.rename(place, old)
                files.rename(new, place)
                done.append(folder)
        for folder in json.loads(files.get(marker))["emptied"]:
            files.delete(f"{path}/{folder}")
    files.delete(f"{path}/{STAGED}")
    files.delete(f"{path}/{OLD}")
    return done


def _digests(df: DataFrame, partition: str) -> dict:
    """Order-free digest of each partition's rows: equal rows in equal number give equal digests."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in sorted(df.columns)]
    h = F.xxhash64(*cols)
    g = df.groupBy(partition).agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(7), *cols)))
    return {r[0]: tuple(r[1:]) for r in g.collect()}  # one row for each partition touched


def rewrite_partitions(
    spark: SparkSession, path: str, partition: str, batch: DataFrame, of: Column, change: Callable[[DataFrame, DataFrame], DataFrame],
) -> list[str]:
    """Replaces the partitions that the batch's rows belong to by ``change(stored rows of these partitions, batch)``; the folders rewritten.

    ``of`` gives a batch row's partition; ``change`` is any of the upserts, keeps the table's columns and gives rows of these partitions only, or an
    error is raised before anything is swapped. A key must not change its partition. Batch rows without a partition are an error too.
    """
    recover(spark, path)
    files = _Files(spark, path)
    named = batch.withColumn("_partition", of)
    touched = [r[0] for r in named.select("_partition").distinct().collect()]  # partitions, not rows
    if not touched:
        return []
    if None in touched:
        raise ValueError("a batch row belongs to no partition")
    table = spark.read.parquet(path)
    stored = table.filter(F.col(partition).isin(touched))
    after = change(stored, batch).select(*table.columns)
    staging = f"{path}/{STAGED}/data"
    after.repartition(partition).write.partitionBy(partition).parquet(staging)
    staged = spark.read.schema(table.schema).parquet(staging) if files.names(staging) != ["_SUCCESS"] else spark.createDataFrame([], table.schema)
    was, now = _digests(stored, partition), _digests(staged, partition)
    if set(now) - set(touched):
        files.delete(f"{path}/{STAGED}")
        raise ValueError(f"the change gives rows of other partitions: {sorted(set(now) - set(touched))[:3]}")
    changed = [v for v in now if was.get(v) != now[v]]
    by_value = {v: folder for folder in files.names(staging) if "=" in folder for v in touched if folder == f"{partition}={v}"}
    swap = {"partitions": sorted(by_value[v] for v in changed), "emptied": sorted(f"{partition}={v}" for v in set(was) - set(now))}
    files.put(f"{path}/{STAGED}/{MARKER}", json.dumps(swap))
    recover(spark, path)
    return [*swap["partitions"], *swap["emptied"]]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A partition that follows from the key alone, for tables without a natural one."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
