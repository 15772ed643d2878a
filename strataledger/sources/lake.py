"""Lake files: reading, registering, finding and writing."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import key_set
from ..operators.ordered import first_per_key


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """A parquet file or folder with the schema it carries."""
    return spark.read.parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_lake(spark, f"{folder}/{name}.parquet")


def project_source(df: DataFrame, cols: Sequence[str], view: str | None = None) -> DataFrame:
    """Explicit column list over a base table, optionally as a view."""
    out = df.select(*cols)
    if view:
        out.createOrReplaceTempView(view)
    return out


def register_file(log: DataFrame, entries: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Append load-log rows that are not logged yet; of several entries for one key the first by the order."""
    fresh = first_per_key(entries, keys, order).join(key_set(log, keys), [*keys], "left_anti")
    return log.unionByName(fresh, allowMissingColumns=True)


# Fixed value: the dated folder of a lake path.
DATED_FOLDER = r"(\d{4}/\d{2}/\d{2})"


def parse_lake_path(path: Column) -> dict[str, Column]:
    """Root, dated folder and file name of a path cut at its yyyy/mm/dd folder."""
    pattern = r"^(.*?)/?" + DATED_FOLDER + r"/([^/]+)$"
    return {
        "root": F.regexp_extract(path, pattern, 1),
        "folder": F.regexp_extract(path, pattern, 2),
        "file_name": F.regexp_extract(path, pattern, 3),
    }


def dated_path(root: str, day: Column, file_name: Column) -> Column:
    return F.concat(F.lit(root + "/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/"), file_name)


def files_for_run(log: DataFrame, members: DataFrame, key: str, cond: Column, path: Column) -> DataFrame:
    """Paths of the logged files of a run that belong to the given members."""
    hit = log.filter(cond).join(key_set(members, [key]), key, "left_semi")
    return hit.withColumn("path", path)


def copy_with_columns(df: DataFrame, consts: Mapping[str, Column], after: str) -> DataFrame:
    """Copy with constant columns inserted after a given column."""
    order: list[Column | str] = []
    for name in df.columns:
        order.append(name)
        if name == after:
            order.extend(c.alias(n) for n, c in consts.items())
    return df.select(*order)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` and read it back; an error if the rows are read from there."""
    bare = path.split(":", 1)[-1].rstrip("/").lstrip("/") + "/"
    if any(f.split(":", 1)[-1].lstrip("/").startswith(bare) for f in df.inputFiles()):
        raise ValueError(f"{path} is read by the rows that should replace it")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


#: Whether a query's shuffle files go at its end, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run in the block remove their shuffle files when they end: for writes, whose rows nobody asks the same plan for again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def remove_table(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_logged(df: DataFrame, path: str, source: str, run_id: str) -> dict:
    """Write a table and report the load: rows counted while they are written, seconds, status."""
    seen, began = Observation("load"), time.monotonic()
    df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(path)
    return {
        "run_id": run_id, "source": source, "target": path, "n_rows": seen.get["n_rows"],
        "seconds": round(time.monotonic() - began, 3), "status": "Succeeded",
    }


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append(tgt: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert by column name; columns the rows lack are NULL."""
    return tgt.unionByName(rows, allowMissingColumns=True)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame([*rows], schema)


def clone_row(df: DataFrame, cond: Column, overrides: Mapping[str, Column], order: Sequence[Column]) -> DataFrame:
    """The first matching row with some columns overridden."""
    return df.filter(cond).orderBy(*order).limit(1).withColumns(dict(overrides))


def standardise(sources: Sequence[tuple[DataFrame, Mapping[str, Column], str]], tag: str = "source") -> DataFrame:
    """Map several sources to one schema, tag them and unite them without duplicates."""
    out = None
    for df, mapping, name in sources:
        part = df.select(*[c.alias(n) for n, c in mapping.items()], F.lit(name).alias(tag))
        out = part if out is None else out.unionByName(part)
    return out.distinct()
