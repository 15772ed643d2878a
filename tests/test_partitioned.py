"""Upserts of touched partitions: the pure function's rows, other partitions' files as they were, and loads that fail at any point."""

from pathlib import Path

import pytest
from helpers import rows, same
from pyspark.sql import functions as F

from strataledger.operators import upsert
from strataledger.sources import partitioned as p


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(1_000).select("id", (F.col("id") * 2).alias("v"), F.concat(F.lit("n"), F.col("id") % 3).alias("name"), p.bucket_of(["id"], 8).alias("part"))
    p.create(df, path, "part")
    return path, df


def batch_of(spark, ids, v=-1):
    return spark.createDataFrame([(i, v, "new") for i in ids], "id long, v long, name string").withColumn("part", p.bucket_of(["id"], 8))


def upserted(stored, batch):
    return upsert.accumulate(stored, batch, ["id"], [{"v": F.col("s_v"), "name": F.col("s_name")}])


def test_rows_and_files(spark, table):
    path, before = table
    batch = batch_of(spark, [3, 4, 5_000])
    parts = {r["part"] for r in batch.collect()}
    was = files(path)
    want = upserted(before, batch)
    done = p.rewrite_partitions(spark, path, "part", batch, F.col("part"), upserted)
    assert sorted(done) == sorted(f"part={x}" for x in parts)
    same(spark.read.parquet(path), want)
    now = files(path)
    assert {f: t for f, t in was.items() if f.split("/")[0] not in done} == {f: t for f, t in now.items() if f.split("/")[0] not in done}
    assert not set(was) & {f for f in now if f.split("/")[0] in done}
    # a rerun changes nothing
    assert p.rewrite_partitions(spark, path, "part", batch, F.col("part"), upserted) == [] and files(path) == now
    assert not (Path(path) / p.STAGED).exists() and not (Path(path) / p.OLD).exists()


def test_only_touched_partitions_are_read(spark, table):
    path, _ = table
    seen = []

    def change(stored, batch):
        seen.extend(r[0].split("/")[-2] for r in stored.select(F.input_file_name()).distinct().collect())
        return upserted(stored, batch)

    batch = batch_of(spark, [3])
    p.rewrite_partitions(spark, path, "part", batch, F.col("part"), change)
    assert set(seen) == {f"part={batch.first()['part']}"}
    assert p.rewrite_partitions(spark, path, "part", batch_of(spark, []), F.col("part"), change) == []


@pytest.mark.parametrize("stop", range(1, 12))
def test_a_load_that_fails_anywhere(spark, table, monkeypatch, stop):
    """The file system fails at its n-th change: the table then has the old rows of all, or gets the new rows of all on recovery."""
    path, before = table
    batch, old = batch_of(spark, range(0, 40), 7), rows(before)
    new = rows(upserted(before, batch))
    count = [0]

    def failing(name):
        plain = getattr(p._Files, name)

        def run(self, *a):
            count[0] += 1
            if count[0] == stop:
                raise OSError("the store is gone")
            return plain(self, *a)

        return run

    with monkeypatch.context() as m:
        for name in ("rename", "delete", "put"):
            m.setattr(p._Files, name, failing(name))
        try:
            p.rewrite_partitions(spark, path, "part", batch, F.col("part"), upserted)
        except OSError:
            pass
    ready = (Path(path) / p.STAGED / p.MARKER).exists()
    p.recover(spark, path)
    spark.catalog.refreshByPath(path)
    got = rows(spark.read.parquet(path), *before.columns)
    assert got in (old, new) and (not ready or got == new)
    p.rewrite_partitions(spark, path, "part", batch, F.col("part"), upserted)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path), *before.columns) == new


def test_partitions_may_empty_and_must_not_be_left(spark, table):
    path, before = table
    batch = batch_of(spark, [3])
    mine = batch.first()["part"]
    assert p.rewrite_partitions(spark, path, "part", batch, F.col("part"), lambda stored, b: stored.filter("false")) == [f"part={mine}"]
    same(spark.read.parquet(path), before.filter(F.col("part") != mine))
    was = files(path)
    with pytest.raises(ValueError, match="other partitions"):
        p.rewrite_partitions(spark, path, "part", batch, F.col("part"), lambda stored, b: upserted(stored, b).withColumn("part", F.lit(int(mine + 1) % 8)))
    with pytest.raises(ValueError, match="no partition"):
        p.rewrite_partitions(spark, path, "part", batch, F.lit(None).cast("int"), upserted)
    assert files(path) == was
