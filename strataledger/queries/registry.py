"""Named queries: a Spark function and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.lake import remove_table, shuffles_freed, table, write_table


class Tables:
    """The given tables of one scale factor: ``t.orders`` and so on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.staged = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        self.__dict__[name] = df = table(self.spark, self.folder, name)  # footers are read once per query
        return df

    def scratch(self) -> str:
        """A new folder for a written table, where driver and executors both see it: the checkpoint folder or the warehouse."""
        conf = self.spark.conf
        shared = conf.get("spark.checkpoint.dir", None) or conf.get("spark.sql.warehouse.dir")
        return f"{shared.rstrip('/')}/strataledger-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write a result that is read several times, as a staging table, and read it back. Its shuffle files go once it is written."""
        path = f"{self.scratch()}/{name}"
        with shuffles_freed(self.spark):
            rows = write_table(df, path)
        self.staged[name] = path
        return rows

    def drop(self, name: str) -> None:
        """Delete a staged table that nothing still to be computed reads; one that was not staged here is left alone."""
        if name in self.staged:
            remove_table(self.spark, self.staged.pop(name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
