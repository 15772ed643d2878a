"""Session set-up shared by the bench, the tests and jobs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join task well before it stops fitting in an executor
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
}


def session(app: str = "strataledger", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; a cluster's own master and checkpoint folder win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        cores = "".join(c for c in master if c.isdigit()) or str(os.cpu_count() or 8)
        builder = builder.config("spark.sql.shuffle.partitions", cores)
    for key, value in {**CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
