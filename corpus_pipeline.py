"""A corpus pipeline of five stages; each works on all rows its predecessor kept, written as Parquet in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataledger.llm import decision_list, hash_tree, mixing, simhash_ball, template_windows
from strataledger.llm.common import count_words, read, scope, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the decision list keep; the list is learned from the labels."""
    rules = decision_list.fit(docs, read(spark, sf_dir, "labels"))
    return decision_list.judge(docs, rules).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: three-word shingles, two bits."""
    return simhash_ball.keep_one(docs, 3, 2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, re-parameterised ones included."""
    return template_windows.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.take_all(mixing.mix(docs, count_words(F.col("text")))).select(docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their place in it."""
    return hash_tree.shard(docs, hash_tree.topology(24)).drop("grown_shard")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("sharding", shards),
]

#: The learned list, the fingerprints and the template windows have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scope(spark):  # what a stage writes on its way goes once its result is written
            docs = staged(stage(spark, docs, sf_dir), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
