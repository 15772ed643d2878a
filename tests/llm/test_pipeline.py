"""The pipeline's stages, one after the other, and the registered queries against their SQL."""

import sys
from pathlib import Path

import oracle
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from strataledger.llm import decision_list, queries, simhash_ball, template_windows  # noqa: E402
from strataledger.llm.common import read, staged  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf, name):
    assert oracle.compare(queries.QUERIES[name](spark, sf), oracle.connect(sf), queries.ORACLES[name]) == []


def test_stages(spark, sf):
    docs = read(spark, sf, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, sf), keep=True)
        assert out.count(), name
        if name != "sharding":
            assert out.columns == docs.columns
        kept.append(out)
        docs = out
    quality, single, clean, mixed, sharded = kept
    rules = decision_list.fit(read(spark, sf, "documents"), read(spark, sf, "labels"))
    want = decision_list.judge(read(spark, sf, "documents"), rules).where("kept")
    assert quality.exceptAll(want.select(quality.columns)).isEmpty() and quality.count() == want.count()
    groups = simhash_ball.near_duplicates(quality)
    assert single.count() == groups.select("component_id").distinct().count()
    assert single.join(groups.where("doc_id = component_id"), "doc_id").count() == single.count()
    found = template_windows.matches(single, read(spark, sf, "benchmark")).select("doc_id").distinct()
    assert clean.count() == single.count() - found.count() and clean.join(found, "doc_id", "left_semi").isEmpty()
    copies = mixed.groupBy("doc_id").count()
    assert copies.agg(F.max("count")).first()[0] <= 3 and mixed.join(clean, "doc_id", "left_anti").isEmpty()
    assert sharded.count() == mixed.count() and sharded.groupBy("shard").agg((F.max("slot") + 1 - F.count("slot")).alias("d")).where("d <> 0").isEmpty()
    run = corpus_pipeline.run(spark, sf)
    assert run.exceptAll(sharded).isEmpty() and run.count() == sharded.count()


def test_stages_take_an_empty_table(spark, sf):
    docs = read(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.isEmpty()


def test_stages_take_extra_columns_and_nulls(spark, sf):
    docs = read(spark, sf, "documents").limit(50).withColumns({"shard": F.lit("x"), "_fp": F.lit(1), "stats": F.lit(2), "key1": F.lit(3)})
    null = spark.range(1).select(*[F.lit(None).cast(kind).alias(c) for c, kind in docs.dtypes])
    docs = docs.unionByName(null)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf), keep=True)
    assert docs.count() > 0
