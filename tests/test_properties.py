"""Properties of histories and loads."""

import datetime as dt

import pytest
from helpers import same
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataledger.operators import checks, history, upsert

AUDIT = "log_id bigint, entity string, ts timestamp_ntz, state string"


def logs():
    row = st.tuples(st.sampled_from("ab"), st.integers(0, 5), st.integers(0, 23), st.sampled_from(["x", "y", "z"]))
    return st.lists(row, min_size=1, max_size=14)


def frame(spark, drawn):
    data = [(i, e, dt.datetime(2024, 1, 1 + d, h), s) for i, (e, d, h, s) in enumerate(drawn)]
    return spark.createDataFrame(data, AUDIT)


def build(df):
    return history.build_scd2(df, "entity", "ts", "log_id", ["state"])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs())
def test_history_is_clean(spark, drawn):
    hist = build(frame(spark, drawn)).cache()
    assert checks.dup_current(hist, "entity").isEmpty()
    assert checks.grain(hist, ["entity", "start_date"]).isEmpty()
    assert checks.gaps_overlaps(hist, "entity").isEmpty()
    assert checks.repeated_hash(hist, "entity", ["start_date"]).isEmpty()


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs(), st.integers(1, 4))
def test_backfill_equals_daily_upserts(spark, drawn, cut):
    log = frame(spark, drawn)
    hist = build(log.filter(F.dayofmonth("ts") <= cut))
    last = history.latest_per_day(log, ["entity"], "ts", "log_id")
    for day in range(cut + 1, 7):
        batch = last.filter(F.dayofmonth("ts") == day).select("entity", "state")
        as_of = F.lit(f"2024-01-{day:02d}").cast("date")
        rows = upsert.upsert_scd2(hist, batch, ["entity"], ["state"], as_of).collect()
        hist = spark.createDataFrame(rows, hist.schema)  # stands for the stored table
    same(hist, build(log).select(*hist.columns))


def test_upserts_are_idempotent(spark, sf):
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    stored, batch = customer.filter("c_acctbal > 0"), customer.withColumn("c_mktsegment", F.upper("c_name"))
    once = upsert.upsert_type1(stored, batch, ["c_custkey"], ["c_mktsegment"])
    same(once, upsert.upsert_type1(once.drop("row_hash"), batch, ["c_custkey"], ["c_mktsegment"]))

    events = spark.read.parquet(f"{sf}/events.parquet")
    hist = history.build_scd2(events, "user_id", "ts", "event_id", ["event_type"])
    state = events.groupBy("user_id").agg(F.max("event_type").alias("event_type"))
    day = F.lit("2024-03-01").cast("date")
    first = upsert.upsert_scd2(hist, state, ["user_id"], ["event_type"], day)
    same(first, upsert.upsert_scd2(first, state, ["user_id"], ["event_type"], F.lit("2024-03-02").cast("date")))
    assert checks.dup_current(first, "user_id").isEmpty() and checks.gaps_overlaps(first, "user_id").isEmpty()
