"""What the transaction fact keeps on disk: whole rows are shuffled once for a step, and a step's shuffle files go when its rows are written."""

import datetime as dt
import os
import time

import pytest
from helpers import rows, same
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strataledger.operators.filters import cutover
from strataledger.queries import facts
from strataledger.queries.registry import Tables


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "shuffle_" in f}


def test_shuffle_files_go_once_a_table_is_staged(spark, sf):
    t = Tables(spark, sf)
    before = shuffle_files(spark)
    staged = t.stage(t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")), "counted")
    for _ in range(50):  # they are removed in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and staged.agg(F.sum("n")).first()[0] == t.lineitem.count()


def test_dropped_tables_go_and_others_stay(spark, sf):
    t = Tables(spark, sf)
    t.stage(t.nation, "gone")
    kept, path = t.stage(t.region, "kept"), t.staged["gone"].removeprefix("file:")
    assert os.path.isdir(path)
    t.drop("gone")
    t.drop("orders")  # not staged: left alone
    assert not os.path.isdir(path) and kept.count() == t.region.count() and t.orders.count()


def exchanges_above(plan, scan):
    """For each scan of a table, the number of exchanges between it and the plan's root."""
    lines, out = plan.split("== Initial Plan ==")[-1].splitlines(), []

    def depth(line):
        return min((line.find(x) for x in ("+- ", ":- ") if x in line), default=0)

    for i, line in enumerate(lines):
        if f"{scan}.parquet" in line:
            at, n = depth(line), 0
            for above in reversed(lines[:i]):
                if depth(above) < at:
                    at, n = depth(above), n + ("Exchange" in above)
            out.append(n)
    return out


def test_lines_are_shuffled_once_to_become_flows(spark, sf):
    plan = facts.flows(Tables(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert exchanges_above(plan, "lineitem") == [1]


def test_the_fact_is_built_from_staged_steps(spark, sf):
    """The last plan reads what the steps before it wrote, not the sources again, and what no step reads any more is gone."""
    found = {}

    class Seen(Tables):
        def stage(self, df, name):
            df = super().stage(df, name)
            found[name] = self.staged[name].removeprefix("file:")
            return df

    df = facts.transaction_fact(Seen(spark, sf))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "l_shipdate" not in plan and "o_orderdate" not in plan and "c_custkey" not in plan
    assert {n for n, path in found.items() if os.path.isdir(path)} == {"stored", "rows"} < set(found)
    assert df.count() == entry.queries()["transaction_fact"](spark, sf).count()


@pytest.mark.parametrize("copies", [1, 2])
def test_cutover_of_one_table_is_that_of_two(spark, copies):
    """A row that both systems hold, none holds or the moves do not know; a move without a date; a key that moved twice; NULLs."""
    days = [None, *(dt.date(2024, 1, n) for n in (1, 5, 9))]
    data = [(n, k, d, p) for n, (k, d, p) in enumerate((k, d, p) for k in (None, 1, 2, 3, 4) for d in days for p in (None, "a", "b", "c"))]
    every = spark.createDataFrame(data, "id int, who int, day date, held_by string")
    moves = spark.createDataFrame([(1, days[2]), (2, None), (3, days[1])] * copies, "who int, moved_on date")
    in_old, in_new = F.col("held_by") != "b", F.col("held_by") != "a"
    two = cutover(every.filter(in_old), every.filter(in_new), moves, "who", "day", "moved_on")
    one = cutover(every, None, moves, "who", "day", "moved_on", held=(in_old, in_new))
    assert same(one, two) and rows(one)[(5, None, days[1], "a", "old")] == 1
    want = {("c", "old"), ("c", "new")}
    assert {(r["held_by"], r["system"]) for r in one.filter("held_by = 'c'").collect()} == want
