"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import delete_where
from ..sources import incremental as inc
from ..sources import lake
from .fixtures import moment
from .registry import query

MARK = "2001-01-01"


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(t):
    return lake.read_lake(t.spark, f"{t.folder}/lineitem.parquet")


@query("source_view", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def source_view(t):
    lake.project_source(t.customer, ["c_custkey", "c_name", "c_mktsegment"], "customer_source")
    return t.spark.table("customer_source")


def load_log(t):
    """A load log with one file per order status (member) and order day."""
    return t.orders.select(
        F.col("o_orderstatus").alias("member"),
        F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".parquet")).alias("file_name"),
        "o_orderdate",
    )


@query("register_file", f"""
WITH f AS (SELECT o_orderstatus AS member, 'orders_' || strftime(o_orderdate, '%Y%m%d') || '.parquet' AS file_name,
             o_orderdate FROM orders),
log AS (SELECT DISTINCT member, file_name, 'loaded' AS stage FROM f WHERE o_orderdate < TIMESTAMP '{MARK}'),
entries AS (SELECT DISTINCT member, file_name, 'registered' AS stage FROM f)
SELECT * FROM log
UNION ALL
SELECT * FROM entries e WHERE NOT EXISTS
  (SELECT 1 FROM log l WHERE l.member = e.member AND l.file_name = e.file_name)""")
def register_file(t):
    files = load_log(t)
    log = files.filter(F.col("o_orderdate") < moment(MARK)).drop("o_orderdate").distinct()
    entries = files.drop("o_orderdate").withColumn("stage", F.lit("registered"))
    return lake.register_file(log.withColumn("stage", F.lit("loaded")), entries, ["member", "file_name"], ["stage"])


@query("parse_lake_path", """
SELECT o_orderkey, 'lake/orders' AS root, strftime(o_orderdate, '%Y/%m/%d') AS folder,
       'part-' || o_orderkey || '.parquet' AS file_name FROM orders""")
def parse_lake_path(t):
    name = F.concat(F.lit("part-"), F.col("o_orderkey").cast("string"), F.lit(".parquet"))
    path = lake.dated_path("lake/orders", F.col("o_orderdate"), name)
    parts = lake.parse_lake_path(F.col("path"))
    return t.orders.select("o_orderkey", path.alias("path")).select(
        "o_orderkey", *[c.alias(n) for n, c in parts.items()]
    )


@query("resolve_file_for_run", """
SELECT o_custkey AS member_id, o_orderpriority AS run_id,
       'lake/' || strftime(o_orderdate, '%Y/%m/%d') || '/' || o_orderkey || '.parquet' AS path
FROM orders WHERE o_orderpriority = '1-URGENT'
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def resolve_file_for_run(t):
    log = t.orders.select(
        F.col("o_custkey").alias("member_id"), F.col("o_orderpriority").alias("run_id"), "o_orderdate",
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".parquet")).alias("file_name"),
    )
    members = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("member_id"))
    path = lake.dated_path("lake", F.col("o_orderdate"), F.col("file_name"))
    return lake.files_for_run(log, members, "member_id", F.col("run_id") == "1-URGENT", path).select(
        "member_id", "run_id", "path"
    )


@query("copy_add_columns", """
SELECT c_custkey, c_name, -1 AS contact_key, CAST(NULL AS DECIMAL(18,2)) AS fee_amount,
       c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def copy_add_columns(t):
    added = {"contact_key": F.lit(-1), "fee_amount": F.lit(None).cast("decimal(18,2)")}
    return lake.copy_with_columns(t.customer, added, after="c_name")


@query("incremental_read", f"""
SELECT * FROM orders WHERE o_orderdate >=
  (SELECT max(o_orderdate) - INTERVAL 1 DAY FROM orders WHERE o_orderdate < TIMESTAMP '{MARK}')""")
def incremental_read(t):
    return inc.incremental(t.orders, t.orders.filter(F.col("o_orderdate") < moment(MARK)), "o_orderdate")


@query("late_arrival_pickup", f"""
WITH tgt AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{MARK}' AND o_orderstatus <> 'P'),
batch AS (SELECT * FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 1 DAY FROM tgt))
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.o_orderkey = o.o_orderkey)
  AND NOT EXISTS (SELECT 1 FROM batch WHERE batch.o_orderkey = o.o_orderkey)""")
def late_arrival_pickup(t):
    tgt = t.orders.filter((F.col("o_orderdate") < moment(MARK)) & (F.col("o_orderstatus") != "P"))
    batch = inc.incremental(t.orders, tgt, "o_orderdate")
    return inc.late_arrivals(t.orders, batch, tgt, ["o_orderkey"])


@query("standardise_union", """
SELECT DISTINCT c_nationkey AS nation_key, c_mktsegment AS class, 'customer' AS source FROM customer
UNION
SELECT DISTINCT s_nationkey, CASE WHEN s_acctbal < 0 THEN 'DEBIT' ELSE 'CREDIT' END, 'supplier' FROM supplier""")
def standardise_union(t):
    standing = F.when(F.col("s_acctbal") < 0, "DEBIT").otherwise("CREDIT")
    return lake.standardise([
        (t.customer, {"nation_key": F.col("c_nationkey"), "class": F.col("c_mktsegment")}, "customer"),
        (t.supplier, {"nation_key": F.col("s_nationkey"), "class": standing}, "supplier"),
    ])


@query("append_rows", """
SELECT event_id, ts, user_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN value END AS value FROM events""")
def append_rows(t):
    cut = moment("2024-01-15")
    stored = t.events.filter(F.col("ts") < cut).drop("props")
    return lake.append(stored, t.events.filter(F.col("ts") >= cut).drop("props", "value"))


@query("literal_rows", """
SELECT p_partkey, p_name, p_size FROM part
UNION ALL SELECT -1, '[Unknown]', NULL""")
def literal_rows(t):
    extra = lake.literal_rows(t.spark, [(-1, "[Unknown]", None)], "p_partkey bigint, p_name string, p_size int")
    return t.part.select("p_partkey", "p_name", "p_size").unionByName(extra)


@query("reload_table", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def reload_table(t):
    slim = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return lake.write_table(slim, f"{t.scratch()}/orders")


@query("delete_where", """
SELECT * FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status FROM orders)
WHERE status <> 'P' OR status IS NULL""")
def delete_where_(t):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("status"))
    return delete_where(rows, F.col("status") == "P")


@query("clone_row_with_overrides", """
SELECT CAST(-2 AS BIGINT) AS c_custkey, c_name, c_nationkey, c_acctbal, 'CLONED' AS c_mktsegment FROM customer
WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 1""")
def clone_row_with_overrides(t):
    return lake.clone_row(
        t.customer, F.col("c_mktsegment") == "BUILDING",
        {"c_custkey": F.lit(-2).cast("bigint"), "c_mktsegment": F.lit("CLONED")},
        [F.desc("c_acctbal"), F.col("c_custkey")],
    )
