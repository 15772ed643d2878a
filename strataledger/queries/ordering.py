"""Sorts, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query

c = F.col


@query("order_multi", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_totalprice DESC")
def order_multi(t):
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy("o_orderdate", F.desc("o_totalprice"))


@query("top_n", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 10""")
def top_n(t):
    rows = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", "c_acctbal")
    return rows.orderBy(F.desc("c_acctbal"), "c_custkey").limit(10)


@query("order_binary", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey")
def order_binary(t):
    return t.part.select("p_partkey", "p_name").orderBy("p_name", "p_partkey")


@query("order_desc_recent", "SELECT event_id, ts FROM events ORDER BY ts DESC")
def order_desc_recent(t):
    return t.events.select("event_id", "ts").orderBy(F.desc("ts"))


@query("union_distinct", """
SELECT c_nationkey AS nation_key FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation""")
def union_distinct(t):
    parts = [t.customer.select(c("c_nationkey").alias("nation_key")), t.supplier.select(c("s_nationkey").alias("nation_key")),
             t.nation.select(c("n_nationkey").alias("nation_key"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@query("union_all", """
SELECT o_orderkey, 'placed' AS step FROM orders UNION ALL SELECT l_orderkey, 'shipped' FROM lineitem""")
def union_all(t):
    placed = t.orders.select("o_orderkey", F.lit("placed").alias("step"))
    return placed.unionByName(t.lineitem.select(c("l_orderkey").alias("o_orderkey"), F.lit("shipped").alias("step")))


@query("union_fill_nulls", """
SELECT event_id, value AS paid, NULL AS failed FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, NULL, value FROM events WHERE event_type = 'error'""")
def union_fill_nulls(t):
    paid = t.events.filter("event_type = 'purchase'").select("event_id", c("value").alias("paid"))
    failed = t.events.filter("event_type = 'error'").select("event_id", c("value").alias("failed"))
    return paid.unionByName(failed, allowMissingColumns=True)
