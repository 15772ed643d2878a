"""Predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as f
from .fixtures import moment
from .registry import query

c = F.col


@query("filter_eq_ne", """
SELECT o_orderkey, status FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status, o_orderpriority FROM orders)
WHERE status <> 'P' AND o_orderpriority = '1-URGENT'""")
def filter_eq_ne(t):
    rows = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("O")))
    return rows.filter((c("status") != "P") & (c("o_orderpriority") == "1-URGENT")).select("o_orderkey", "status")


@query("filter_in_list", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')""")
def filter_in_list(t):
    return t.orders.filter(
        c("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~c("o_orderstatus").isin("P")
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("filter_between", """
SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE date_diff('day', o_orderdate, l_shipdate) BETWEEN 0 AND CAST(l_quantity AS INTEGER)""")
def filter_between(t):
    joined = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))
    gap = F.datediff("l_shipdate", "o_orderdate")
    return joined.filter(gap.between(F.lit(0), c("l_quantity").cast("int"))).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate"
    )


@query("filter_like", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR left(p_name, 3) = 'red'""")
def filter_like(t):
    return t.part.filter(c("p_name").like("%ring%") | c("p_name").startswith("red")).select("p_partkey", "p_name")


@query("filter_null", """
SELECT o_orderkey, l_orderkey IS NULL AS bare FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem)
  ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL AND o_orderpriority IS NOT NULL""")
def filter_null(t):
    keys = t.lineitem.select("l_orderkey").distinct()
    joined = t.orders.join(keys, c("o_orderkey") == c("l_orderkey"), "left")
    return joined.filter(c("l_orderkey").isNull() & c("o_orderpriority").isNotNull()).select(
        "o_orderkey", c("l_orderkey").isNull().alias("bare")
    )


@query("filter_or_groups", """
SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey
WHERE (o_orderstatus = 'F' AND c_mktsegment = 'BUILDING') OR (c_acctbal < 0) OR (o_totalprice > 400000)""")
def filter_or_groups(t):
    joined = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    return joined.filter(
        ((c("o_orderstatus") == "F") & (c("c_mktsegment") == "BUILDING"))
        | (c("c_acctbal") < 0) | (c("o_totalprice") > 400000)
    ).select("o_orderkey", "c_custkey")


@query("filter_default_null", """
SELECT o_orderkey, status FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status FROM orders)
WHERE coalesce(status, '[Unknown]') <> 'P'""")
def filter_default_null(t):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("status"))
    return rows.filter(f.keep_unknown(c("status") != "P"))


@query("filter_in_subquery", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey HAVING count(*) > 2)""")
def filter_in_subquery(t):
    busy = t.orders.filter("o_orderstatus = 'F'").groupBy(c("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter("n > 2")
    return f.in_subquery(t.customer, busy, ["c_custkey"]).select("c_custkey", "c_name")


@query("filter_exclude_list", """
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS
  (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""")
def filter_exclude_list(t):
    excluded = t.customer.filter("c_acctbal < 0").select(c("c_custkey").alias("o_custkey"))
    return f.exclude_list(t.orders, excluded, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("filter_cutover", """
WITH moves AS (SELECT c_custkey AS k, TIMESTAMP '1997-01-01' + to_days(c_nationkey * 40) AS moved_on
               FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT o_orderkey, o_custkey, o_orderdate, 'old' AS system FROM orders LEFT JOIN moves ON o_custkey = k
WHERE o_orderpriority <> '5-LOW' AND (moved_on IS NULL OR o_orderdate < moved_on)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, 'new' FROM orders JOIN moves ON o_custkey = k
WHERE o_orderpriority <> '1-URGENT' AND o_orderdate >= moved_on""")
def filter_cutover(t):
    """Two systems that both hold most orders; each customer moved on a date of its own."""
    moves = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        c("c_custkey").alias("o_custkey"),
        F.date_add(moment("1997-01-01").cast("date"), c("c_nationkey") * 40).cast("timestamp_ntz").alias("moved_on"),
    )
    cols = ["o_orderkey", "o_custkey", "o_orderdate"]
    old = t.orders.filter("o_orderpriority <> '5-LOW'").select(*cols)
    new = t.orders.filter("o_orderpriority <> '1-URGENT'").select(*cols)
    return f.cutover(old, new, moves, "o_custkey", "o_orderdate", "moved_on")


@query("filter_collation", """
SELECT p_partkey, p_type, lower(p_type) = 'promo' AS same_ci, p_type = 'promo' AS same_cs FROM part
WHERE lower(p_type) = 'promo' OR p_brand = 'Brand#1'""")
def filter_collation(t):
    ci = F.lower("p_type") == "promo"
    return t.part.filter(ci | (c("p_brand") == "Brand#1")).select(
        "p_partkey", "p_type", ci.alias("same_ci"), (c("p_type") == "promo").alias("same_cs")
    )


@query("filter_before_today", """
SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20'""")
def filter_before_today(t):
    """The partial day of the run date and later rows are left out; the date is an argument."""
    return t.events.filter(c("ts") < moment("2024-01-20")).select("event_id", "ts")
