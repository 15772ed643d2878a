"""Aggregations. All are partial aggregates, combined before the shuffle, so a hot group is cheap."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import money
from .fixtures import HIST, day, hist
from .registry import query

c = F.col


def rows():
    return F.count(F.lit(1))


@query("count_all", "SELECT count(*) AS n FROM lineitem")
def count_all(t):
    return t.lineitem.agg(rows().alias("n"))


@query("count_by_group", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def count_by_group(t):
    return t.orders.groupBy("o_orderstatus").agg(rows().alias("n"))


@query("having_filter", """
SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) AS parts FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1 AND count(DISTINCT l_partkey) > 1""")
def having_filter(t):
    counted = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        rows().alias("n"), F.count_distinct("l_partkey").alias("parts")
    )
    return counted.filter("n > 1 AND parts > 1")


@query("conditional_sum", """
SELECT o_custkey, count(*) AS orders, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
  CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent FROM orders GROUP BY 1""")
def conditional_sum(t):
    return t.orders.groupBy("o_custkey").agg(
        rows().alias("orders"), F.count_if(c("o_orderstatus") == "F").alias("finished"),
        F.count_if(c("o_orderpriority") == "1-URGENT").alias("urgent"),
    )


@query("min_max_by_group", """
SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem
JOIN orders ON o_orderkey = l_orderkey AND l_shipdate > o_orderdate GROUP BY 1""")
def min_max_by_group(t):
    """First and last shipment after the order date, which another table holds."""
    joined = t.lineitem.join(
        t.orders, (c("o_orderkey") == c("l_orderkey")) & (c("l_shipdate") > c("o_orderdate"))
    )
    return joined.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )


@query("max_flag", """
SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS any_purchase,
  min(CASE WHEN value > 1 THEN 1 ELSE 0 END) AS all_above_one FROM events GROUP BY 1""")
def max_flag(t):
    return t.events.groupBy("user_id").agg(
        F.max(F.when(c("event_type") == "purchase", 1).otherwise(0)).alias("any_purchase"),
        F.min(F.when(c("value") > 1, 1).otherwise(0)).alias("all_above_one"),
    )


@query("days_since_last", """
SELECT user_id, CAST(date_diff('day', max(CASE WHEN event_type = 'purchase' THEN ts END), DATE '2024-02-01') AS INTEGER)
  AS days_since FROM events GROUP BY 1""")
def days_since_last(t):
    last = F.max(F.when(c("event_type") == "purchase", c("ts")))
    return t.events.groupBy("user_id").agg(F.datediff(day("2024-02-01"), last).alias("days_since"))


@query("count_distinct", """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1""")
def count_distinct(t):
    return t.orders.groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderdate").alias("days")
    )


@query("select_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority, o_orderdate FROM orders")
def select_distinct(t):
    return t.orders.select("o_orderstatus", "o_orderpriority", "o_orderdate").distinct()


@query("sum_measure", """
SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS gross FROM lineitem GROUP BY 1""")
def sum_measure(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(money(c("l_extendedprice"))).alias("gross"))


@query("two_level_agg", """
WITH g AS (SELECT o_orderstatus, o_custkey, max(o_orderkey) AS last_order, max(l_shipdate) AS last_ship
           FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT o_orderstatus, count(*) AS customers, count(last_ship) AS shipped FROM g GROUP BY 1""")
def two_level_agg(t):
    joined = t.orders.join(t.lineitem, c("o_orderkey") == c("l_orderkey"), "left")
    grain = joined.groupBy("o_orderstatus", "o_custkey").agg(
        F.max("o_orderkey").alias("last_order"), F.max("l_shipdate").alias("last_ship")
    )
    return grain.groupBy("o_orderstatus").agg(rows().alias("customers"), F.count("last_ship").alias("shipped"))


@query("max_per_group_rejoin", """
SELECT o_custkey, o_orderkey AS last_order, o_orderdate, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_custkey)""")
def max_per_group_rejoin(t):
    """The row of the largest id per customer, in one aggregate instead of a join back."""
    top = F.max_by(F.struct("o_orderdate", "o_totalprice"), "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_order"), top.alias("r")).select(
        "o_custkey", "last_order", "r.*"
    )


@query("latest_dim_attribute_count", f"""
WITH {HIST} SELECT count(*) AS active FROM hist WHERE current_record = 1 AND event_type <> 'error'""")
def latest_dim_attribute_count(t):
    return hist(t).filter((c("current_record") == 1) & (c("event_type") != "error")).agg(rows().alias("active"))


@query("order_by_aggregate", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type")
def order_by_aggregate(t):
    return t.events.groupBy("event_type").agg(rows().alias("n")).orderBy(F.desc("n"), "event_type")
