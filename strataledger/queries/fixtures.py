"""Shapes the queries work on, each as a DataFrame and as the SQL that says the same.

* audit   - ``events`` read as an audit log of ``user_id``
* hist    - the version history built from it: last event per user and day, changes only
* stored  - ``customer`` as a stored dimension: accounts in debit have not been loaded yet
* batch   - an incoming full batch in which accounts above 9,000 have moved to segment PRIVATE
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import build_scd2

CUT = "2024-01-15"
ORDER_CUT = "1998-07-01"


def day(text: str):
    return F.lit(text).cast("date")


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def hist(t) -> DataFrame:
    return build_scd2(t.events, "user_id", "ts", "event_id", ["event_type"])


HIST = """
hist_last AS (
  SELECT user_id, CAST(ts AS DATE) AS start_date, event_type,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
hist_hash AS (SELECT user_id, start_date, event_type, sha256(event_type) AS row_hash FROM hist_last WHERE rn = 1),
hist_prev AS (
  SELECT *, lag(row_hash, 1, sha256('[Unknown]')) OVER (PARTITION BY user_id ORDER BY start_date) AS prev_hash
  FROM hist_hash),
hist AS (
  SELECT user_id, start_date, event_type, row_hash,
         lead(start_date, 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY start_date) AS end_date,
         CASE WHEN lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) IS NULL THEN 1 ELSE 0 END
           AS current_record
  FROM hist_prev WHERE row_hash <> prev_hash)
"""


def stored(t) -> DataFrame:
    return t.customer.filter("c_acctbal >= 0")


def batch(t) -> DataFrame:
    moved = F.when(F.col("c_acctbal") > 9000, F.lit("PRIVATE")).otherwise(F.col("c_mktsegment"))
    return t.customer.withColumn("c_mktsegment", moved)


STORED = "stored AS (SELECT * FROM customer WHERE c_acctbal >= 0)"
BATCH = """batch AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_acctbal > 9000 THEN 'PRIVATE' ELSE c_mktsegment END AS c_mktsegment FROM customer)"""

TRACKED = ["c_name", "c_nationkey", "c_mktsegment"]


def tracked_hash(prefix: str = "") -> str:
    p = f"{prefix}." if prefix else ""
    return f"sha256(concat({p}c_name, '|', {p}c_nationkey, '|', {p}c_mktsegment))"


# exact: two-digit price times two-digit rate, added up as decimals
def discount_total():
    price, rate = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(4,2)")
    return F.sum(price * rate).cast("decimal(18,4)")


def milestones_stored(t) -> DataFrame:
    """Order milestones as they were loaded at ORDER_CUT: large shipped orders counted as done,
    small shipped ones as cancelled, the rest open; discounts unknown while lines are outstanding."""
    cut = moment(ORDER_CUT)
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        discount_total().alias("d"),
    )
    o = t.orders.filter(F.col("o_orderdate") < cut).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    shipped = F.coalesce(F.col("first_ship") < cut, F.lit(False))
    big = F.col("o_totalprice") >= 250000
    return o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("order_date_key"),
        F.when(shipped, F.date_format("first_ship", "yyyyMMdd").cast("int")).otherwise(-1).alias("closed_date_key"),
        (shipped & big).cast("int").alias("done_count"),
        (shipped & ~big).cast("int").alias("cancel_count"),
        F.when(F.col("last_ship") < cut, F.col("d")).alias("discount_amount"),
        shipped.cast("int").alias("completed"),
    )


def milestones_batch(t) -> DataFrame:
    """The same orders and the later ones as the source tells them now, by order status."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_ship"),
        discount_total().alias("d"),
    )
    o = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    is_closed = F.col("o_orderstatus") != "O"
    return o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("order_date_key"),
        F.when(is_closed & F.col("last_ship").isNotNull(), F.date_format("last_ship", "yyyyMMdd").cast("int"))
        .otherwise(-1).alias("closed_date_key"),
        (F.col("o_orderstatus") == "F").cast("int").alias("done_count"),
        (F.col("o_orderstatus") == "P").cast("int").alias("cancel_count"),
        F.col("d").alias("discount_amount"),
        is_closed.cast("int").alias("completed"),
        "o_orderstatus",
    )


MILESTONES = f"""
lines AS (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS d
  FROM lineitem GROUP BY l_orderkey),
m_tgt AS (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
    CASE WHEN first_ship < TIMESTAMP '{ORDER_CUT}' THEN CAST(strftime(first_ship, '%Y%m%d') AS INTEGER) ELSE -1 END
      AS closed_date_key,
    CASE WHEN first_ship < TIMESTAMP '{ORDER_CUT}' AND o_totalprice >= 250000 THEN 1 ELSE 0 END AS done_count,
    CASE WHEN first_ship < TIMESTAMP '{ORDER_CUT}' AND o_totalprice < 250000 THEN 1 ELSE 0 END AS cancel_count,
    CASE WHEN last_ship < TIMESTAMP '{ORDER_CUT}' THEN d END AS discount_amount,
    CASE WHEN first_ship < TIMESTAMP '{ORDER_CUT}' THEN 1 ELSE 0 END AS completed
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey WHERE o_orderdate < TIMESTAMP '{ORDER_CUT}'),
m_src AS (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
    CASE WHEN o_orderstatus <> 'O' AND last_ship IS NOT NULL THEN CAST(strftime(last_ship, '%Y%m%d') AS INTEGER)
      ELSE -1 END AS closed_date_key,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done_count,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS cancel_count,
    d AS discount_amount,
    CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END AS completed,
    o_orderstatus
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey)
"""
