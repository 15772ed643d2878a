"""Scalar functions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions import numbers as nu
from ..functions import text as tx
from ..functions.hashing import joined_text, row_hash
from .fixtures import day
from .registry import query

c = F.col


@query("fn_concat", """
SELECT o_orderkey, concat(o_orderkey, '|', nullif(o_orderstatus, 'O'), '|', o_orderpriority) AS text FROM orders""")
def fn_concat(t):
    parts = [c("o_orderkey"), F.nullif("o_orderstatus", F.lit("O")), c("o_orderpriority")]
    return t.orders.select("o_orderkey", joined_text(parts).alias("text"))


@query("fn_trim", "SELECT p_partkey, trim('  ' || p_name || ' ') AS text FROM part")
def fn_trim(t):
    return t.part.select("p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("text"))


@query("fn_left_right", """
SELECT p_partkey, left(p_name, 3) AS head, right(trim(p_name), 2) AS tail FROM part""")
def fn_left_right(t):
    return t.part.select("p_partkey", F.left("p_name", F.lit(3)).alias("head"), tx.last_chars(c("p_name"), 2).alias("tail"))


@query("fn_substring_index", """
SELECT o_orderkey, substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) AS label,
       split_part(o_orderpriority, '-', 1) AS code FROM orders""")
def fn_substring_index(t):
    text = c("o_orderpriority")
    return t.orders.select("o_orderkey", tx.after_first(text, "-").alias("label"), tx.before_first(text, "-").alias("code"))


@query("fn_replace", "SELECT p_partkey, replace(p_brand, '#', ' no. ') AS brand FROM part")
def fn_replace(t):
    return t.part.select("p_partkey", F.replace("p_brand", F.lit("#"), F.lit(" no. ")).alias("brand"))


@query("fn_format_number", """
SELECT o_orderkey, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS mm, lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0')
  AS dd FROM orders""")
def fn_format_number(t):
    return t.orders.select(
        "o_orderkey", tx.zero_padded(F.month("o_orderdate"), 2).alias("mm"), tx.zero_padded(F.day("o_orderdate"), 2).alias("dd")
    )


@query("fn_row_hash", """
SELECT o_orderkey, sha256(concat(o_custkey, '|', nullif(o_orderstatus, 'O'), '|', CAST(o_totalprice AS DECIMAL(18,2)), '|',
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'))) AS row_hash FROM orders""")
def fn_row_hash(t):
    rows = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    cols = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return rows.select("o_orderkey", row_hash(rows, cols, money=True).alias("row_hash"))


@query("fn_local_date", """
SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS local_day FROM events""")
def fn_local_date(t):
    return t.events.select("event_id", d.local_date(c("ts")).alias("local_day"))


@query("fn_date_add", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 90 AS DATE) AS due, o_orderdate - INTERVAL 1 DAY AS eve FROM orders""")
def fn_date_add(t):
    return t.orders.select(
        "o_orderkey", F.date_add("o_orderdate", 90).alias("due"),
        (c("o_orderdate") - F.expr("interval 1 day")).alias("eve"),
    )


@query("fn_add_months", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) AS matures FROM orders""")
def fn_add_months(t):
    return t.orders.select("o_orderkey", F.add_months("o_orderdate", 12).alias("matures"))


@query("fn_datediff_days", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def fn_datediff_days(t):
    return t.lineitem.join(t.orders, c("o_orderkey") == c("l_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        d.days_between(c("o_orderdate"), c("l_shipdate")).alias("days"),
    )


@query("fn_datediff_months", """
SELECT o_orderkey, CAST(date_diff('month', o_orderdate, DATE '2001-08-01') AS INTEGER) AS months FROM orders""")
def fn_datediff_months(t):
    return t.orders.select("o_orderkey", d.months_crossed(c("o_orderdate"), day("2001-08-01")).alias("months"))


@query("fn_truncate_day", "SELECT event_id, date_trunc('day', ts) AS midnight, CAST(ts AS DATE) AS day FROM events")
def fn_truncate_day(t):
    # date_trunc on a zone-less timestamp would return a zoned one
    return t.events.select("event_id", d.day_start(c("ts")).alias("midnight"), F.to_date("ts").alias("day"))


@query("fn_year_month_day", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(day(o_orderdate) AS INTEGER) AS d FROM orders""")
def fn_year_month_day(t):
    return t.orders.select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.day("o_orderdate").alias("d")
    )


@query("fn_age_years", """
SELECT o_orderkey, CAST(floor(date_diff('day', o_orderdate, DATE '2024-01-30') / 365.25) AS INTEGER) AS years FROM orders""")
def fn_age_years(t):
    return t.orders.select("o_orderkey", d.age_years(c("o_orderdate"), day("2024-01-30")).alias("years"))


@query("fn_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def fn_date_key(t):
    return t.orders.select("o_orderkey", d.date_key(c("o_orderdate")).alias("date_key"))


@query("fn_abs_floor", """
SELECT c_custkey, abs(c_acctbal) AS size, CAST(floor(c_acctbal) AS BIGINT) AS whole FROM customer""")
def fn_abs_floor(t):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("size"), F.floor("c_acctbal").alias("whole"))


@query("fn_decimal_divide", """
WITH a AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS amount,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents, 4 + c_nationkey AS q FROM customer)
SELECT c_custkey, amount, CAST(CAST(sign(cents) * ((2 * abs(cents) * 4 + q) // (2 * q)) AS DECIMAL(18,0)) * 0.01
  AS DECIMAL(18,2)) AS converted FROM a""")
def fn_decimal_divide(t):
    rate = F.lit(1) + c("c_nationkey") / F.lit(4)
    return t.customer.select(
        "c_custkey", nu.money(c("c_acctbal")).alias("amount"), nu.converted(c("c_acctbal"), rate).alias("converted")
    )


@query("fn_try_cast", """
SELECT o_orderkey, try_cast(left(o_orderpriority, 1) AS INTEGER) AS code, try_cast(o_orderpriority AS INTEGER) AS whole,
  CASE WHEN try_cast(o_orderpriority AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END AS is_number FROM orders""")
def fn_try_cast(t):
    text = c("o_orderpriority")
    return t.orders.select(
        "o_orderkey", nu.try_int(F.left(text, F.lit(1))).alias("code"), nu.try_int(text).alias("whole"),
        nu.is_numeric(text).alias("is_number"),
    )


@query("fn_isdate_guard", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE o_orderpriority END AS text,
  nullif(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, 0) AS is_date FROM orders""")
def fn_isdate_guard(t):
    text = F.when(c("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(c("o_orderpriority"))
    return t.orders.select(
        "o_orderkey", text.alias("text"), F.nullif(nu.is_date(text), F.lit(0)).alias("is_date")
    )


@query("fn_coalesce", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), nullif(o_orderpriority, '5-LOW'), '[Unknown]') AS label FROM orders""")
def fn_coalesce(t):
    return t.orders.select("o_orderkey", F.coalesce(
        F.nullif("o_orderstatus", F.lit("O")), F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("[Unknown]")
    ).alias("label"))


@query("fn_tenure_months_udf", """
SELECT o_orderkey, CAST(greatest(date_diff('month', DATE '1997-03-15', o_orderdate), 0) AS INTEGER) AS tenure FROM orders""")
def fn_tenure_months_udf(t):
    return t.orders.select("o_orderkey", d.tenure_months(day("1997-03-15"), c("o_orderdate")).alias("tenure"))


@query("fn_json_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def fn_json_extract(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))
