"""Projections and scalar mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..defaults import UNKNOWN_KEY, UNKNOWN_TEXT
from ..functions.numbers import flag
from ..functions.text import after_first, before_first
from ..operators import project as p
from .registry import query


@query("project_alias", """
SELECT o_orderkey AS order_key, o_orderdate AS ordered_at, o_custkey AS customer_key FROM orders""")
def project_alias(t):
    return p.project_alias(
        t.orders, {"o_orderkey": "order_key", "o_orderdate": "ordered_at", "o_custkey": "customer_key"}
    )


@query("case_map", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' AND p_size < 10 THEN 'small promotion'
  WHEN p_type = 'PROMO' THEN 'promotion' WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'house brand'
  WHEN p_size >= 40 OR p_retailprice > 1000 THEN 'bulky or dear' ELSE 'other' END AS part_class FROM part""")
def case_map(t):
    c = F.col
    return t.part.select("p_partkey", p.case_map([
        ((c("p_type") == "PROMO") & (c("p_size") < 10), "small promotion"),
        (c("p_type") == "PROMO", "promotion"),
        (c("p_brand").isin("Brand#1", "Brand#2"), "house brand"),
        ((c("p_size") >= 40) | (c("p_retailprice") > 1000), "bulky or dear"),
    ], "other").alias("part_class"))


@query("priority_waterfall", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN 30 END, CASE WHEN c_mktsegment = 'BUILDING' THEN 60 END,
  CASE WHEN c_acctbal > 5000 THEN 180 END, 90) AS contact_days FROM customer""")
def priority_waterfall(t):
    rules = [
        F.when(F.col("c_acctbal") < 0, 30),
        F.when(F.col("c_mktsegment") == "BUILDING", 60),
        F.when(F.col("c_acctbal") > 5000, 180),
    ]
    return t.customer.select("c_custkey", p.waterfall(rules, 90).alias("contact_days"))


@query("default_unknown", """
SELECT l_orderkey, l_linenumber, coalesce(p_partkey, -1) AS p_partkey, coalesce(p_brand, '[Unknown]') AS p_brand,
       coalesce(ready, DATE '1900-01-01') AS ready
FROM lineitem LEFT JOIN (SELECT p_partkey, p_brand, DATE '2000-01-01' AS ready FROM part WHERE p_size > 25)
  ON l_partkey = p_partkey""")
def default_unknown(t):
    side = t.part.filter("p_size > 25").select(
        "p_partkey", "p_brand", F.lit("2000-01-01").cast("date").alias("ready")
    )
    joined = t.lineitem.join(side, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        "l_orderkey", "l_linenumber", "p_partkey", "p_brand", "ready"
    )
    return p.fill_unknown(
        joined, {"p_partkey": UNKNOWN_KEY, "p_brand": UNKNOWN_TEXT, "ready": "1900-01-01"}
    )


@query("conditional_replace", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'REPAIRED' ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS c_name FROM customer""")
def conditional_replace(t):
    fix = t.customer.filter("c_acctbal < 0").select(
        "c_custkey", F.lit("REPAIRED").alias("c_mktsegment"), F.lit(None).cast("string").alias("c_name")
    )
    base = t.customer.select("c_custkey", "c_mktsegment", "c_name")
    return p.replace_if_match(base, fix, ["c_custkey"], ["c_mktsegment", "c_name"])


@query("sign_by_code", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CASE WHEN l_linestatus = 'F' THEN 1 ELSE -1 END)
    * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS DECIMAL(18,2)) AS signed_amount FROM lineitem""")
def sign_by_code(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        p.signed_amount(F.col("l_extendedprice"), F.col("l_linestatus"), ["F"], F.col("l_returnflag") == "R")
        .alias("signed_amount"),
    )


@query("code_to_flag", """
SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 1 ELSE 0 END AS is_finished,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_pressing FROM orders""")
def code_to_flag(t):
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select(
        "o_orderkey", flag(status == "F").alias("is_finished"),
        flag(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("is_pressing"),
    )


@query("json_rows", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, NULL FROM events WHERE event_type = 'error'""")
def json_rows(t):
    """Two elements per event, none for errors, whose parent row stays."""
    text = F.when(F.col("event_type") == "error", "[]").otherwise(
        F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]"))
    )
    rows = t.events.select("event_id", text.alias("items"))
    return p.json_to_rows(rows, "items", "k int", {"k": "k"}).select("event_id", "k")


@query("unpivot_columns", """
SELECT p_partkey, 1 AS ordinal, p_brand AS topic FROM part
UNION ALL SELECT p_partkey, 2, nullif(p_type, 'PROMO') FROM part WHERE p_type <> 'PROMO'
UNION ALL SELECT p_partkey, 3, p_name FROM part""")
def unpivot_columns(t):
    rows = t.part.withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return p.unpivot_columns(rows, ["p_partkey"], ["p_brand", "p_type", "p_name"], value="topic")


@query("split_to_rows", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def split_to_rows(t):
    return p.split_to_rows(t.part.select("p_partkey", "p_name"), "p_name", " ", "word")


@query("derive_dimension", """
SELECT DISTINCT CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_key,
  substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) AS priority FROM orders""")
def derive_dimension(t):
    full = p.derive_dimension(
        t.orders, F.col("o_orderpriority"), before_first(F.col("full"), "-"), "priority_key", "full"
    )
    return full.select("priority_key", after_first(F.col("full"), "-").alias("priority"))
