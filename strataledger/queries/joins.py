"""Equality joins, existence tests, id matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import last_chars
from ..operators import joins as j
from .fixtures import moment
from .registry import query

c = F.col


@query("inner_equi", """
SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def inner_equi(t):
    return (
        t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
        .join(t.nation, c("c_nationkey") == c("n_nationkey"))
        .join(t.region, c("n_regionkey") == c("r_regionkey"))
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query("dim_key_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_partkey, -1) AS part_key
FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON l_partkey = p_partkey""")
def dim_key_lookup(t):
    """Parts up to size 10 are not in the dimension and get the unknown member."""
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return j.lookup_key(fact, t.part.filter("p_size > 10"), {"l_partkey": "p_partkey"}, "p_partkey", "part_key")


@query("left_anti_isnull", """
SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL""")
def left_anti_isnull(t):
    lines = t.lineitem.select(c("l_orderkey").alias("o_orderkey"))
    return j.missing(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@query("left_anti_notexists", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')""")
def left_anti_notexists(t):
    return j.not_exists(
        t.customer.select("c_custkey", "c_name"), t.orders, {"c_custkey": "o_custkey"},
        c("o_orderdate") >= moment("2001-01-01"),
    )


@query("left_semi_reduce", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_acctbal < 0
   UNION SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def left_semi_reduce(t):
    in_debit = t.customer.filter("c_acctbal < 0").select(c("c_custkey").alias("o_custkey"))
    large = t.orders.filter("o_totalprice > 450000")
    return j.reduce_to_keys(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", in_debit, large)


@query("junk_dim_lookup", """
WITH pairs AS (SELECT DISTINCT o_orderstatus AS status, CASE WHEN o_orderpriority < '3' THEN 'pressing' ELSE 'usual' END
               AS pace FROM orders WHERE o_orderstatus <> 'P'),
dim AS (SELECT status, pace, (CASE status WHEN 'O' THEN 10 WHEN 'F' THEN 20 END)
          + (CASE pace WHEN 'pressing' THEN 1 ELSE 2 END) AS combo_key FROM pairs)
SELECT o_orderkey, coalesce(combo_key, -1) AS combo_key FROM orders LEFT JOIN dim
  ON o_orderstatus = status AND pace = CASE WHEN o_orderpriority < '3' THEN 'pressing' ELSE 'usual' END""")
def junk_dim_lookup(t):
    """The combination dimension lacks status P."""
    pace = F.when(c("o_orderpriority") < "3", "pressing").otherwise("usual")
    pairs = t.orders.filter("o_orderstatus <> 'P'").select(c("o_orderstatus").alias("status"), pace.alias("pace")).distinct()
    key = F.when(c("status") == "O", 10).when(c("status") == "F", 20) + F.when(c("pace") == "pressing", 1).otherwise(2)
    dim = pairs.withColumn("combo_key", key)
    return j.lookup_by_labels(t.orders, dim, {"status": c("o_orderstatus"), "pace": pace}, "combo_key").select(
        "o_orderkey", "combo_key"
    )


@query("code_label_decode", """
WITH coded AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS status_code,
                 CAST(left(o_orderpriority, 1) AS INTEGER) AS priority_code FROM orders)
SELECT o_orderkey, status_code, priority_code,
  CASE status_code WHEN 1 THEN 'O' WHEN 2 THEN 'F' ELSE '[Unknown]' END AS status,
  (SELECT min(substr(o2.o_orderpriority, 3)) FROM orders o2 WHERE left(o2.o_orderpriority, 1) = CAST(priority_code AS VARCHAR))
    AS priority
FROM coded""")
def code_label_decode(t):
    """One map holds the labels of both attributes; status P is missing from it."""
    code = F.when(c("o_orderstatus") == "O", 1).when(c("o_orderstatus") == "F", 2).otherwise(3)
    number = F.left("o_orderpriority", F.lit(1)).cast("int")
    status_map = t.orders.filter("o_orderstatus <> 'P'").select(
        F.lit("status").alias("attribute_name"), code.alias("attribute_value"), c("o_orderstatus").alias("value")
    )
    priority_map = t.orders.select(
        F.lit("priority").alias("attribute_name"), number.alias("attribute_value"),
        F.substring("o_orderpriority", 3, 100).alias("value"),
    )
    code_map = status_map.unionByName(priority_map).distinct()
    coded = t.orders.select("o_orderkey", code.alias("status_code"), number.alias("priority_code"))
    return j.decode_labels(
        coded, code_map,
        {"status": ("status_code", "status"), "priority": ("priority_code", "priority")}, unknown="[Unknown]",
    )


@query("swapped_key_union", """
WITH refs AS (SELECT o_orderkey AS ref_id, CASE WHEN o_orderpriority = '1-URGENT'
    THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') ELSE CAST(o_custkey AS VARCHAR) END AS who FROM orders),
hits AS (SELECT ref_id, c_custkey, 1 AS way FROM refs JOIN customer ON who = CAST(c_custkey AS VARCHAR)
   UNION SELECT ref_id, c_custkey, 2 FROM refs JOIN customer ON lower(who) = lower(c_name)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY way, c_custkey) AS rn FROM hits)
SELECT ref_id, c_custkey, way FROM ranked WHERE rn = 1""")
def swapped_key_union(t):
    """Urgent orders name the customer, the others give the id."""
    name = F.concat(F.lit("Customer#"), F.lpad(c("o_custkey").cast("string"), 9, "0"))
    refs = t.orders.select(
        c("o_orderkey").alias("ref_id"),
        F.when(c("o_orderpriority") == "1-URGENT", name).otherwise(c("o_custkey").cast("string")).alias("who"),
    )
    ways = [(c("who"), c("c_custkey").cast("string")), (F.lower("who"), F.lower("c_name"))]
    return j.match_either(refs, t.customer, "ref_id", ways, "c_custkey")


@query("id_crosswalk", """
WITH a AS (SELECT c_custkey AS id_a, c_nationkey * 100000 + CAST(floor(c_acctbal) AS BIGINT) AS k,
             CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 1 ELSE 0 END AS good_a FROM customer),
b AS (SELECT o_orderkey AS id_b, c_nationkey * 100000 + CAST(floor(c_acctbal) AS BIGINT) AS k,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS good_b FROM orders JOIN customer ON o_custkey = c_custkey),
a1 AS (SELECT *, good_a = 1 AND id_a = min(CASE WHEN good_a = 1 THEN id_a END) OVER (PARTITION BY k) AS first_a FROM a),
b1 AS (SELECT *, good_b = 1 AND id_b = min(CASE WHEN good_b = 1 THEN id_b END) OVER (PARTITION BY k) AS first_b FROM b),
p0 AS (SELECT id_a, id_b, first_a, first_b FROM a1 JOIN b1 ON a1.k = b1.k),
p1 AS (SELECT * FROM p0 WHERE first_a OR id_a IN (SELECT id_a FROM p0 GROUP BY 1 HAVING count(*) = 1)),
p2 AS (SELECT * FROM p1 WHERE first_b OR id_b IN (SELECT id_b FROM p1 GROUP BY 1 HAVING count(*) = 1))
SELECT id_a, id_b FROM p2""")
def id_crosswalk(t):
    key = (c("c_nationkey") * 100000 + F.floor("c_acctbal")).alias("k")
    a = t.customer.select(
        c("c_custkey").alias("id_a"), key,
        c("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE").cast("int").alias("good_a"),
    )
    b = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select(
        c("o_orderkey").alias("id_b"), key, (c("o_orderstatus") == "F").cast("int").alias("good_b")
    )
    return j.crosswalk(a, b, "k", "id_a", "id_b", "good_a", "good_b")


@query("expr_key_join", """
SELECT c_custkey, n_name FROM customer JOIN nation
  ON right(' ' || c_nationkey, 2) = right(replace(n_name, '_', ' '), 2) OR
     (c_nationkey < 10 AND try_cast(trim(right(replace(n_name, '_', ' '), 2)) AS INTEGER) = c_nationkey)""")
def expr_key_join(t):
    """The nation's name carries its key as a suffix."""
    suffix = F.trim(F.replace(last_chars(c("n_name"), 2), F.lit("_"), F.lit(" "))).try_cast("int")
    return j.join_on_exprs(t.customer, t.nation, [(c("c_nationkey"), suffix)]).select("c_custkey", "n_name")


@query("fx_convert", """
WITH rates AS (SELECT DISTINCT c_nationkey, o_orderdate, 100 + c_nationkey + day(o_orderdate) AS hundredths
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'),
a AS (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents, coalesce(hundredths, 200) AS q
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN rates USING (c_nationkey, o_orderdate))
SELECT o_orderkey, CAST(CAST((2 * cents * 100 + q) // (2 * q) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS amount_base
FROM a""")
def fx_convert(t):
    """Rates per nation and day; days without a rate use the row's own, 2."""
    sales = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "c_nationkey"
    )
    rates = sales.filter("o_orderstatus <> 'P'").select("c_nationkey", "o_orderdate").distinct().withColumn(
        "rate", (F.lit(1) + (c("c_nationkey") + F.day("o_orderdate")) / F.lit(100).cast("decimal(5,1)")).cast("decimal(19,13)")
    )
    return j.fx_convert(
        sales, rates, ["c_nationkey", "o_orderdate"], "o_totalprice", "rate", F.lit(2), "amount_base"
    ).select("o_orderkey", "amount_base")
