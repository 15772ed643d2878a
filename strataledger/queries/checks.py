"""Validation and reconciliation, run on fixtures that break the rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import with_row_hash
from ..operators import checks as q
from ..operators import upsert as u
from ..operators.digests import differences
from ..operators.filters import in_subquery
from ..operators.joins import lookup_key
from ..sources.lake import literal_rows
from .fixtures import BATCH, HIST, STORED, TRACKED, batch, hist, stored
from .registry import query

c = F.col


def rows():
    return F.count(F.lit(1))


@query("check_dup_current", f"""
WITH {HIST}, broken AS (SELECT * FROM hist UNION ALL SELECT * FROM hist WHERE event_type = 'error')
SELECT user_id, count(*) AS n FROM broken WHERE current_record = 1 GROUP BY 1 HAVING count(*) > 1""")
def check_dup_current(t):
    h = hist(t)
    return q.dup_current(h.unionByName(h.filter("event_type = 'error'")), "user_id")


@query("check_dup_start", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def check_dup_start(t):
    return q.grain(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("check_contiguous", f"""
WITH {HIST}, broken AS (SELECT user_id, start_date, CASE WHEN event_type = 'click' AND current_record = 0
    THEN CAST(end_date + 1 AS DATE) ELSE end_date END AS end_date FROM hist)
SELECT * FROM (SELECT *, lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date, end_date) AS next_start FROM broken)
WHERE end_date <> next_start""")
def check_contiguous(t):
    late = (c("event_type") == "click") & (c("current_record") == 0)
    closed = F.when(c("current_record") == 0, c("end_date"))
    broken = hist(t).select(
        "user_id", "start_date", F.when(late, F.date_add(closed, 1)).otherwise(c("end_date")).alias("end_date")
    )
    return q.gaps_overlaps(broken, "user_id")


@query("check_repeated_hash", """
SELECT event_id, user_id, row_hash FROM (SELECT event_id, user_id, sha256(event_type) AS row_hash,
  lead(sha256(event_type)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events) WHERE row_hash = nxt""")
def check_repeated_hash(t):
    rows = with_row_hash(t.events.select("event_id", "user_id", "ts", "event_type"), ["event_type"])
    return q.repeated_hash(rows, "user_id", ["ts", "event_id"]).select("event_id", "user_id", "row_hash")


@query("check_unknown_member", """
SELECT 'with unknown' AS source, count(*) AS n FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT -1) WHERE s_suppkey = -1
UNION ALL SELECT 'as given', count(*) FROM supplier WHERE s_suppkey = -1""")
def check_unknown_member(t):
    full = u.with_unknown(t.supplier, "s_suppkey", {"s_name": "[Unknown]"})
    return q.tagged_counts({"with unknown": full, "as given": t.supplier}, {"n": F.count_if(c("s_suppkey") == -1)})


@query("reconcile_counts", """
SELECT a.n AS count_a, b.n AS count_b, CASE WHEN a.n = b.n THEN 1 ELSE 0 END AS equal
FROM (SELECT count(*) AS n FROM orders) a, (SELECT count(*) AS n FROM orders WHERE o_orderstatus <> 'P') b""")
def reconcile_counts(t):
    return q.compare_counts(t.orders, t.orders.filter("o_orderstatus <> 'P'"))


@query("reconcile_missing", """
WITH a AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT o_orderkey, 'a' AS found_in FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL SELECT o_orderkey, 'b' FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)""")
def reconcile_missing(t):
    return q.missing_rows(t.orders.filter("o_orderstatus <> 'P'"), t.orders.filter("o_orderpriority <> '5-LOW'"), ["o_orderkey"])


@query("reconcile_columns", f"""
WITH {STORED}, {BATCH}, holed AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal <= 9500 THEN c_mktsegment END AS c_mktsegment
  FROM batch)
SELECT 'plain' AS mode, CAST(count(*) FILTER (a.c_mktsegment <> b.c_mktsegment) AS BIGINT) AS c_mktsegment_mismatch,
  CAST(count(*) FILTER (a.c_nationkey <> b.c_nationkey) AS BIGINT) AS c_nationkey_mismatch
FROM stored a JOIN holed b USING (c_custkey)
UNION ALL SELECT 'null safe', count(*) FILTER (a.c_mktsegment IS DISTINCT FROM b.c_mktsegment),
  count(*) FILTER (a.c_nationkey IS DISTINCT FROM b.c_nationkey) FROM stored a JOIN holed b USING (c_custkey)""")
def reconcile_columns(t):
    """NULL against a value is seen by the null-safe form only."""
    holed = batch(t).withColumn("c_mktsegment", F.when(c("c_acctbal") <= 9500, c("c_mktsegment")))
    cols = ["c_mktsegment", "c_nationkey"]
    plain = q.mismatch_counts(stored(t), holed, ["c_custkey"], cols)
    safe = q.mismatch_counts(stored(t), holed, ["c_custkey"], cols, null_safe=True)
    return plain.withColumn("mode", F.lit("plain")).unionByName(safe.withColumn("mode", F.lit("null safe")))


@query("check_grain", "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def check_grain(t):
    return q.grain(t.orders, ["o_custkey", "o_orderdate"])


@query("check_idempotent", """
SELECT CAST(0 AS BIGINT) AS rows_added, CAST(0 AS BIGINT) AS c_mktsegment_mismatch, CAST(0 AS BIGINT) AS row_hash_mismatch""")
def check_idempotent(t):
    """The type-1 upsert run on its own result changes nothing."""
    return q.rerun_delta(
        lambda tgt, src: u.upsert_type1(tgt.select(*src.columns), src, ["c_custkey"], TRACKED),
        stored(t), batch(t), ["c_custkey"], ["c_mktsegment", "row_hash"], stage=lambda df: t.stage(df, "loaded"),
    )


@query("check_expected_delta", """
WITH after AS (SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT -1, 'F'),
m AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders)
SELECT count(*) - any_value(m.n) AS orders_delta, count(*) FILTER (o_orderstatus = 'F') - any_value(m.f) AS finished_delta,
  count(*) FILTER (o_orderstatus = 'O') - any_value(m.o) AS open_delta FROM after, m""")
def check_expected_delta(t):
    """One finished order is added: its count moves, the count of open orders does not."""
    cols = ["o_orderkey", "o_orderstatus"]
    extra = literal_rows(t.spark, [(-1, "F")], "o_orderkey bigint, o_orderstatus string")
    before = t.orders.select(*cols)
    return q.count_delta(before, before.unionByName(extra), {
        "orders": rows(), "finished": F.count_if(c("o_orderstatus") == "F"), "open": F.count_if(c("o_orderstatus") == "O"),
    })


@query("check_milestone_order", """
SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS opened, count(*) FILTER (o_orderstatus = 'F') AS finished,
  count(*) FILTER (o_orderstatus = 'P') AS partial FROM orders GROUP BY 1
HAVING count(*) FILTER (o_orderstatus = 'F') > count(*) FILTER (o_orderstatus = 'O')
    OR count(*) FILTER (o_orderstatus = 'P') > count(*) FILTER (o_orderstatus = 'O')""")
def check_milestone_order(t):
    status = c("o_orderstatus")
    return q.milestone_disorder(t.orders, ["o_custkey"], {
        "opened": F.count_if(status == "O"), "finished": F.count_if(status == "F"), "partial": F.count_if(status == "P"),
    })


@query("reconcile_across_tables", """
SELECT 'orders' AS source, count(*) AS orders, count(DISTINCT o_custkey) AS customers FROM orders
UNION ALL SELECT 'shipped', count(DISTINCT o_orderkey), count(DISTINCT o_custkey) FROM orders JOIN lineitem ON o_orderkey = l_orderkey
UNION ALL SELECT 'known', count(*), count(DISTINCT o_custkey) FROM orders JOIN customer ON o_custkey = c_custkey""")
def reconcile_across_tables(t):
    lines = t.lineitem.select(c("l_orderkey").alias("o_orderkey"))
    known = t.customer.select(c("c_custkey").alias("o_custkey"))
    return q.tagged_counts(
        {
            "orders": t.orders,
            "shipped": in_subquery(t.orders, lines, ["o_orderkey"]),
            "known": in_subquery(t.orders, known, ["o_custkey"]),
        },
        {"orders": rows(), "customers": F.count_distinct("o_custkey")},
    )


@query("check_orphans_in_facts", """
SELECT 'sales' AS fact, count(*) AS n_rows FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 50)
UNION ALL SELECT 'returns', count(*) FROM lineitem WHERE l_returnflag = 'R'
  AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 50)""")
def check_orphans_in_facts(t):
    bad = t.part.filter("p_size = 50")
    returns = t.lineitem.filter("l_returnflag = 'R'")
    return q.orphan_counts({"sales": (t.lineitem, "l_partkey"), "returns": (returns, "l_partkey")}, bad, "p_partkey")


@query("load_audit", """
SELECT o_orderkey, 'run-1' AS run_id, TIMESTAMP '2024-02-01 06:00:00' AS created_at,
  TIMESTAMP '2024-02-01 06:00:00' AS updated_at FROM orders""")
def load_audit(t):
    return q.with_run_audit(t.orders.select("o_orderkey"), "run-1", "2024-02-01 06:00:00")


@query("load_audit_log", """
SELECT 'run-1' AS run_id, 'orders' AS source, 'fact_orders' AS target, count(*) AS n_rows, 'Succeeded' AS status FROM orders""")
def load_audit_log(t):
    return q.task_log(t.orders, "orders", "fact_orders", "run-1")


@query("check_default_keys", """
SELECT coalesce(p_type, '[Unknown]') AS p_type, count(*) AS n, count(*) FILTER (p_partkey IS NULL) AS unknown_keys
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey GROUP BY 1""")
def check_default_keys(t):
    """How many facts still point at the unknown member, by the type they resolve to."""
    known = t.part.filter("p_size > 10")
    fact = lookup_key(t.lineitem.select("l_partkey"), known, {"l_partkey": "p_partkey"}, "p_partkey", "part_key")
    by_key = fact.groupBy("part_key").agg(rows().alias("n"))
    labelled = by_key.join(known.select(c("p_partkey").alias("part_key"), "p_type"), "part_key", "left")
    return labelled.groupBy(F.coalesce("p_type", F.lit("[Unknown]")).alias("p_type")).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(c("part_key") == -1, c("n"))), F.lit(0)).alias("unknown_keys")
    )


@query("check_before_after_row", f"""
WITH {STORED}, {BATCH} SELECT c_custkey, c_mktsegment, 'before' AS state FROM stored WHERE c_acctbal > 9500
UNION ALL SELECT c_custkey, c_mktsegment, 'after' FROM batch WHERE c_acctbal > 9500""")
def check_before_after_row(t):
    after = u.upsert_type1(stored(t), batch(t), ["c_custkey"], TRACKED).drop("row_hash")
    return q.before_after(stored(t), after, c("c_acctbal") > 9500).select("c_custkey", "c_mktsegment", "state")


@query("check_case_dups", """
SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1 AND count(DISTINCT l_suppkey) = 1""")
def check_case_dups(t):
    counted = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        rows().alias("n"), F.count_distinct("l_suppkey").alias("suppliers")
    )
    return counted.filter("n > 1 AND suppliers = 1")


@query("reconcile_by_digest", """
WITH b AS (SELECT CASE WHEN o_orderkey % 101 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS st, o_totalprice
    FROM orders WHERE o_orderkey % 97 <> 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'only_a' WHEN a.o_orderkey IS NULL THEN 'only_b' ELSE 'changed' END AS kind,
  CAST(a.o_orderkey IS NOT NULL AS BIGINT) AS count_a, CAST(b.o_orderkey IS NOT NULL AS BIGINT) AS count_b
FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> st OR a.o_totalprice <> b.o_totalprice""")
def reconcile_by_digest(t):
    """Orders against a copy in which some are missing, some have another key and some another status."""
    k = c("o_orderkey")
    copy = t.orders.filter(k % 97 != 0).select(
        F.when(k % 101 == 0, -k - 1).otherwise(k).alias("o_orderkey"), F.when(k % 89 == 0, "X").otherwise(c("o_orderstatus")).alias("o_orderstatus"), "o_totalprice"
    )
    return differences(t.orders, copy, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
