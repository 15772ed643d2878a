"""Joins in time: valid-at, as-of, band, look-back and pairing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import money
from ..operators import asof as a
from ..operators import pairing
from ..operators import temporal as tp
from ..operators.bands import band_lookup
from ..sources.lake import literal_rows
from .fixtures import HIST, day, hist
from .registry import query

c = F.col


def dated_events(t):
    return t.events.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))


def versions(t):
    return hist(t).select("user_id", c("event_type").alias("version_type"), "start_date", "end_date")


@query("temporal_join", f"""
WITH {HIST} SELECT e.event_id, e.user_id, h.event_type AS version_type, h.start_date FROM events e JOIN hist h
  ON e.user_id = h.user_id AND h.start_date <= CAST(e.ts AS DATE) AND CAST(e.ts AS DATE) < h.end_date""")
def temporal_join(t):
    return tp.temporal_join(dated_events(t), versions(t), ["user_id"], "day").select(
        "event_id", "user_id", "version_type", "start_date"
    )


@query("temporal_join_closed", f"""
WITH {HIST} SELECT e.event_id, e.user_id, h.event_type AS version_type, h.start_date FROM events e JOIN hist h
  ON e.user_id = h.user_id AND h.start_date <= CAST(e.ts AS DATE) AND CAST(e.ts AS DATE) <= h.end_date""")
def temporal_join_closed(t):
    return tp.temporal_join(dated_events(t), versions(t), ["user_id"], "day", closed="both").select(
        "event_id", "user_id", "version_type", "start_date"
    )


@query("temporal_lag_join", f"""
WITH {HIST} SELECT e.event_id, e.user_id, h.event_type AS version_before FROM events e LEFT JOIN hist h
  ON e.user_id = h.user_id AND h.start_date <= CAST(e.ts AS DATE) - 7 AND CAST(e.ts AS DATE) - 7 < h.end_date""")
def temporal_lag_join(t):
    return tp.temporal_join(dated_events(t), versions(t), ["user_id"], "day", how="left", shift_days=7).select(
        "event_id", "user_id", c("version_type").alias("version_before")
    )


SLICES = """
cust AS (SELECT c_custkey, c_nationkey AS nation, DATE '1900-01-01' AS cs, DATE '1998-01-01' AS ce FROM customer
  UNION ALL SELECT c_custkey, (c_nationkey + 5) % 25, DATE '1998-01-01', DATE '9999-12-31' FROM customer),
nat AS (SELECT n_nationkey, n_regionkey AS region, DATE '1900-01-01' AS ns, DATE '1999-01-01' AS ne FROM nation
  UNION ALL SELECT n_nationkey, (n_regionkey + 1) % 5, DATE '1999-01-01', DATE '9999-12-31' FROM nation)"""


def customer_slices(t):
    """Customers that all moved five nations on at 1998-01-01."""
    first = t.customer.select(c("c_custkey").alias("o_custkey"), c("c_nationkey").alias("nation"),
                              day("1900-01-01").alias("cs"), day("1998-01-01").alias("ce"))
    then = t.customer.select(c("c_custkey").alias("o_custkey"), ((c("c_nationkey") + 5) % 25).alias("nation"),
                             day("1998-01-01").alias("cs"), day("9999-12-31").alias("ce"))
    return first.unionByName(then)


def nation_slices(t):
    first = t.nation.select(c("n_nationkey").alias("nation"), c("n_regionkey").alias("region"),
                            day("1900-01-01").alias("ns"), day("1999-01-01").alias("ne"))
    then = t.nation.select(c("n_nationkey").alias("nation"), ((c("n_regionkey") + 1) % 5).alias("region"),
                           day("1999-01-01").alias("ns"), day("9999-12-31").alias("ne"))
    return first.unionByName(then)


@query("chained_temporal_lookup", f"""
WITH {SLICES}
SELECT o_orderkey, nation, coalesce(region, -1) AS region, coalesce(r_name, '[Unknown]') AS region_name FROM orders
LEFT JOIN cust ON o_custkey = c_custkey AND cs <= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < ce
LEFT JOIN nat ON nation = n_nationkey AND ns <= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < ne
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON region = r_regionkey""")
def chained_temporal_lookup(t):
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    found = tp.looked_up(orders, ["o_custkey", "day"], [
        lambda df: tp.valid_versions(df, customer_slices(t), ["o_custkey"], "day", "cs", "ce", how="left"),
        lambda df: tp.valid_versions(df, nation_slices(t), ["nation"], "day", "ns", "ne", how="left"),
        lambda df: df.join(t.region.filter("r_name <> 'ASIA'"), c("region") == c("r_regionkey"), "left"),
    ])
    return found.select(
        "o_orderkey", "nation", F.coalesce("region", F.lit(-1)).alias("region"),
        F.coalesce("r_name", F.lit("[Unknown]")).alias("region_name"),
    )


@query("eligibility_join", """
WITH people AS (SELECT s_suppkey, CAST(DATE '1995-01-01' + s_nationkey * 30 AS DATE) AS first_start,
    CAST(DATE '1996-12-01' + s_nationkey * 30 AS DATE) AS last_start,
    CASE WHEN s_acctbal < 2000 THEN DATE '1999-01-01' END AS left_on FROM supplier)
SELECT l_orderkey, l_linenumber, l_partkey, s_suppkey FROM lineitem JOIN people ON l_suppkey = s_suppkey
WHERE CASE WHEN l_shipdate < last_start THEN first_start ELSE last_start END <= l_shipdate
  AND coalesce(left_on, DATE '9999-12-31') >= l_shipdate""")
def eligibility_join(t):
    people = t.supplier.select(
        c("s_suppkey").alias("l_suppkey"), c("s_suppkey"),
        F.date_add(day("1995-01-01"), c("s_nationkey") * 30).alias("first_start"),
        F.date_add(day("1996-12-01"), c("s_nationkey") * 30).alias("last_start"),
        F.when(c("s_acctbal") < 2000, day("1999-01-01")).alias("left_on"),
    )
    lines = t.lineitem.withColumn("at", F.to_date("l_shipdate"))
    return tp.eligible_at(lines, people, "l_suppkey", "at", "first_start", "last_start", "left_on").select(
        "l_orderkey", "l_linenumber", "l_partkey", "s_suppkey"
    )


@query("band_join", """
SELECT p_partkey, p_size, CASE WHEN p_size >= 5 AND p_size < 15 THEN 1 WHEN p_size >= 15 AND p_size < 40 THEN 2
  WHEN p_size >= 40 THEN 3 END AS band_key FROM part""")
def band_join(t):
    bands = literal_rows(t.spark, [(1, 5, 15), (2, 15, 40), (3, 40, None)], "band_key int, lo int, hi int")
    return band_lookup(t.part.select("p_partkey", "p_size"), bands, "p_size").select("p_partkey", "p_size", "band_key")


@query("asof_join", """
WITH d AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS k FROM orders GROUP BY 1, 2),
p AS (SELECT *, lag(k) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS previous FROM d)
SELECT o_orderkey, previous FROM orders JOIN p USING (o_custkey, o_orderdate)""")
def asof_join(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return a.asof_latest(
        orders, orders, ["o_custkey"], "o_orderdate", "o_orderdate", {"o_orderkey": "previous"}, strict=True, tie="o_orderkey"
    ).select("o_orderkey", "previous")


@query("asof_tolerance", """
WITH pairs AS (SELECT e.o_orderkey, s.o_orderpriority, CAST(s.o_totalprice AS DECIMAL(18,2)) AS amount,
    row_number() OVER (PARTITION BY e.o_orderkey, s.o_orderpriority ORDER BY s.o_orderdate DESC, s.o_orderkey DESC) AS rn
  FROM orders e JOIN orders s ON e.o_custkey = s.o_custkey
    AND s.o_orderdate <= e.o_orderdate AND s.o_orderdate >= e.o_orderdate - INTERVAL 90 DAY)
SELECT o_orderkey, CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM pairs WHERE rn = 1 GROUP BY 1""")
def asof_tolerance(t):
    """Orders valued at the latest balance of each of the customer's accounts (priority), none older than 90 days."""
    shots = t.orders.select(
        "o_custkey", "o_orderpriority", "o_orderdate", c("o_orderkey").alias("tie"), money(c("o_totalprice")).alias("amount")
    )
    moments = t.orders.select("o_custkey", "o_orderdate").distinct()
    valued = a.sum_of_latest(moments, shots, "o_custkey", "o_orderpriority", "o_orderdate", "o_orderdate", "amount", 90, tie="tie")
    return t.orders.join(valued, ["o_custkey", "o_orderdate"]).select("o_orderkey", "amount")


@query("rolling_lookback_join", """
WITH spine AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, CAST(2 + user_id % 5 AS INTEGER) AS own_limit FROM events),
ev AS (SELECT user_id AS u, event_type, CAST(ts AS DATE) AS d FROM events)
SELECT user_id, day, max(CASE WHEN event_type = 'purchase' AND date_diff('day', d, day) BETWEEN 0 AND 7 THEN 1 ELSE 0 END) AS bought_7,
  max(CASE WHEN event_type = 'click' AND date_diff('day', d, day) BETWEEN 0 AND own_limit THEN 1 ELSE 0 END) AS clicked_own,
  CAST(date_diff('day', max(CASE WHEN event_type = 'purchase' AND d <= day THEN d END), day) AS INTEGER) AS since_purchase
FROM spine LEFT JOIN ev ON user_id = u GROUP BY 1, 2""")
def rolling_lookback_join(t):
    """A window of 7 days for purchases and one of the user's own length for clicks."""
    spine = t.events.select("user_id", F.to_date("ts").alias("day")).distinct()
    signals = {"since_purchase": c("event_type") == "purchase", "since_click": c("event_type") == "click"}
    seen = a.days_since(spine, t.events, "user_id", "day", F.to_date("ts"), signals)
    return seen.select(
        "user_id", "day", a.within(c("since_purchase"), 7).alias("bought_7"),
        a.within(c("since_click"), (2 + c("user_id") % 5).cast("int")).alias("clicked_own"), "since_purchase",
    )


@query("prior_within_months", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate <= prior + INTERVAL 12 MONTH THEN 1 ELSE 0 END AS has_prior
FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prior FROM orders)""")
def prior_within_months(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("ordered"))
    return a.prior_within_months(rows, ["o_custkey"], "ordered", "o_orderkey", 12).drop("ordered")


@query("previous_match_lag", """
WITH days AS (SELECT DISTINCT l_partkey, l_quantity, l_shipdate FROM lineitem),
p AS (SELECT *, lag(l_shipdate) OVER (PARTITION BY l_partkey, l_quantity ORDER BY l_shipdate) AS prev FROM days)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate,
  CAST(date_diff('day', prev, l_shipdate) AS INTEGER) AS days_lag
FROM lineitem JOIN p USING (l_partkey, l_quantity, l_shipdate)""")
def previous_match_lag(t):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]
    return a.recurring_lag(t.lineitem.select(*cols), t.lineitem, ["l_partkey", "l_quantity"], "l_shipdate")


@query("window_overlap_cap", f"""
WITH {HIST}, a AS (SELECT user_id, start_date AS a_start, end_date AS a_end FROM hist WHERE event_type = 'view'),
b AS (SELECT user_id, CAST(start_date + 1 AS DATE) AS b_start,
        CASE WHEN current_record = 1 THEN end_date ELSE CAST(end_date + 1 AS DATE) END AS b_end FROM hist)
SELECT user_id, a_start, b_start AS overlap_start, least(a_end, b_end) AS overlap_end FROM a JOIN b USING (user_id)
WHERE b_start >= a_start AND b_start <= a_end""")
def window_overlap_cap(t):
    """Versions shifted by a day against the windows in which the user was viewing."""
    h = hist(t)
    windows = h.filter("event_type = 'view'").select("user_id", c("start_date").alias("a_start"), c("end_date").alias("a_end"))
    shifted = h.select(
        "user_id", F.date_add("start_date", 1).alias("b_start"),
        F.when(c("current_record") == 1, c("end_date")).otherwise(
            F.date_add(F.when(c("current_record") == 0, c("end_date")), 1)).alias("b_end"),
    )
    return tp.overlap_capped(
        windows, shifted, "user_id", ("a_start", "a_end"), ("b_start", "b_end"), ("overlap_start", "overlap_end")
    ).select("user_id", "a_start", "overlap_start", "overlap_end")


PAIRS = """
seq AS (SELECT event_id, user_id, ts, event_type,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts,
    lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type,
    lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type
  FROM events WHERE event_type IN ('error', 'purchase', 'signup'))"""


def event_sequence(t):
    return pairing.sequence_events(
        t.events, "user_id", "ts", "event_id", opens=c("event_type") == "error",
        closes=c("event_type").isin("purchase", "signup"), extra=["event_type"],
    )


@query("next_event_pair", f"""
WITH {PAIRS} SELECT event_id, user_id, ts, CASE WHEN next_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS completed,
  CASE WHEN next_type IN ('purchase', 'signup') THEN next_ts END AS close_at,
  CASE WHEN next_type IN ('purchase', 'signup') THEN next_type END AS outcome
FROM seq WHERE event_type = 'error'""")
def next_event_pair(t):
    """Errors closed by the purchase or signup that directly follows."""
    return pairing.pair_events(event_sequence(t), "ts").select(
        "event_id", "user_id", "ts", "completed", "close_at",
        F.when(c("completed") == 1, c("next_event_type")).alias("outcome"),
    )


@query("unmatched_closers", f"""
WITH {PAIRS} SELECT event_id, user_id, ts, event_type FROM seq
WHERE event_type <> 'error' AND coalesce(prev_type, '') <> 'error'""")
def unmatched_closers(t):
    return pairing.unmatched_closers(event_sequence(t)).select("event_id", "user_id", "ts", "event_type")
