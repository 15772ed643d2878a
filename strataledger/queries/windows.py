"""Window functions.

Raw event and audit rows of one user are unbounded, so they go through the hot-key split; the
version history has at most one row per user and day and uses plain windows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..defaults import UNKNOWN_TEXT
from ..functions.dates import local_date
from ..functions.hashing import text_hash, with_row_hash
from ..operators import history as h
from ..operators.ordered import first_per_key, neighbours, numbered, running
from .fixtures import HIST, hist
from .registry import query

c = F.col
AT = ["ts", "event_id"]
OVER_USER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query("dedupe_latest", """
SELECT * EXCLUDE (rn) FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_latest(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    newest = [F.desc(x) for x in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    return first_per_key(rows, ["l_orderkey", "l_linenumber"], newest)


LOCAL = "CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE)"


@query("last_change_per_day", f"""
SELECT event_id, user_id, event_type, ts, local_day FROM (SELECT *, {LOCAL} AS local_day,
  row_number() OVER (PARTITION BY user_id, {LOCAL} ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def last_change_per_day(t):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return h.latest_per_day(rows, ["user_id"], "ts", "event_id", local_date(c("ts")), out="local_day")


@query("lowest_wins", """
SELECT user_id, day, event_id, value FROM (SELECT *, CAST(ts AS DATE) AS day,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY value, event_id) AS rn FROM events) WHERE rn = 1""")
def lowest_wins(t):
    rows = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id", "value")
    return first_per_key(rows, ["user_id", "day"], ["value", "event_id"])


@query("sequence_number", f"""
SELECT event_id, user_id, CAST(row_number() {OVER_USER} AS INTEGER) AS seq FROM events WHERE event_type <> 'view'""")
def sequence_number(t):
    """Ordinals within the user after filtering."""
    rows = t.events.filter("event_type <> 'view'").select("event_id", "user_id", "ts")
    return numbered(rows, ["user_id"], AT).drop("ts")


def versions(t):
    return hist(t).select("user_id", "event_type", "row_hash", "start_date")


@query("lead_end_date", f"""
WITH {HIST} SELECT user_id, event_type, start_date, end_date FROM hist""")
def lead_end_date(t):
    return h.close_with_next(versions(t), ["user_id"], ["start_date"], split=False).select(
        "user_id", "event_type", "start_date", "end_date"
    )


@query("current_flag", f"""
WITH {HIST} SELECT user_id, start_date, current_record FROM hist""")
def current_flag(t):
    return h.close_with_next(versions(t), ["user_id"], ["start_date"], split=False).select(
        "user_id", "start_date", "current_record"
    )


@query("capped_lead", """
SELECT event_id, user_id, CAST(ts AS DATE) AS start_date, least(
  lead(CAST(ts AS DATE), 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY ts, event_id),
  CAST(CAST(ts AS DATE) + 2 AS DATE)) AS end_date FROM events""")
def capped_lead(t):
    rows = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("start_date"))
    return h.capped_windows(rows, ["user_id"], "start_date", 2, order=AT).drop("ts")


@query("lag_previous", f"""
SELECT event_id, user_id, event_type, lag(coalesce(nullif(event_type, 'view'), '[Unknown]'), 1, '[Unknown]') {OVER_USER}
  AS previous FROM events""")
def lag_previous(t):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    was = F.coalesce(F.nullif("event_type", F.lit("view")), F.lit(UNKNOWN_TEXT))
    seen = neighbours(rows, ["user_id"], AT, before={"previous": was})
    return seen.withColumn("previous", F.coalesce("previous", F.lit(UNKNOWN_TEXT))).drop("ts")


@query("lag_hash", f"""
SELECT event_id, user_id, sha256(event_type) AS row_hash, lag(sha256(event_type), 1, sha256('')) {OVER_USER}
  AS prev_hash FROM events""")
def lag_hash(t):
    rows = with_row_hash(t.events.select("event_id", "user_id", "ts", "event_type"), ["event_type"])
    seen = neighbours(rows, ["user_id"], AT, before={"prev_hash": c("row_hash")})
    return seen.select("event_id", "user_id", "row_hash", F.coalesce("prev_hash", text_hash("")).alias("prev_hash"))


SPARSE = "CASE WHEN event_type = 'purchase' THEN value END"


def sparse(t):
    return t.events.select("event_id", "user_id", "ts", F.when(c("event_type") == "purchase", c("value")).alias("paid"))


@query("running_count_groups", f"""
SELECT event_id, user_id, count({SPARSE}) {OVER_USER} AS grp FROM events""")
def running_count_groups(t):
    ones = F.when(c("paid").isNotNull(), F.lit(1)).otherwise(0).cast("long")
    return running(sparse(t), ["user_id"], AT, sums={"grp": ones}).select("event_id", "user_id", "grp")


@query("first_value_fill", f"""
WITH s AS (SELECT event_id, user_id, ts, {SPARSE} AS paid FROM events),
g AS (SELECT *, count(paid) {OVER_USER} AS grp FROM s)
SELECT event_id, user_id, first_value(paid) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id) AS paid FROM g""")
def first_value_fill(t):
    return h.forward_fill(sparse(t), ["user_id"], AT, ["paid"]).drop("ts")


@query("running_max_islands", f"""
WITH s AS (SELECT event_id, user_id, ts, {SPARSE} AS paid, row_number() {OVER_USER} AS rn FROM events)
SELECT event_id, user_id, max(CASE WHEN paid IS NOT NULL THEN rn END) {OVER_USER} AS island FROM s""")
def running_max_islands(t):
    rows = numbered(sparse(t), ["user_id"], AT, "rn")
    mark = F.when(c("paid").isNotNull(), c("rn")).cast("long")
    return running(rows, ["user_id"], AT, maxes={"island": mark}).select("event_id", "user_id", "island")


@query("max_over_partition", f"""
WITH s AS (SELECT event_id, user_id, {SPARSE} AS paid, CAST(ts AS DATE) AS day FROM events)
SELECT event_id, user_id, day, max(paid) OVER (PARTITION BY user_id, day) AS best FROM s""")
def max_over_partition(t):
    rows = sparse(t).withColumn("day", F.to_date("ts"))
    return h.over_entity(rows, ["user_id", "day"], {"best": F.max("paid")}).select("event_id", "user_id", "day", "best")


@query("min_over_partition", """
SELECT event_id, user_id, min(ts) OVER (PARTITION BY user_id) AS first_ts FROM events""")
def min_over_partition(t):
    return h.over_entity(t.events.select("event_id", "user_id", "ts"), ["user_id"], {"first_ts": F.min("ts")}).drop("ts")


@query("end_of_day_flag", """
SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
  ORDER BY ts DESC, event_id DESC) = 1 THEN 1 ELSE 0 END AS is_end_of_day FROM events""")
def end_of_day_flag(t):
    return h.end_of_day_flags(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id").drop("ts")


@query("lag_fill_one", f"""
WITH s AS (SELECT event_id, user_id, ts, CASE WHEN event_type NOT IN ('view', 'click') THEN event_type END AS state FROM events)
SELECT event_id, user_id, coalesce(state, lag(state) {OVER_USER}) AS state FROM s""")
def lag_fill_one(t):
    rows = t.events.select(
        "event_id", "user_id", "ts", F.when(~c("event_type").isin("view", "click"), c("event_type")).alias("state")
    )
    seen = neighbours(rows, ["user_id"], AT, before={"was": c("state")})
    return seen.select("event_id", "user_id", F.coalesce("state", "was").alias("state"))


@query("first_flip_date", f"""
SELECT event_id, user_id, CASE WHEN event_type = 'purchase' AND was <> 'purchase' THEN CAST(ts AS DATE) END AS flipped_on
FROM (SELECT *, lag(event_type, 1, '[Unknown]') {OVER_USER} AS was FROM events)""")
def first_flip_date(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    return h.flip_dates(rows, ["user_id"], AT, "event_type", "purchase", F.to_date("ts"), "flipped_on").select(
        "event_id", "user_id", "flipped_on"
    )


@query("nullable_partition_key", """
WITH p AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id_a,
             'C' || o_custkey AS id_b FROM orders)
SELECT o_orderkey, coalesce(CAST(id_a AS VARCHAR), id_b) AS party, CAST(row_number() OVER
  (PARTITION BY coalesce(CAST(id_a AS VARCHAR), id_b) ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS seq FROM p""")
def nullable_partition_key(t):
    """Parties of two systems: the first id where there is one, else the second."""
    id_a = F.when(c("o_orderstatus") != "P", c("o_custkey")).cast("string")
    id_b = F.concat(F.lit("C"), c("o_custkey").cast("string"))
    rows = t.orders.select("o_orderkey", "o_orderdate", F.coalesce(id_a, id_b).alias("party"))
    return numbered(rows, ["party"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
