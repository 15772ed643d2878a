"""Building version history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import local_date
from ..functions.hashing import with_row_hash
from ..operators import history as h
from ..operators import late
from .fixtures import CUT, HIST, day, hist, moment
from .registry import query

c = F.col
OVER_USER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query("row_hash", """
SELECT c_custkey, sha256(concat(c_name, '|', c_nationkey, '|', CAST(c_acctbal AS DECIMAL(18,2)), '|',
  nullif(c_mktsegment, 'BUILDING'))) AS row_hash FROM customer""")
def row_hash(t):
    rows = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return with_row_hash(rows, ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], money=True).select("c_custkey", "row_hash")


@query("detect_changes", f"""
SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type, 1, '[Unknown]') {OVER_USER} AS was FROM events)
WHERE event_type <> was""")
def detect_changes(t):
    rows = with_row_hash(t.events.select("event_id", "user_id", "ts", "event_type"), ["event_type"])
    return h.changes_only(rows, ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("forward_fill", f"""
WITH s AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS paid,
  CASE WHEN event_type = 'error' THEN props END AS fault FROM events)
SELECT event_id, user_id, last_value(paid IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS UNBOUNDED PRECEDING) AS paid,
  last_value(fault IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS fault FROM s""")
def forward_fill(t):
    rows = t.events.select(
        "event_id", "user_id", "ts", F.when(c("event_type") == "purchase", c("value")).alias("paid"),
        F.when(c("event_type") == "error", c("props")).alias("fault"),
    )
    return h.forward_fill(rows, ["user_id"], ["ts", "event_id"], ["paid", "fault"]).drop("ts")


@query("fill_within_island", """
WITH spans AS (SELECT user_id, min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events GROUP BY 1),
spine AS (SELECT user_id, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS day FROM spans),
marks AS (SELECT DISTINCT user_id AS u, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase')
SELECT user_id, day, max(d) AS last_purchase FROM spine LEFT JOIN marks ON user_id = u AND d <= day GROUP BY 1, 2""")
def fill_within_island(t):
    spans = t.events.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("d0"), F.max(F.to_date("ts")).alias("d1"))
    marks = t.events.filter("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("bought"))
    return h.island_fill(h.day_spine(spans, "user_id", "d0", "d1"), marks, "user_id", "day", "bought", "last_purchase")


LOCAL = "CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE)"


@query("scd2_build", f"""
WITH l AS (SELECT user_id, {LOCAL} AS start_date, event_type, CASE WHEN event_type = 'purchase' THEN value END AS paid,
    row_number() OVER (PARTITION BY user_id, {LOCAL} ORDER BY ts DESC, event_id DESC) AS rn FROM events),
f AS (SELECT user_id, start_date, event_type, last_value(paid IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY start_date
    ROWS UNBOUNDED PRECEDING) AS paid FROM l WHERE rn = 1),
g AS (SELECT *, sha256(concat(event_type, '|', CAST(paid AS DECIMAL(18,2)))) AS row_hash FROM f),
p AS (SELECT *, lag(row_hash, 1, sha256('[Unknown]')) OVER (PARTITION BY user_id ORDER BY start_date) AS was FROM g)
SELECT user_id, start_date, event_type, paid, row_hash,
  lead(start_date, 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY start_date) AS end_date,
  CASE WHEN lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) IS NULL THEN 1 ELSE 0 END AS current_record
FROM p WHERE row_hash <> was""")
def scd2_build(t):
    """Pacific days, one dense and one sparse attribute."""
    audit = t.events.withColumn("paid", F.when(c("event_type") == "purchase", c("value")))
    return h.build_scd2(
        audit, "user_id", "ts", "event_id", ["event_type", "paid"], sparse=["paid"], day=local_date(c("ts")), money=True
    )


@query("scd2_history", f"WITH {HIST} SELECT * FROM hist")
def scd2_history(t):
    return hist(t)


@query("first_version_start", f"""
WITH {HIST}, base AS (SELECT c_custkey, CAST(DATE '2023-12-20' + c_nationkey AS DATE) AS created FROM customer)
SELECT user_id, event_type, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY start_date) = 1
  THEN least(start_date, coalesce(created, start_date)) ELSE start_date END AS start_date, end_date
FROM hist LEFT JOIN base ON user_id = c_custkey""")
def first_version_start(t):
    base = t.customer.select(
        c("c_custkey").alias("user_id"), F.date_add(day("2023-12-20"), c("c_nationkey")).alias("created")
    )
    rows = hist(t).select("user_id", "event_type", "start_date", "end_date")
    return h.override_first_start(rows, base, "user_id", "created")


@query("old_new_log_to_history", f"""
WITH log AS (SELECT user_id, ts, event_id, event_type AS new_v, lag(event_type) {OVER_USER} AS old_v FROM events),
l AS (SELECT *, row_number() {OVER_USER} AS rn FROM log WHERE old_v IS NOT NULL),
base AS (SELECT c_custkey AS user_id, TIMESTAMP '2023-12-01' AS created, c_mktsegment AS current FROM customer)
SELECT user_id, old_v AS value, created AS ts FROM l JOIN base USING (user_id) WHERE rn = 1
UNION SELECT user_id, new_v, ts FROM l
UNION SELECT user_id, current, created FROM base WHERE user_id NOT IN (SELECT user_id FROM l)""")
def old_new_log_to_history(t):
    from ..operators.ordered import neighbours

    rows = t.events.select("user_id", "ts", "event_id", c("event_type").alias("new_v"))
    log = neighbours(rows, ["user_id"], ["ts", "event_id"], before={"old_v": c("new_v")}).filter("old_v is not null")
    base = t.customer.select(
        c("c_custkey").alias("user_id"), moment("2023-12-01").alias("created"), c("c_mktsegment").alias("current")
    )
    return h.history_from_old_new(log, base, "user_id", "ts", "event_id", "old_v", "new_v", "created", "current")


@query("merge_attribute_timelines", """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS fault, NULL AS click FROM events
    WHERE event_type = 'error' GROUP BY 1, 2),
k AS (SELECT user_id, CAST(ts AS DATE) AS day, NULL AS fault, max(value) AS click FROM events
    WHERE event_type = 'click' GROUP BY 1, 2),
u AS (SELECT * FROM e UNION ALL SELECT * FROM k)
SELECT DISTINCT user_id, day, last_value(fault IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day) AS fault,
  last_value(click IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day) AS click FROM u""")
def merge_attribute_timelines(t):
    def daily(kind, out):
        rows = t.events.filter(c("event_type") == kind)
        return rows.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias(out))

    return h.merge_timelines([daily("error", "fault"), daily("click", "click")], "user_id", "day", ["fault", "click"])


@query("stitch_histories", f"""
WITH c AS (SELECT user_id, ts, event_id, event_type, CASE WHEN ts < TIMESTAMP '{CUT}' THEN 'old' ELSE 'new' END AS system FROM events
    WHERE (ts < TIMESTAMP '{CUT}' AND event_type <> 'view') OR (ts >= TIMESTAMP '{CUT}' AND event_type <> 'click')),
d AS (SELECT *, lag(event_type, 1, '[Unknown]') OVER (PARTITION BY user_id, system ORDER BY ts, event_id) AS was FROM c),
s AS (SELECT * EXCLUDE (was), lag(event_type, 1, '[Unknown]') {OVER_USER} AS was FROM d WHERE event_type <> was)
SELECT user_id, event_type, system, ts AS start_date,
  lead(ts, 1, TIMESTAMP '9999-12-31') {OVER_USER} AS end_date,
  CASE WHEN lead(ts) {OVER_USER} IS NULL THEN 1 ELSE 0 END AS current_record,
  CAST(row_number() {OVER_USER} AS INTEGER) AS ordinal
FROM s WHERE event_type <> was""")
def stitch_histories(t):
    """The old system knows no views, the new one no clicks."""
    rows = t.events.select("user_id", "event_type", c("ts").alias("start_date"), c("event_id").alias("tie"))
    old, new = rows.filter("event_type <> 'view'"), rows.filter("event_type <> 'click'")
    return h.stitch(old, new, "user_id", moment(CUT), ["event_type"]).drop("tie", "row_hash")


@query("end_of_day_history", f"WITH {HIST} SELECT * FROM hist")
def end_of_day_history(t):
    return h.end_of_day_view(t.events, "user_id", "ts", "event_id", ["event_type"])


@query("lifecycle_windows", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup')
SELECT user_id, lag(d, 1, DATE '1900-01-01') OVER (PARTITION BY user_id ORDER BY d) AS window_start, d AS window_end FROM d
UNION ALL SELECT user_id, max(d), DATE '9999-12-31' FROM d GROUP BY 1
UNION ALL SELECT c_custkey, DATE '1900-01-01', DATE '9999-12-31' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM d)""")
def lifecycle_windows(t):
    signups = t.events.filter("event_type = 'signup'").select("user_id", F.to_date("ts").alias("day"))
    return h.windows_from_events(signups, t.customer.select(c("c_custkey").alias("user_id")), "user_id", "day")


@query("late_changes", f"""
WITH {HIST} SELECT user_id, event_type, row_hash, start_date, end_date, current_record FROM hist""")
def late_changes(t):
    """A third of the log arrives late, in two batches; the history is re-stitched around each and is that of the whole log."""
    part = F.col("event_id") % 6
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    states = late.day_states(events.filter(part > 1), "user_id", "ts", "event_id", ["event_type"])
    versions = late.versions_of(states, "user_id", ["event_type"])
    for i in (1, 0):
        fresh = late.news(states, late.day_states(events.filter(part == i), "user_id", "ts", "event_id", ["event_type"]), "user_id", "ts", "event_id")
        # as stored between two loads
        versions = t.stage(late.restitch(versions, states, fresh, "user_id", ["event_type"]), "history")
        states = t.stage(late.with_news(states, fresh, "user_id"), "states")
    return versions
