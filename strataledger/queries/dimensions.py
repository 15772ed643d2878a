"""Dimension loads on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import dimensions as d
from .fixtures import BATCH, HIST, STORED, TRACKED, batch, stored
from .registry import query

c = F.col


@query("dimension_type2_load", f"""
WITH {HIST}, b AS (SELECT max(CAST(ts AS DATE)) - 2 AS cut FROM events)
SELECT row_number() OVER (ORDER BY greatest(start_date, CAST(cut AS DATE)), user_id, start_date) AS user_key, user_id, event_type,
  start_date, end_date, current_record FROM hist, b""")
def dimension_type2_load(t):
    """Backfill up to two days before the last, then two daily increments."""
    events = t.events.select("user_id", "event_type", "ts", "event_id")
    last = t.events.agg(F.max(F.to_date("ts"))).scalar()
    on = F.to_date("ts")
    dim = d.type2_backfill(
        [events.filter(on <= F.date_sub(last, 2))], None, "user_id", "ts", "event_id", ["event_type"], "user_key"
    )
    for back in (1, 0):
        as_of = F.date_sub(last, back)
        dim = d.type2_increment(dim, events.filter(on == as_of), "user_id", "ts", "event_id", ["event_type"], "user_key", as_of)
    return dim.select("user_key", "user_id", "event_type", "start_date", "end_date", "current_record")


@query("dimension_type2_two_systems", """
WITH l AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, CASE WHEN event_type IN ('view', 'click') THEN 'old' ELSE 'new' END AS system,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END
      ORDER BY ts DESC, event_id DESC) AS rn FROM events),
s AS (SELECT * FROM l WHERE rn = 1 AND ((system = 'old' AND day < DATE '2024-01-15') OR (system = 'new' AND day >= DATE '2024-01-15'))),
ch AS (SELECT *, lag(event_type, 1, '[Unknown]') OVER (PARTITION BY user_id ORDER BY day) AS was FROM s)
SELECT row_number() OVER (ORDER BY user_id, day) AS user_key, user_id, event_type, day AS start_date,
  lead(day, 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY day) AS end_date,
  CASE WHEN lead(day) OVER (PARTITION BY user_id ORDER BY day) IS NULL THEN 1 ELSE 0 END AS current_record
FROM ch WHERE event_type <> was""")
def dimension_type2_two_systems(t):
    """Views and clicks are the first system's log, the other events the second's, which counts from the middle of the month."""
    events = t.events.select("user_id", "event_type", "ts", "event_id")
    first = c("event_type").isin("view", "click")
    cut = F.lit("2024-01-15").cast("date")
    dim = d.type2_backfill([events.filter(first), events.filter(~first)], cut, "user_id", "ts", "event_id", ["event_type"], "user_key")
    return dim.select("user_key", "user_id", "event_type", "start_date", "end_date", "current_record")


@query("dimension_type1_load", f"""
WITH {STORED}, {BATCH}, k AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS n FROM stored),
m AS (SELECT b.*, coalesce(n, (SELECT count(*) FROM stored) + row_number() OVER (PARTITION BY n IS NULL ORDER BY b.c_custkey)) AS customer_key
  FROM batch b LEFT JOIN k USING (c_custkey))
SELECT customer_key, c_custkey, c_mktsegment, CASE WHEN c_custkey % 3 = 0 AND customer_key <= (SELECT count(*) FROM stored)
    THEN 'ID' || c_custkey WHEN c_custkey % 4 = 0 THEN 'ID' || c_custkey ELSE '[Unknown]' END AS crm_id FROM m
UNION ALL SELECT -1, -1, '[Unknown]', '[Unknown]'""")
def dimension_type1_load(t):
    """Stored customers, of whom every third has an id; every fourth customer's id turns up late."""
    crm = F.concat(F.lit("ID"), c("c_custkey").cast("string"))
    none = stored(t).withColumns({"customer_key": F.lit(0).cast("bigint"), "crm_id": crm}).limit(0)
    known = stored(t).withColumn("crm_id", F.when(c("c_custkey") % 3 == 0, crm).otherwise("[Unknown]"))
    dim = d.assign_keys(none, known, "customer_key", ["c_custkey"])
    late = t.customer.filter("c_custkey % 4 = 0").select("c_custkey", crm.alias("crm_id"))
    unknown = {"c_custkey": -1, "c_mktsegment": "[Unknown]", "crm_id": "[Unknown]"}
    out = d.type1_load(dim, batch(t), "c_custkey", TRACKED, "customer_key", late, "crm_id", unknown, stage=lambda df: t.stage(df, "new_members"))
    return out.select("customer_key", "c_custkey", "c_mktsegment", "crm_id")
