"""Fact loads on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.hashing import with_row_hash
from ..functions.numbers import money
from ..operators import history as h
from ..operators.align import aligned
from ..operators.filters import cutover
from ..operators.ordered import first_per_key, neighbours, numbered
from ..operators.project import signed_amount
from ..operators.skyline import lowest_segments
from ..operators.temporal import overlap_capped, temporal_join
from ..operators.upsert import accumulate, fill_rule
from ..plans import cases
from ..plans import referrals as ref
from ..plans import snapshot as snap
from ..plans import terminations as term
from ..plans import transactions as tx
from .fixtures import CUT, HIST, ORDER_CUT, day, hist, moment
from .people import PEOPLE_COLUMNS, people_behind, people_sql
from .registry import query
from .temporal import SLICES, customer_slices

c = F.col


def user_spine(t):
    """Every user on every day from the first event to the last day of all events."""
    last = t.events.agg(F.max(F.to_date("ts"))).scalar()
    spans = t.events.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("d0")).withColumn("d1", last)
    return h.day_spine(spans, "user_id", "d0", "d1")


SPINE = """
spans AS (SELECT user_id, min(CAST(ts AS DATE)) AS d0 FROM events GROUP BY 1),
spine AS (SELECT user_id, CAST(unnest(generate_series(d0, (SELECT max(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS day FROM spans)"""


def last_day_of(kind: str) -> str:
    return f"""(SELECT max(CAST(e.ts AS DATE)) FROM events e WHERE e.user_id = s.user_id AND e.event_type = '{kind}'
      AND CAST(e.ts AS DATE) <= s.day)"""


def key_of(col: str) -> str:
    return f"CAST(strftime({col}, '%Y%m%d') AS INTEGER)"


def snapshot_sql(days: str) -> str:
    return f"""
WITH {HIST}, {SPINE},
seen AS (SELECT s.user_id, s.day, date_diff('day', {last_day_of('click')}, s.day) AS lag_c,
    date_diff('day', {last_day_of('purchase')}, s.day) AS lag_r, date_diff('day', {last_day_of('signup')}, s.day) AS lag_n
  FROM spine s WHERE {days}),
attr AS (SELECT c_custkey, c_nationkey AS nation_key, CASE WHEN c_acctbal < 1000 THEN 3 END AS r1,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 5 WHEN c_mktsegment = 'MACHINERY' THEN 10 END AS r2
  FROM customer WHERE c_acctbal >= 0),
f AS (SELECT seen.*, nation_key, CAST(coalesce(r1, r2, 7) AS INTEGER) AS rule_days, h.start_date,
    CASE WHEN lag_c BETWEEN 0 AND 7 THEN 1 ELSE 0 END AS contact, CASE WHEN lag_r BETWEEN 0 AND 14 THEN 1 ELSE 0 END AS review,
    CASE WHEN lag_n BETWEEN 0 AND 14 THEN 1 ELSE 0 END AS network
  FROM seen LEFT JOIN attr ON seen.user_id = c_custkey
  LEFT JOIN hist h ON h.user_id = seen.user_id AND h.start_date <= day AND day < h.end_date),
{people_sql('f', 'user_id', 'day', '2024-01-10')}
SELECT user_id, {key_of('day')} AS date_key, coalesce({key_of('start_date')}, -1) AS version_key,
  coalesce(nation_key, -1) AS nation_key, rule_days, CAST(1 + contact * 4 + review * 2 + network AS INTEGER) AS status_key,
  contact, review, network, CASE WHEN lag_c BETWEEN 0 AND rule_days THEN 1 ELSE 0 END AS contact_in_rule,
  CAST(lag_c AS INTEGER) AS contact_lag, 1 AS client_count, {PEOPLE_COLUMNS} FROM f LEFT JOIN ppl ON pe = user_id AND pa = day"""


@query("daily_snapshot_fact", snapshot_sql("NOT (s.day < DATE '2024-01-05' AND (s.user_id, s.day) IN (SELECT (user_id, CAST(ts AS DATE)) FROM events))"))
def daily_snapshot_fact(t):
    """Clicks are contacts, purchases and signups the two kinds of review; the days before
    5 January on which a user had events are loaded already."""
    loaded = t.events.select("user_id", F.to_date("ts").alias("day")).filter(c("day") < day("2024-01-05")).distinct()
    return daily_rows(t, user_spine(t), t.events, loaded=loaded)


def signals_of_events():
    kind = c("event_type")
    return {"activity_day": F.to_date("ts"), "contact": kind == "click", "reviews": {"review": (kind == "purchase", 14), "network": (kind == "signup", 14)}}


def daily_rows(t, spine, activities, **more):
    attributes = t.customer.filter("c_acctbal >= 0").select(
        c("c_custkey").alias("user_id"), c("c_nationkey").alias("nation_key"),
        F.when(c("c_acctbal") < 1000, 3).alias("_r1"),
        F.when(c("c_mktsegment") == "BUILDING", 5).when(c("c_mktsegment") == "MACHINERY", 10).alias("_r2"),
    )
    versions = hist(t).select(
        "user_id", F.date_format("start_date", "yyyyMMdd").cast("int").alias("version_key"), "start_date", "end_date"
    )
    bits = t.spark.range(8).select(
        *[F.shiftright("id", n).bitwiseAND(1).cast("int").alias(f) for f, n in (("contact", 2), ("review", 1), ("network", 0))],
        (c("id") + 1).cast("int").alias("status_key"),
    )
    return snap.daily_snapshot(
        spine, activities, versions, attributes, bits, "user_id", "day", **signals_of_events(),
        rule=F.coalesce("_r1", "_r2", F.lit(7)), contact_limit=7, people=people_behind(t, "user_id", "2024-01-10"), **more,
    )


@query("daily_snapshot_runs", snapshot_sql("s.day > DATE '2024-01-12'"))
def daily_snapshot_runs(t):
    """A backfill's state of 12 January is stored, folded with the activity of six days and stored again; the days in between come from the first state and
    the later ones from the second, each run with the activity after its state alone."""
    first, second = day("2024-01-12"), day("2024-01-18")

    def after(cut):
        return t.events.filter(c("ts") >= F.date_add(cut, 1).cast("timestamp_ntz"))

    asked = {"entity": "user_id", "day": "day", **signals_of_events()}
    at_first = t.stage(snap.snapshot_state(t.events, upto=first, **asked), "state_1")
    at_second = t.stage(snap.snapshot_state(after(first), upto=second, state=at_first, since=first, **asked), "state_2")
    spine = user_spine(t)
    between = daily_rows(t, spine.filter(c("day").between(F.date_add(first, 1), second)), after(first), state=at_first, since=first)
    return between.unionByName(daily_rows(t, spine.filter(c("day") > second), after(second), state=at_second, since=second))


@query("contact_rule_violation", f"""
WITH {HIST}, {SPINE},
w1 AS (SELECT user_id, CAST(ts AS DATE) AS s, least(lead(CAST(ts AS DATE), 1, DATE '9999-12-31')
    OVER (PARTITION BY user_id ORDER BY ts, event_id), CAST(CAST(ts AS DATE) + 10 AS DATE)) AS e,
    2 + CAST(floor(value) AS INTEGER) % 4 AS v FROM events WHERE event_type = 'signup'),
custom AS (SELECT p.user_id, day, min(v) AS v FROM spine p JOIN w1 ON w1.user_id = p.user_id AND day BETWEEN s AND e GROUP BY 1, 2),
w2 AS (SELECT user_id, CAST(ts AS DATE) AS s, least(lead(CAST(ts AS DATE), 1, DATE '9999-12-31')
    OVER (PARTITION BY user_id ORDER BY ts, event_id), CAST(CAST(ts AS DATE) + 6 AS DATE)) AS e FROM events WHERE event_type = 'purchase'),
intro AS (SELECT p.user_id, day, min(CASE WHEN day <= s + 3 THEN 1 ELSE 2 END) AS v FROM spine p JOIN w2
    ON w2.user_id = p.user_id AND day BETWEEN s AND e GROUP BY 1, 2),
sd AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup'),
lw AS (SELECT user_id, d AS s, lead(d, 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY d) AS e FROM sd),
w3 AS (SELECT lw.user_id, lw.s, least(lw.e, hist.end_date) AS e FROM lw JOIN hist ON hist.user_id = lw.user_id
    AND event_type = 'error' AND lw.s BETWEEN hist.start_date AND hist.end_date),
ext AS (SELECT DISTINCT p.user_id, day, 12 AS v FROM spine p JOIN w3 ON w3.user_id = p.user_id AND day BETWEEN s AND e),
ruled AS (SELECT s.user_id, s.day, CAST(coalesce(custom.v, intro.v,
    CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 8000 THEN 3 END, CASE WHEN c_mktsegment = 'BUILDING' THEN 6 END,
    CASE WHEN c_acctbal > 5000 THEN 4 END, ext.v, CASE WHEN c_mktsegment = 'MACHINERY' THEN 5 END, 9) AS INTEGER) AS rule_days
  FROM spine s LEFT JOIN customer ON c_custkey = s.user_id
  LEFT JOIN custom ON custom.user_id = s.user_id AND custom.day = s.day
  LEFT JOIN intro ON intro.user_id = s.user_id AND intro.day = s.day
  LEFT JOIN ext ON ext.user_id = s.user_id AND ext.day = s.day),
lagged AS (SELECT s.*, date_diff('day', {last_day_of('click')}, s.day) AS lag_c, date_diff('day',
    (SELECT arg_max(CAST(e.ts AS DATE), e.event_id) FROM events e WHERE e.user_id = s.user_id AND e.event_type = 'view'
      AND CAST(e.ts AS DATE) <= s.day), s.day) AS lag_r FROM ruled s)
SELECT user_id, {key_of('day')} AS date_key, CAST(CASE WHEN rule_days < 12 THEN 100 + rule_days ELSE -1 END AS INTEGER) AS frequency_key,
  CASE WHEN lag_c BETWEEN 0 AND rule_days OR lag_r BETWEEN 0 AND rule_days THEN 0 ELSE 1 END AS violation, 1 AS client_count
FROM lagged""")
def contact_rule_violation(t):
    """Custom rule after signups, introduction rule after purchases, then segment rules; the
    extended rule holds where a signup window starts inside an error version. The result is written
    into snapshot rows that have neither; twelve days are not in the frequency dimension."""
    spine = user_spine(t)
    kind, today = c("event_type"), F.to_date("ts")
    ev = t.events.select("event_id", "user_id", "event_type", "ts", "value", today.alias("start"))

    def windows(name, length):
        rows = ev.filter(kind == name)
        return h.capped_windows(rows, ["user_id"], "start", length, order=["ts", "event_id"]).select(
            "user_id", c("start").alias("start_date"), "end_date", "value"
        )

    custom = windows("signup", 10).groupBy("user_id", "start_date", "end_date").agg(
        F.min(F.floor("value").cast("int") % 4 + 2).alias("v")
    )
    # one day's contact for the first days of a window, two for all of it
    first_days = F.explode(F.array(F.struct(F.least("end_date", F.date_add("start_date", 3)).alias("end_date"), F.lit(1).alias("v")), F.struct("end_date", F.lit(2).alias("v"))))
    intro = windows("purchase", 6).select("user_id", "start_date", first_days.alias("w")).select("user_id", "start_date", "w.*").distinct()
    signup_days = ev.filter(kind == "signup").select("user_id", c("start").alias("b_start")).distinct()
    signup_windows = h.close_with_next(signup_days, ["user_id"], ["b_start"], "b_start", "b_end", "cur", split=False).drop("cur")
    faults = hist(t).filter(kind == "error").select("user_id", c("start_date").alias("a_start"), c("end_date").alias("a_end"))
    extended = overlap_capped(
        faults, signup_windows, "user_id", ("a_start", "a_end"), ("b_start", "b_end"), ("start_date", "end_date"),
    ).select("user_id", "start_date", "end_date")
    attributes = t.customer.select(c("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal")
    building = c("c_mktsegment") == "BUILDING"
    ruled = snap.contact_rules(spine, attributes, [
        ("custom", lowest_segments(custom, "user_id", c("v"), "custom")),
        ("intro", lowest_segments(intro, "user_id", c("v"), "intro")),
        ("senior", F.when(building & (c("c_acctbal") > 8000), 3)),
        ("building", F.when(building, 6)),
        ("wealthy", F.when(c("c_acctbal") > 5000, 4)),
        ("extended", lowest_segments(extended, "user_id", F.lit(12), "extended")),
        ("trading", F.when(c("c_mktsegment") == "MACHINERY", 5)),
    ], "user_id", "day", default=9)
    violations = snap.contact_violation(
        ruled, t.events, "user_id", "day", today, contact=kind == "click", review=kind == "view", review_id="event_id"
    )
    fact = spine.select(
        "user_id", date_key(c("day")).alias("date_key"), F.lit(-1).alias("frequency_key"), F.lit(0).alias("violation"),
        F.lit(1).alias("client_count"),
    )
    frequencies = t.spark.range(1, 12).select(
        c("id").cast("int").alias("rule_days"), (c("id") + 100).cast("int").alias("frequency_key")
    )
    return snap.update_snapshot(fact, violations, frequencies, ["user_id", "date_key"])


MOVEMENT = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def flows(t):
    """Order lines as account movements, each with a number of its own in its order."""
    lines = numbered(t.lineitem, ["l_orderkey"], MOVEMENT, "movement", split=False)  # an order has a few lines
    # orders meet their customers first, so that lines are shuffled for their order only
    owned = t.orders.join(t.customer.hint("merge"), c("o_custkey") == c("c_custkey"))
    joined = lines.join(owned.hint("merge"), c("l_orderkey") == c("o_orderkey"))
    stock = F.when(c("l_returnflag") == "A", "S").otherwise("F")
    way = F.when(c("l_linestatus") == "F", "I").otherwise("O")
    first = F.when(c("l_linenumber") == 1, "I").otherwise("")
    return joined.select(
        c("l_orderkey").alias("ref_no"), c("movement").alias("sub_no"), c("o_custkey").alias("account"),
        F.concat(first, stock, way).alias("code"), money(c("l_quantity") * 100).alias("amount"),
        c("c_nationkey").alias("currency"), F.to_date("l_shipdate").alias("trade_date"),
        F.when(c("l_returnflag") == "R", F.date_add("l_shipdate", 5)).alias("cancelled_on"),
        c("o_orderdate").alias("updated"), "o_orderpriority", "o_orderstatus",
    )


FLOWS = f"""
lines1 AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(MOVEMENT)}) AS INTEGER) AS movement FROM lineitem),
flow0 AS (SELECT l_orderkey AS ref_no, movement AS sub_no, o_custkey AS account,
    (CASE WHEN l_linenumber = 1 THEN 'I' ELSE '' END) || (CASE WHEN l_returnflag = 'A' THEN 'S' ELSE 'F' END)
      || (CASE WHEN l_linestatus = 'F' THEN 'I' ELSE 'O' END) AS code,
    CAST(l_quantity * 100 AS DECIMAL(18,2)) AS amount, c_nationkey AS currency, CAST(l_shipdate AS DATE) AS trade_date,
    CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) + 5 AS DATE) END AS cancelled_on, o_orderdate AS updated,
    o_orderpriority, o_orderstatus
  FROM lines1 JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

IN_CODES = ["FI", "IFI", "SI", "ISI"]


@query("cancellation_rows", f"""
WITH {FLOWS}, r AS (SELECT *, 'New Record' AS record_type, 1 AS flow_count FROM flow0
  UNION ALL SELECT *, 'Cancelled Record', -1 FROM flow0 WHERE cancelled_on IS NOT NULL)
SELECT ref_no, sub_no, record_type, flow_count, CAST(amount * flow_count * (CASE WHEN code IN ('FI', 'IFI', 'SI', 'ISI')
  THEN 1 ELSE -1 END) AS DECIMAL(18,2)) AS flow_amount, CASE WHEN flow_count = -1 THEN cancelled_on END AS cancelled_on FROM r""")
def cancellation_rows(t):
    rows = tx.new_and_cancelled(flows(t), "cancelled_on")
    cancelled = c("cancelled_on").isNotNull()
    return rows.select(
        "ref_no", "sub_no", "record_type", F.when(cancelled, -1).otherwise(1).alias("flow_count"),
        signed_amount(c("amount"), c("code"), IN_CODES, cancelled).alias("flow_amount"), "cancelled_on",
    )


@query("transaction_fact", f"""
WITH {FLOWS}, {SLICES},
moves AS (SELECT c_custkey AS k, CAST(DATE '1997-01-01' + c_nationkey * 40 AS DATE) AS moved_on FROM customer
          WHERE c_mktsegment <> 'MACHINERY'),
fl AS (SELECT flow0.*, 'old' AS system FROM flow0 LEFT JOIN moves ON account = k WHERE o_orderpriority <> '5-LOW'
    AND (moved_on IS NULL OR trade_date < moved_on)
  UNION ALL SELECT flow0.*, 'new' FROM flow0 JOIN moves ON account = k WHERE o_orderpriority <> '1-URGENT' AND trade_date >= moved_on),
stored AS (SELECT ref_no, sub_no, system, 1 AS flow_count, updated FROM fl
    WHERE updated < TIMESTAMP '2001-01-01' AND o_orderstatus <> 'P'),
recent AS (SELECT * FROM fl WHERE updated >= (SELECT max(updated) - INTERVAL 1 DAY FROM stored)),
batch AS (SELECT * FROM recent UNION ALL SELECT * FROM fl WHERE (ref_no, sub_no, system) NOT IN (SELECT (ref_no, sub_no, system) FROM stored)
    AND (ref_no, sub_no, system) NOT IN (SELECT (ref_no, sub_no, system) FROM recent)),
days AS (SELECT DISTINCT account, amount, right(code, 2) AS cls, currency, trade_date FROM fl),
prev AS (SELECT *, lag(trade_date) OVER (PARTITION BY account, amount, cls, currency ORDER BY trade_date) AS p FROM days),
lagged AS (SELECT b.*, date_diff('day', p, b.trade_date) AS days_lag FROM batch b LEFT JOIN prev ON b.account = prev.account
    AND b.amount = prev.amount AND right(b.code, 2) = cls AND b.currency = prev.currency AND b.trade_date = prev.trade_date),
r AS (SELECT *, 'New Record' AS record_type, 1 AS flow_count FROM lagged
  UNION ALL SELECT *, 'Cancelled Record', -1 FROM lagged WHERE cancelled_on IS NOT NULL),
rates AS (SELECT DISTINCT currency, trade_date, 100 + currency + day(trade_date) AS q FROM flow0 WHERE o_orderstatus = 'F'),
o AS (SELECT r.*, nation AS owner_key, coalesce(q, 100) AS q, (CASE WHEN code IN ('FI', 'IFI', 'SI', 'ISI') THEN 1 ELSE -1 END) AS way
  FROM r LEFT JOIN cust ON account = c_custkey AND cs <= r.trade_date AND r.trade_date < ce
  LEFT JOIN rates ON r.currency = rates.currency AND r.trade_date = rates.trade_date),
{people_sql('o', 'account', 'trade_date', '1998-01-01')}
SELECT ref_no, sub_no, system, {key_of('trade_date')} AS trade_date_key,
  CASE WHEN flow_count = -1 THEN {key_of('cancelled_on')} ELSE -1 END AS cancelled_date_key,
  coalesce(owner_key, -1) AS owner_key,
  CAST(CASE WHEN amount >= 4000 AND way = -1 THEN -1 ELSE (CASE WHEN way = 1 THEN 100 ELSE 200 END)
    + (CASE WHEN left(right(code, 2), 1) = 'S' THEN 10 ELSE 20 END) + (CASE WHEN amount >= 4000 THEN 2 ELSE 1 END) END AS INTEGER)
    AS flow_type_key,
  CAST(way * flow_count * CAST((2 * CAST(amount * 100 AS BIGINT) * 100 + q) // (2 * q) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))
    AS flow_amount,
  CAST(amount * way * flow_count AS DECIMAL(18,2)) AS flow_amount_original, flow_count,
  CAST(days_lag AS INTEGER) AS recurring_days_lag, record_type, {PEOPLE_COLUMNS}
FROM o LEFT JOIN ppl ON pe = account AND pa = trade_date WHERE (ref_no, sub_no, flow_count, system) NOT IN (SELECT (ref_no, sub_no, flow_count, system) FROM stored)""")
def transaction_fact(t):
    """Two systems with a cutover per customer; partial orders arrive late; all cancelled rows
    are new. Large outflows have no flow type."""
    every = t.stage(flows(t), "movements")
    moves = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        c("c_custkey").alias("account"), F.date_add(day("1997-01-01"), c("c_nationkey") * 40).alias("moved_on")
    )
    held = (c("o_orderpriority") != "5-LOW", c("o_orderpriority") != "1-URGENT")
    moved = t.stage(cutover(every, None, moves, "account", "trade_date", "moved_on", held=held).drop("o_orderpriority"), "flows")
    rates = every.filter("o_orderstatus = 'F'").select("currency", "trade_date").distinct().withColumn(
        "rate", ((F.lit(100) + c("currency") + F.day("trade_date")) / F.lit(100)).cast("decimal(19,13)")
    )
    rates = t.stage(rates, "rates")
    t.drop("movements")
    earlier = (c("updated") < F.lit("2001-01-01").cast("timestamp_ntz")) & (c("o_orderstatus") != "P")
    stored = t.stage(moved.filter(earlier).select("ref_no", "sub_no", "system", "updated", F.lit(1).alias("flow_count")), "stored")
    owners = customer_slices(t).select(
        c("o_custkey").alias("account"), c("nation").alias("owner_key"), c("cs").alias("start_date"), c("ce").alias("end_date")
    )
    large = F.when(c("amount") >= 4000, "large").otherwise("small")
    types = t.spark.range(7).select(
        F.when(c("id") < 4, 1).otherwise(-1).alias("direction"),
        F.when(c("id").isin(0, 1, 4), "S").otherwise("F").alias("asset"),
        F.when(c("id").isin(1, 3), "large").otherwise("small").alias("size"),
    ).filter(c("id") < 6)
    types = types.withColumn("flow_type_key", (
        F.when(c("direction") == 1, 100).otherwise(200) + F.when(c("asset") == "S", 10).otherwise(20)
        + F.when(c("size") == "large", 2).otherwise(1)
    ))
    return tx.transaction_fact(
        moved.drop("o_orderstatus"), stored, owners, rates, types, "account", ["ref_no", "sub_no"], IN_CODES, large,
        people_behind(t, "account", "1998-01-01"), t.stage, t.drop,
    )


def referral_inputs(t):
    """Orders as referrals of three sources; the smallest supplier of an order is named on it."""
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("supp"))
    who, title = F.concat(F.lit(" "), c("supp").cast("string")), F.lit("on behalf")
    swap = (c("o_orderstatus") == "F") & (c("o_orderpriority") == "1-URGENT")
    refs = t.orders.join(first.hint("merge"), c("o_orderkey") == c("l_orderkey"), "left").select(
        F.when(c("o_orderstatus") == "F", "US").when(c("o_orderstatus") == "O", "EU").otherwise("UK").alias("source"),
        c("o_orderkey").alias("referral_id"), c("o_custkey").alias("client_id"), F.to_date("o_orderdate").alias("referral_date"),
        F.when(swap, title).otherwise(who).alias("user_id"), F.when(swap, who).otherwise(title).alias("user_name"),
    )
    people = t.supplier.select(
        c("s_suppkey").cast("string").alias("user_id"), c("s_suppkey").alias("person_id"),
        F.date_add(day("1995-01-01"), c("s_nationkey") * 30).alias("first_start"),
        F.date_add(day("1996-12-01"), c("s_nationkey") * 30).alias("last_start"),
        F.when(c("s_acctbal") < 2000, day("1999-01-01")).alias("left_on"),
    )
    assignments = customer_slices(t).select(
        c("o_custkey").alias("client_id"), c("nation").cast("bigint").alias("assigned_id"), c("cs").alias("from_date"), c("ce").alias("to_date")
    )
    shipped = t.lineitem.join(t.orders.hint("merge"), (c("o_orderkey") == c("l_orderkey")) & (c("l_shipdate") > c("o_orderdate")))
    funded = shipped.groupBy(c("o_orderkey").alias("referral_id")).agg(F.to_date(F.min("l_shipdate")).alias("trading_date"))
    return refs, people, assignments, funded


REFERRALS = f"""
{SLICES},
first AS (SELECT l_orderkey, min(l_suppkey) AS supp FROM lineitem GROUP BY 1),
refs AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'US' WHEN 'O' THEN 'EU' ELSE 'UK' END AS source, o_orderkey AS referral_id,
    o_custkey AS client_id, CAST(o_orderdate AS DATE) AS referral_date, supp FROM orders LEFT JOIN first ON o_orderkey = l_orderkey),
people AS (SELECT s_suppkey AS person_id, CAST(DATE '1995-01-01' + s_nationkey * 30 AS DATE) AS first_start,
    CAST(DATE '1996-12-01' + s_nationkey * 30 AS DATE) AS last_start,
    CASE WHEN s_acctbal < 2000 THEN DATE '1999-01-01' ELSE DATE '9999-12-31' END AS left_on FROM supplier),
funded AS (SELECT l_orderkey AS referral_id, min(CAST(l_shipdate AS DATE)) AS trading_date FROM lineitem JOIN orders
    ON o_orderkey = l_orderkey AND l_shipdate > o_orderdate GROUP BY 1),
base AS (SELECT refs.*, trading_date FROM refs LEFT JOIN funded USING (referral_id)),
cred AS (SELECT base.*, person_id FROM base JOIN people ON supp = person_id
    AND CASE WHEN referral_date < last_start THEN first_start ELSE last_start END <= referral_date AND left_on >= referral_date),
rest AS (SELECT b.*, p1.person_id AS sub_id, p2.person_id AS fun_id FROM base b
    LEFT JOIN cust c1 ON c1.c_custkey = client_id AND c1.cs <= referral_date AND referral_date < c1.ce
    LEFT JOIN people p1 ON p1.person_id = c1.nation AND CASE WHEN referral_date < p1.last_start THEN p1.first_start
      ELSE p1.last_start END <= referral_date AND p1.left_on >= referral_date
    LEFT JOIN cust c2 ON c2.c_custkey = client_id AND c2.cs <= trading_date AND trading_date < c2.ce
    LEFT JOIN people p2 ON p2.person_id = c2.nation AND CASE WHEN trading_date < p2.last_start THEN p2.first_start
      ELSE p2.last_start END <= trading_date AND p2.left_on >= trading_date
    WHERE referral_id NOT IN (SELECT referral_id FROM cred)),
both_ AS (SELECT source, referral_id, client_id, referral_date, trading_date, 'Credited' AS attribution, person_id AS sub_id,
    CASE WHEN trading_date IS NOT NULL THEN person_id END AS fun_id FROM cred
  UNION ALL SELECT source, referral_id, client_id, referral_date, trading_date, 'Derived', sub_id, fun_id FROM rest),
fact AS (SELECT source, referral_id, client_id, attribution, coalesce(sub_id, -1) AS person_key, coalesce(fun_id, -1) AS person_funded_key,
    {key_of('referral_date')} AS referral_date_key, coalesce({key_of('trading_date')}, -1) AS trading_date_key, 1 AS referral_count,
    CASE WHEN trading_date IS NULL THEN 0 ELSE 1 END AS funded_count,
    CASE WHEN referral_date <= lag(referral_date) OVER (PARTITION BY client_id, source ORDER BY referral_date, referral_id)
      + INTERVAL 12 MONTH THEN 1 ELSE 0 END AS referred_in_12_months,
    CAST(date_diff('day', referral_date, trading_date) AS INTEGER) AS funding_days_lag,
    CASE WHEN trading_date IS NULL THEN 0 ELSE 1 END AS completed FROM both_)"""


@query("referral_fact", f"""
WITH {REFERRALS}, {people_sql('refs', 'client_id', 'referral_date', '1998-01-01')}
SELECT fact.*, {PEOPLE_COLUMNS} FROM fact JOIN refs ON fact.source = refs.source AND fact.referral_id = refs.referral_id
LEFT JOIN ppl ON pe = refs.client_id AND pa = referral_date""")
def referral_fact(t):
    """The stored fact knows the referrals before mid-1998 and their funding up to then; the
    accumulating load fills in later funding and adds the newer referrals."""
    refs, people, assignments, funded = referral_inputs(t)
    swapped = c("source") == "US"
    fact = ref.referral_fact(refs, people, assignments, funded, swapped, behind=people_behind(t, "client_id", "1998-01-01"))
    fact = t.stage(fact, "fact")  # read as it was at the cut and as it is
    stored = known_at_cut(fact)
    unset = {"person_funded_key": -1, "trading_date_key": -1, "funded_count": 0, "funding_days_lag": None}
    fill = fill_rule(unset, c("completed") == 0, {"completed": c("s_completed")})
    return accumulate(stored, fact, ["source", "referral_id"], [fill])


def known_at_cut(fact):
    """The fact as it was known at the cut: newer referrals and later fundings have not come yet."""
    cut = int(ORDER_CUT.replace("-", ""))
    late = c("trading_date_key") >= cut
    return fact.filter(c("referral_date_key") < cut).withColumns({
        "person_funded_key": F.when(late, F.lit(-1).cast("bigint")).otherwise(c("person_funded_key")),
        "funded_count": F.when(late, 0).otherwise(c("funded_count")),
        "completed": F.when(late, 0).otherwise(c("completed")),
        "funding_days_lag": F.when(~late, c("funding_days_lag")),
        "trading_date_key": F.when(late, -1).otherwise(c("trading_date_key")),
    })


TRACKED_REFERRAL = ["person_key", "person_funded_key", "trading_date_key", "funded_count", "completed"]


@query("referral_adjustments", f"""
WITH {REFERRALS}, cut AS (SELECT {int(ORDER_CUT.replace("-", ""))} AS d),
f0 AS (SELECT source, referral_id, person_key, CASE WHEN trading_date_key >= d THEN -1 ELSE person_funded_key END AS person_funded_key,
    CASE WHEN trading_date_key >= d THEN -1 ELSE trading_date_key END AS trading_date_key,
    CASE WHEN trading_date_key >= d THEN 0 ELSE funded_count END AS funded_count, CASE WHEN trading_date_key >= d THEN 0 ELSE completed END AS completed
  FROM fact, cut WHERE referral_date_key < d),
j AS (SELECT f.source, f.referral_id, f.person_key AS p1, f.person_funded_key AS q1, f.trading_date_key AS t1, f.funded_count AS n1, f.completed AS c1, f0.*
      EXCLUDE (source, referral_id), f0.referral_id IS NOT NULL AS was,
      f0.referral_id IS NOT NULL AND (f.person_key, f.person_funded_key, f.trading_date_key, f.funded_count, f.completed)
        <> (f0.person_key, f0.person_funded_key, f0.trading_date_key, f0.funded_count, f0.completed) AS moved
    FROM fact f LEFT JOIN f0 ON f.source = f0.source AND f.referral_id = f0.referral_id)
SELECT source, referral_id, person_key, person_funded_key, trading_date_key, funded_count, completed, DATE '1900-01-01' AS start_date,
  CASE WHEN moved THEN DATE '{ORDER_CUT}' ELSE DATE '9999-12-31' END AS end_date, CASE WHEN moved THEN 0 ELSE 1 END AS current_record FROM j WHERE was
UNION ALL SELECT source, referral_id, p1, q1, t1, n1, c1, DATE '{ORDER_CUT}', DATE '9999-12-31', 1 FROM j WHERE moved OR NOT was""")
def referral_adjustments(t):
    """The history of the derived values: as known at the cut, then adjusted by the load that saw later funding and newer referrals."""
    return adjusted(t)[0].drop("row_hash")


def adjusted(t):
    refs, people, assignments, funded = referral_inputs(t)
    key = ["source", "referral_id"]
    fact = ref.referral_fact(refs, people, assignments, funded, c("source") == "US").select(*key, "referral_date_key", "funding_days_lag", *TRACKED_REFERRAL)
    fact = t.stage(fact, "derived")  # read as it was at the cut and as it is
    first = with_row_hash(known_at_cut(fact).select(*key, *TRACKED_REFERRAL), TRACKED_REFERRAL).withColumns({
        "start_date": day("1900-01-01"), "end_date": day("9999-12-31"), "current_record": F.lit(1),
    })
    return ref.adjust(first, fact, key, TRACKED_REFERRAL, day(ORDER_CUT)), first


@query("referral_fact_from_history", f"""
WITH {REFERRALS} SELECT source, referral_id, person_key, person_funded_key, trading_date_key, funded_count, completed FROM fact""")
def referral_fact_from_history(t):
    """The stored fact, whose open rows are updated in full from the adjustment history's current rows."""
    history, first = adjusted(t)
    key = ["source", "referral_id"]
    return ref.fact_of(history, key, TRACKED_REFERRAL, first.select(*key, *TRACKED_REFERRAL), "completed")


@query("attribution_waterfall", f"""
WITH {SLICES}, credit AS (SELECT l_orderkey, min(l_suppkey) AS owner_id FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o_orderkey, owner_id, 'Credited' AS attribution FROM orders JOIN credit ON o_orderkey = l_orderkey
UNION ALL SELECT o_orderkey, CAST(nation AS BIGINT), 'Derived' FROM orders LEFT JOIN cust ON o_custkey = c_custkey
  AND cs <= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < ce
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM credit)""")
def attribution_waterfall(t):
    """Orders with a return are credited to its supplier, the others to the customer's nation then."""
    credit = t.lineitem.filter("l_returnflag = 'R'").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("owner_id")
    )
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    explicit = credit.join(orders.select("o_orderkey"), "o_orderkey")
    derived = temporal_join(orders, customer_slices(t), ["o_custkey"], "day", "cs", "ce", how="left").select(
        "o_orderkey", c("nation").cast("bigint").alias("owner_id")
    )
    return ref.attribution_waterfall(explicit, orders, derived, ["o_orderkey"])


def signup_windows(t):
    """Windows between signup days, cleared by the first purchase inside."""
    days = t.events.filter("event_type = 'signup'").select("user_id", F.to_date("ts").alias("d")).distinct()
    buys = t.events.filter("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("bought")).distinct()
    led = neighbours(days, ["user_id"], ["d"], after={"nxt": c("d")}, split=False)
    spans = led.select("user_id", "d", F.coalesce("nxt", day("9999-12-31")).alias("nxt"))
    inside = temporal_join(buys, spans, ["user_id"], "bought", "d", "nxt")
    first = inside.groupBy("user_id", "d").agg(F.min("bought").alias("cleared_on"))
    onboarding = days.join(first, ["user_id", "d"], "left")
    return term.clearance_windows(onboarding, "user_id", "d", "cleared_on")


CLEARANCE = """
sd AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup'),
sw AS (SELECT user_id, d, lead(d, 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY d) AS nxt FROM sd),
cw AS (SELECT sw.user_id, d AS w0, nxt AS w1, min(CAST(e.ts AS DATE)) AS cleared_on FROM sw LEFT JOIN events e
    ON e.user_id = sw.user_id AND event_type = 'purchase' AND CAST(e.ts AS DATE) >= d AND CAST(e.ts AS DATE) < nxt GROUP BY 1, 2, 3)"""


@query("aligned_histories", f"""
WITH {HIST}, {CLEARANCE},
cuts AS (SELECT user_id, start_date AS d FROM hist UNION SELECT user_id, end_date FROM hist UNION SELECT user_id, w0 FROM cw UNION SELECT user_id, w1 FROM cw),
seg AS (SELECT user_id, d, lead(d) OVER (PARTITION BY user_id ORDER BY d) AS nxt FROM cuts)
SELECT seg.user_id, d AS start_date, nxt AS end_date, event_type, w0 AS window_start, cleared_on FROM seg
LEFT JOIN hist ON hist.user_id = seg.user_id AND hist.start_date <= d AND d < hist.end_date LEFT JOIN cw ON cw.user_id = seg.user_id AND w0 <= d AND d < w1
WHERE nxt IS NOT NULL AND (event_type IS NOT NULL OR w0 IS NOT NULL)""")
def aligned_histories(t):
    """States and signup windows of the users, cut into segments in which neither changes."""
    windows = signup_windows(t).select("user_id", c("window_start").alias("start_date"), c("window_end").alias("end_date"), "window_start", "cleared_on")
    return aligned({"state": (hist(t), ["event_type"]), "window": (windows, ["window_start", "cleared_on"])}, "user_id")


@query("clearance_type_at_event", f"""
WITH {CLEARANCE} SELECT event_id, e.user_id, CASE WHEN cleared_on IS NULL THEN 'Non-Trading' ELSE 'Trading' END AS clearance_type
FROM events e LEFT JOIN cw ON cw.user_id = e.user_id AND w0 <= CAST(ts AS DATE) AND CAST(ts AS DATE) < w1
WHERE event_type = 'error'""")
def clearance_type_at_event(t):
    errors = t.events.filter("event_type = 'error'").select("event_id", "user_id", F.to_date("ts").alias("day"))
    return term.clearance_type(errors, signup_windows(t), "user_id", "day").select("event_id", "user_id", "clearance_type")


@query("termination_fact", f"""
WITH {HIST}, {CLEARANCE},
w AS (SELECT *, lag(event_type, 1, '[Unknown]') OVER (PARTITION BY user_id ORDER BY start_date) AS was FROM hist),
fl AS (SELECT user_id, start_date AS d, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS threat,
    CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS term,
    CASE WHEN was = 'error' AND event_type IN ('view', 'click', 'purchase') THEN 1 ELSE 0 END AS save FROM w),
sq AS (SELECT *, lead(d) OVER u AS nd, lead(term) OVER u AS nterm, lead(save) OVER u AS nsave, lag(threat) OVER u AS pthreat
  FROM fl WHERE threat + term + save > 0 WINDOW u AS (PARTITION BY user_id ORDER BY d)),
ev AS (SELECT user_id, d AS event_date, 1 AS threat_count, CASE WHEN nsave = 1 THEN 1 ELSE 0 END AS save_count,
    CASE WHEN nterm = 1 THEN 1 ELSE 0 END AS term_count, d AS threat_date, CASE WHEN nsave = 1 THEN nd END AS save_date,
    CASE WHEN nterm = 1 THEN nd END AS term_date, CASE WHEN nterm = 1 OR nsave = 1 THEN 1 ELSE 0 END AS completed FROM sq WHERE threat = 1
  UNION ALL SELECT user_id, d, 0, 0, 1, NULL, NULL, d, 1 FROM sq WHERE term = 1 AND coalesce(pthreat, 0) = 0),
bal AS (SELECT user_id, event_type AS account, CAST(ts AS DATE) AS bd, max(CAST(value AS DECIMAL(18,2))) AS balance FROM events GROUP BY 1, 2, 3),
amt AS (SELECT user_id, event_date, CAST(sum(balance) AS DECIMAL(28,2)) AS amount FROM (
    SELECT ev.user_id, ev.event_date, balance, row_number() OVER (PARTITION BY ev.user_id, ev.event_date, account ORDER BY bd DESC) AS rn
    FROM (SELECT DISTINCT user_id, event_date FROM ev) ev JOIN bal ON bal.user_id = ev.user_id AND bd <= event_date
      AND bd >= event_date - 10) WHERE rn = 1 GROUP BY 1, 2),
{people_sql('ev', 'user_id', 'event_date', '2024-01-10')}
SELECT ev.user_id, {key_of('ev.event_date')} AS event_date_key, coalesce({key_of('threat_date')}, -1) AS threat_date_key,
  coalesce({key_of('save_date')}, -1) AS save_date_key, coalesce({key_of('term_date')}, -1) AS term_date_key,
  threat_count, save_count, term_count, completed, amount, coalesce(o.event_type, '[Unknown]') AS owner_before,
  CASE WHEN cleared_on IS NULL THEN 'Non-Trading' ELSE 'Trading' END AS clearance_type, {PEOPLE_COLUMNS}
FROM ev LEFT JOIN ppl ON pe = ev.user_id AND pa = ev.event_date LEFT JOIN amt ON amt.user_id = ev.user_id AND amt.event_date = ev.event_date
LEFT JOIN hist o ON o.user_id = ev.user_id AND o.start_date <= ev.event_date - 3 AND ev.event_date - 3 < o.end_date
LEFT JOIN cw ON cw.user_id = ev.user_id AND w0 <= ev.event_date AND ev.event_date < w1""")
def termination_fact(t):
    """Error versions are threats, a following signup is the termination, anything else a save;
    the amount adds up the latest values per event type within ten days."""
    versions = hist(t)
    events = term.termination_events(versions, "user_id", "event_type", "error", ["view", "click", "purchase"], "signup")
    balances = t.events.groupBy("user_id", c("event_type").alias("account"), F.to_date("ts").alias("balance_day")).agg(
        F.max(money(c("value"))).alias("balance")
    )
    return term.termination_fact(
        events, balances, versions, signup_windows(t), "user_id", "account", "balance_day", 10, "event_type", 3,
        people_behind(t, "user_id", "2024-01-10"),
    )


@query("termination_amounts", """
WITH ev AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS event_date FROM events WHERE event_type = 'error'),
bal AS (SELECT user_id, event_type AS account, CASE WHEN event_type IN ('view', 'click') THEN 'A' ELSE 'B' END AS currency, CAST(ts AS DATE) AS bd,
    max(CAST(value AS DECIMAL(18,2))) AS balance FROM events GROUP BY 1, 2, 3, 4),
rates AS (SELECT currency, d, CAST(CASE WHEN currency = 'A' THEN 125 ELSE 80 END + day(d) AS DECIMAL(9,2)) / 100 AS rate
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup'), (VALUES ('A'), ('B')) v(currency)),
held AS (SELECT ev.user_id, ev.event_date, currency, balance, row_number() OVER (PARTITION BY ev.user_id, ev.event_date, account ORDER BY bd DESC) AS rn
  FROM ev JOIN bal ON bal.user_id = ev.user_id AND bd <= event_date AND bd >= event_date - 10),
s AS (SELECT user_id, event_date, currency, sum(balance) AS total FROM held WHERE rn = 1 GROUP BY 1, 2, 3),
c AS (SELECT s.*, (SELECT CAST(CASE WHEN s.currency = 'A' THEN 125 ELSE 80 END + day(max(d)) AS BIGINT) FROM rates r WHERE r.currency = s.currency AND r.d <= s.event_date) AS cents FROM s)
SELECT user_id, event_date, CAST(sum(CAST((CAST(total * 100 AS BIGINT) * coalesce(cents, 100) + 50) // 100 AS DECIMAL(18,0)) * 0.01) AS DECIMAL(28,2)) AS amount FROM c GROUP BY 1, 2""")
def termination_amounts(t):
    """Error days with the balances of the last ten days, in two currencies, at the latest rate; rates come on signup days."""
    at = F.to_date("ts")
    errors = t.events.filter("event_type = 'error'").select("user_id", at.alias("event_date"))
    currency = F.when(c("event_type").isin("view", "click"), "A").otherwise("B").alias("currency")
    balances = t.events.groupBy("user_id", c("event_type").alias("account"), currency, at.alias("balance_day")).agg(F.max(money(c("value"))).alias("balance"))
    days = t.events.filter("event_type = 'signup'").select(at.alias("rate_date")).distinct()
    kinds = days.withColumn("currency", F.explode(F.array(F.lit("A"), F.lit("B"))))
    rates = kinds.withColumn("rate", ((F.when(c("currency") == "A", 125).otherwise(80) + F.day("rate_date")) / F.lit(100)).cast("decimal(9,2)"))
    return term.converted_amounts(errors, balances, rates, "user_id", "account", "currency", "event_date", "balance_day", 10)


CASES = f"""
acts AS (SELECT user_id * 100 + week(ts) AS case_id, user_id, CAST(ts AS DATE) AS d, ts, row_number() OVER (PARTITION BY user_id, week(ts) ORDER BY ts, event_id) AS rn,
    CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'click' THEN 4 ELSE 0 END AS a FROM events),
walk AS (SELECT case_id, 0 AS rn, 0 AS b, 0 AS s FROM acts WHERE rn = 1 UNION ALL
  SELECT w.case_id, acts.rn, w.s, CASE WHEN a = 0 THEN w.s WHEN a = 1 THEN CASE WHEN w.s = 0 THEN 1 ELSE w.s END
    WHEN w.s = 0 THEN 0 WHEN a = 2 THEN 2 WHEN a = 3 THEN 3 ELSE 1 END FROM walk w JOIN acts ON acts.case_id = w.case_id AND acts.rn = w.rn + 1),
steps AS (SELECT acts.*, walk.b, walk.s FROM walk JOIN acts ON acts.case_id = walk.case_id AND acts.rn = walk.rn),
cutoffs AS (SELECT * FROM (VALUES (TIMESTAMP '{CUT}', 'Stored'), (TIMESTAMP '9999-01-01', 'Batch')) v(upto, kind)),
st AS (SELECT kind, case_id, any_value(user_id) AS user_id, arg_max(s, rn) AS s, min(d) FILTER (b = 0 AND s <> b) AS opened,
    arg_max(d, rn) FILTER (s <> b AND s <> 1) AS ended FROM steps JOIN cutoffs ON ts < upto GROUP BY 1, 2),
cr AS (SELECT kind, case_id, user_id, {key_of('CASE WHEN s = 1 THEN opened ELSE ended END')} AS event_date_key, {key_of('opened')} AS threat_date_key,
    CASE WHEN s = 2 THEN {key_of('ended')} ELSE -1 END AS save_date_key, CASE WHEN s = 3 THEN {key_of('ended')} ELSE -1 END AS term_date_key,
    CASE WHEN s = 2 THEN 1 ELSE 0 END AS save_count, CASE WHEN s = 3 THEN 1 ELSE 0 END AS term_count, CASE WHEN s = 1 THEN 0 ELSE 1 END AS completed
  FROM st WHERE s <> 0)"""


@query("termination_cases", f"""
WITH RECURSIVE {CASES},
j AS (SELECT o.*, n.case_id AS n_case, n.user_id AS n_user, n.event_date_key AS n_event, n.threat_date_key AS n_threat, n.save_date_key AS n_save, n.term_date_key AS n_term,
    n.save_count AS n_saves, n.term_count AS n_terms, n.completed AS n_completed,
    o.case_id IS NULL OR o.completed = 0 OR n.completed = 0 OR o.save_count <> n.save_count OR o.term_count <> n.term_count AS taken
  FROM (SELECT * FROM cr WHERE kind = 'Stored') o FULL JOIN (SELECT * FROM cr WHERE kind = 'Batch') n ON o.case_id = n.case_id)
SELECT coalesce(case_id, n_case) AS case_id, coalesce(user_id, n_user) AS user_id, CASE WHEN taken THEN n_event ELSE event_date_key END AS event_date_key,
  CASE WHEN taken THEN n_threat ELSE threat_date_key END AS threat_date_key, CASE WHEN taken THEN n_save ELSE save_date_key END AS save_date_key,
  CASE WHEN taken THEN n_term ELSE term_date_key END AS term_date_key, 1 AS threat_count, CASE WHEN taken THEN n_saves ELSE save_count END AS save_count,
  CASE WHEN taken THEN n_terms ELSE term_count END AS term_count, CASE WHEN taken THEN n_completed ELSE completed END AS completed, coalesce(kind, 'Batch') AS termination_type
FROM j""")
def termination_cases(t):
    """A user's events of a week are the actions on one case; the fact stored at the cut meets the cases as they are now."""
    action = F.create_map(*[F.lit(x) for x in ("error", "opened", "view", "saved", "signup", "lost", "click", "reopened")])[c("event_type")]
    log = t.events.select((c("user_id") * 100 + F.weekofyear("ts")).alias("case_id"), "user_id", "ts", "event_id", action.alias("action"))

    def rows(actions, kind):
        states = cases.case_states(actions, "case_id", "user_id", "ts", "event_id", "action")
        return cases.case_rows(states, "case_id", "user_id", F.lit(kind))

    return cases.load_cases(rows(log.filter(c("ts") < moment(CUT)), "Stored"), rows(log, "Batch"), "case_id")


@query("milestone_counts", """
WITH m AS (SELECT o_orderkey, 'placed' AS milestone, o_orderdate AS d FROM orders
  UNION ALL SELECT l_orderkey, 'first shipped', min(l_shipdate) FROM lineitem GROUP BY 1
  UNION ALL SELECT l_orderkey, 'last shipped', max(l_shipdate) FROM lineitem GROUP BY 1)
SELECT CAST(year(d) AS INTEGER) AS y, count(*) FILTER (milestone = 'placed') AS placed,
  count(*) FILTER (milestone = 'first shipped') AS first_shipped, count(*) FILTER (milestone = 'last shipped') AS last_shipped
FROM m GROUP BY 1""")
def milestone_counts(t):
    placed = t.orders.select(F.lit("placed").alias("milestone"), c("o_orderdate").alias("d"))
    ends = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    shipped = ends.select(F.explode(F.array(
        F.struct(F.lit("first shipped").alias("milestone"), c("a").alias("d")),
        F.struct(F.lit("last shipped").alias("milestone"), c("b").alias("d")),
    )).alias("m")).select("m.*")
    return placed.unionByName(shipped).groupBy(F.year("d").alias("y")).agg(
        F.count_if(c("milestone") == "placed").alias("placed"),
        F.count_if(c("milestone") == "first shipped").alias("first_shipped"),
        F.count_if(c("milestone") == "last shipped").alias("last_shipped"),
    )
