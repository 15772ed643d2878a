"""Upserts and dimension maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import with_row_hash
from ..operators import identity
from ..operators import project as p
from ..operators import upsert as u
from ..sources import partitioned
from .fixtures import (
    BATCH,
    HIST,
    MILESTONES,
    ORDER_CUT,
    STORED,
    TRACKED,
    batch,
    day,
    hist,
    milestones_batch,
    milestones_stored,
    moment,
    stored,
    tracked_hash,
)
from .registry import query

c = F.col


@query("classify_changes", f"""
WITH {STORED}, {BATCH} SELECT b.c_custkey, CASE WHEN s.c_custkey IS NULL THEN 'NEW'
  WHEN {tracked_hash('s')} <> {tracked_hash('b')} THEN 'MODIFIED' ELSE 'NO CHANGE' END AS change
FROM batch b LEFT JOIN stored s ON b.c_custkey = s.c_custkey""")
def classify_changes(t):
    return u.classify(with_row_hash(batch(t), TRACKED), with_row_hash(stored(t), TRACKED), ["c_custkey"]).select(
        "c_custkey", "change"
    )


@query("scd1_update", f"""
WITH {STORED}, {BATCH} SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_acctbal,
  coalesce(b.c_mktsegment, s.c_mktsegment) AS c_mktsegment FROM stored s LEFT JOIN batch b ON s.c_custkey = b.c_custkey""")
def scd1_update(t):
    return u.update_type1(stored(t), batch(t), ["c_custkey"], ["c_mktsegment"])


@query("scd1_upsert", f"""
WITH {BATCH} SELECT *, {tracked_hash()} AS row_hash FROM batch""")
def scd1_upsert(t):
    """A full batch replaces every modified row and adds the missing ones."""
    return u.upsert_type1(stored(t), batch(t), ["c_custkey"], TRACKED)


@query("late_id_mapping", """
WITH tgt AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN '[Unknown]' ELSE c_name END AS ext_id FROM customer),
map AS (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'Customer#000000001' ELSE c_name END AS ext_id FROM customer
        WHERE c_mktsegment <> 'MACHINERY'),
free AS (SELECT * FROM map WHERE ext_id NOT IN (SELECT ext_id FROM tgt)),
done AS (SELECT tgt.c_custkey, c_mktsegment, CASE WHEN tgt.ext_id = '[Unknown]' THEN coalesce(free.ext_id, tgt.ext_id)
  ELSE tgt.ext_id END AS ext_id FROM tgt LEFT JOIN free ON tgt.c_custkey = free.c_custkey)
SELECT *, sha256(concat(c_custkey, '|', c_mktsegment, '|', ext_id)) AS row_hash FROM done""")
def late_id_mapping(t):
    """Some mapped ids are in use already and stay out."""
    tgt = t.customer.select(
        "c_custkey", "c_mktsegment", F.when(c("c_acctbal") < 0, "[Unknown]").otherwise(c("c_name")).alias("ext_id")
    )
    mapping = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        "c_custkey", F.when(c("c_nationkey") < 5, "Customer#000000001").otherwise(c("c_name")).alias("ext_id")
    )
    return u.backfill_ids(tgt, mapping, "c_custkey", "ext_id", ["c_custkey", "c_mktsegment", "ext_id"])


@query("scd2_close", f"""
WITH {HIST}, changed AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-28')
SELECT user_id, start_date, event_type, row_hash,
  CASE WHEN current_record = 1 AND user_id IN (SELECT user_id FROM changed) THEN DATE '2024-02-01' ELSE end_date END AS end_date,
  CASE WHEN user_id IN (SELECT user_id FROM changed) THEN 0 ELSE current_record END AS current_record FROM hist""")
def scd2_close(t):
    changed = t.events.filter((c("event_type") == "error") & (c("ts") >= moment("2024-01-28")))
    return u.close_versions(hist(t), changed, ["user_id"], day("2024-02-01"))


def user_batch(t):
    """State of every user at the batch date: the type of the dearest event, or the market
    segment for customers who have no event."""
    best = t.events.groupBy("user_id").agg(F.max_by("event_type", F.struct("value", "event_id")).alias("event_type"))
    quiet = t.customer.select(c("c_custkey").alias("user_id"), c("c_mktsegment").alias("event_type"))
    return best.unionByName(quiet.join(best, "user_id", "left_anti"))


USER_BATCH = """
best AS (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC)
    AS rn FROM events) WHERE rn = 1),
ubatch AS (SELECT * FROM best UNION ALL SELECT c_custkey, c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM best))"""


@query("scd2_upsert", f"""
WITH {HIST}, {USER_BATCH},
lab AS (SELECT b.user_id, b.event_type, sha256(b.event_type) AS row_hash,
    CASE WHEN h.user_id IS NULL THEN 'NEW' WHEN h.row_hash <> sha256(b.event_type) THEN 'MODIFIED' ELSE 'SAME' END AS change
  FROM ubatch b LEFT JOIN (SELECT * FROM hist WHERE current_record = 1) h ON b.user_id = h.user_id),
m AS (SELECT user_id FROM lab WHERE change = 'MODIFIED')
SELECT user_id, event_type, row_hash, start_date,
  CASE WHEN current_record = 1 AND user_id IN (SELECT user_id FROM m) THEN DATE '2024-02-01' ELSE end_date END AS end_date,
  CASE WHEN user_id IN (SELECT user_id FROM m) THEN 0 ELSE current_record END AS current_record FROM hist
UNION ALL
SELECT user_id, event_type, row_hash, DATE '2024-02-01', DATE '9999-12-31', 1 FROM lab WHERE change <> 'SAME'""")
def scd2_upsert(t):
    return u.upsert_scd2(hist(t), user_batch(t), ["user_id"], ["event_type"], day("2024-02-01"))


@query("insert_if_absent", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '{ORDER_CUT}'
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '{ORDER_CUT}' AND o_orderdate >= TIMESTAMP '1997-01-01'""")
def insert_if_absent(t):
    """The batch overlaps what is stored."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    tgt = t.orders.filter(c("o_orderdate") < moment(ORDER_CUT)).select(*cols)
    src = t.orders.filter(c("o_orderdate") >= moment("1997-01-01")).select(*cols)
    return u.insert_new(tgt, src, ["o_orderkey"])


M_KEYS = ["o_orderkey", "order_date_key"]
UNSET = {"closed_date_key": -1, "done_count": 0, "cancel_count": 0, "discount_amount": None}
RESET = {"closed_date_key": -1, "done_count": 0, "cancel_count": 0, "completed": 0}


def fill_open():
    closing = (c("s_done_count") == 1) | (c("s_cancel_count") == 1)
    completed = F.when(closing, c("s_completed")).otherwise(c("completed"))
    return u.fill_rule(UNSET, c("completed") == 0, {"completed": completed})


def reopened(tgt):
    s = c("s_o_orderstatus")
    contradicted = (s == "O") | ((s == "P") & (c("done_count") == 1)) | ((s == "F") & (c("cancel_count") == 1))
    return u.reopen_rule(tgt, contradicted, RESET, c("completed") == 1)


FILLED = """SELECT g.o_orderkey, g.order_date_key,
  CASE WHEN g.completed = 0 AND g.closed_date_key = -1 THEN s.closed_date_key ELSE g.closed_date_key END AS closed_date_key,
  CASE WHEN g.completed = 0 AND g.done_count = 0 THEN s.done_count ELSE g.done_count END AS done_count,
  CASE WHEN g.completed = 0 AND g.cancel_count = 0 THEN s.cancel_count ELSE g.cancel_count END AS cancel_count,
  CASE WHEN g.completed = 0 AND g.discount_amount IS NULL THEN s.discount_amount ELSE g.discount_amount END AS discount_amount,
  CASE WHEN g.completed = 0 AND (s.done_count = 1 OR s.cancel_count = 1) THEN s.completed ELSE g.completed END AS completed
FROM {g} g JOIN m_src s USING (o_orderkey, order_date_key)"""

REOPENED = """SELECT g.o_orderkey, g.order_date_key,
  CASE WHEN back THEN -1 ELSE closed_date_key END AS closed_date_key, CASE WHEN back THEN 0 ELSE done_count END AS done_count,
  CASE WHEN back THEN 0 ELSE cancel_count END AS cancel_count, discount_amount,
  CASE WHEN back THEN 0 ELSE completed END AS completed
FROM (SELECT m.*, m.completed = 1 AND (s.o_orderstatus = 'O' OR (s.o_orderstatus = 'P' AND m.done_count = 1)
        OR (s.o_orderstatus = 'F' AND m.cancel_count = 1)) AS back
      FROM m_tgt m JOIN m_src s USING (o_orderkey, order_date_key)) g"""


@query("fill_unpopulated", f"WITH {MILESTONES} {FILLED.format(g='m_tgt')}")
def fill_unpopulated(t):
    return u.update_rows(milestones_stored(t), milestones_batch(t), M_KEYS, [fill_open()])


@query("late_measure_update", f"""
WITH {MILESTONES} SELECT m.o_orderkey, m.completed, coalesce(m.discount_amount, s.discount_amount) AS discount_amount
FROM m_tgt m JOIN m_src s USING (o_orderkey, order_date_key)""")
def late_measure_update(t):
    done = u.update_rows(milestones_stored(t), milestones_batch(t), M_KEYS, [u.late_rule("discount_amount")])
    return done.select("o_orderkey", "completed", "discount_amount")


@query("reopen_events", f"WITH {MILESTONES} {REOPENED}")
def reopen_events(t):
    tgt = milestones_stored(t)
    return u.update_rows(tgt, milestones_batch(t), M_KEYS, [reopened(tgt)])


@query("accumulating_snapshot", f"""
WITH {MILESTONES}, r AS ({REOPENED}), f AS ({FILLED.format(g='r')})
SELECT f.o_orderkey, f.order_date_key, f.closed_date_key, f.done_count, f.cancel_count,
  coalesce(f.discount_amount, s.discount_amount) AS discount_amount, f.completed
FROM f JOIN m_src s USING (o_orderkey, order_date_key)
UNION ALL SELECT o_orderkey, order_date_key, closed_date_key, done_count, cancel_count, discount_amount, completed FROM m_src
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM m_tgt)""")
def accumulating_snapshot(t):
    """Reopen contradicted rows, fill open ones, take late measures, insert new events."""
    tgt = milestones_stored(t)
    rules = [reopened(tgt), fill_open(), u.late_rule("discount_amount")]
    return u.accumulate(tgt, milestones_batch(t), M_KEYS, rules)


@query("unknown_member", """
SELECT * FROM supplier UNION ALL SELECT -1, '[Unknown]', -1, NULL""")
def unknown_member(t):
    once = u.with_unknown(t.supplier, "s_suppkey", {"s_name": "[Unknown]", "s_nationkey": -1})
    return u.with_unknown(once, "s_suppkey", {"s_name": "[Unknown]", "s_nationkey": -1})


@query("surrogate_keys", """
WITH old AS (SELECT c_custkey + 100 AS contact_key, c_custkey, c_name FROM customer WHERE c_acctbal >= 0)
SELECT * FROM old UNION ALL SELECT (SELECT max(contact_key) FROM old) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name
FROM customer WHERE c_acctbal < 0""")
def surrogate_keys(t):
    tgt = stored(t).select((c("c_custkey") + 100).alias("contact_key"), "c_custkey", "c_name")
    new = t.customer.filter("c_acctbal < 0").select("c_custkey", "c_name")
    return u.assign_keys(tgt, new, "contact_key", ["c_custkey"], stage=lambda df: t.stage(df, "new_contacts"))


@query("repair_duplicates", f"""
WITH {HIST}, twin AS (SELECT c_custkey AS user_id FROM customer WHERE c_nationkey < 5),
fixed AS (SELECT user_id, start_date, CASE WHEN start_date >= DATE '2024-01-15' THEN nullif(event_type, 'view')
    ELSE event_type END AS event_type, row_hash FROM hist WHERE user_id IN (SELECT user_id FROM twin))
SELECT user_id, start_date, coalesce(event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY start_date)) AS event_type,
  row_hash, lead(start_date, 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY start_date) AS end_date,
  CASE WHEN lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) IS NULL THEN 1 ELSE 0 END AS current_record FROM fixed
UNION ALL SELECT user_id, start_date, event_type, row_hash, end_date, current_record FROM hist
WHERE user_id NOT IN (SELECT user_id FROM twin)""")
def repair_duplicates(t):
    """Users of some nations live under a second id since mid-January, where views were lost and
    the last version before the change still claims to be current."""
    offset = 1_000_000_000_000
    twin = t.customer.filter("c_nationkey < 5").select(c("c_custkey").alias("user_id"), F.lit(1).alias("twin"))
    rows = hist(t).join(twin, "user_id", "left")
    later = (c("twin") == 1) & (c("start_date") >= day("2024-01-15"))
    seam = (c("twin") == 1) & (c("start_date") < day("2024-01-15")) & (c("end_date") >= day("2024-01-15"))
    broken = rows.select(
        F.when(later, c("user_id") + offset).otherwise(c("user_id")).alias("user_id"), "start_date",
        F.when(later, F.nullif("event_type", F.lit("view"))).otherwise(c("event_type")).alias("event_type"), "row_hash",
        F.when(seam, day("9999-12-31")).otherwise(c("end_date")).alias("end_date"),
        F.when(seam, 1).otherwise(c("current_record")).alias("current_record"),
    )
    pairs = twin.select((c("user_id") + offset).alias("user_id"), c("user_id").alias("master"))
    return u.repair_scd2(broken, pairs, "user_id", "master", "event_type", ["row_hash"], split=False)


@query("bridge_from_columns", """
WITH labels AS (SELECT p_partkey, p_brand AS label FROM part UNION SELECT p_partkey, p_type FROM part),
dim AS (SELECT DISTINCT label, CAST(ascii(label) * 1000 + length(label) * 10 + ascii(right(label, 1)) AS INTEGER) AS label_key FROM labels
        WHERE label <> 'PROMO')
SELECT DISTINCT p_partkey, coalesce(label_key, -1) AS label_key FROM labels LEFT JOIN dim USING (label)""")
def bridge_from_columns(t):
    """Brand and type labels of a part; the label PROMO is not in the dimension."""
    labels = p.unpivot_columns(t.part, ["p_partkey"], ["p_brand", "p_type"], value="label")
    key = F.ascii("label") * 1000 + F.length("label") * 10 + F.ascii(F.right("label", F.lit(1)))
    dim = labels.filter("label <> 'PROMO'").select("label", key.alias("label_key")).distinct()
    return u.bridge(labels, dim, "p_partkey", "label", "label_key", "label")


@query("backfill_or_increment", f"""
SELECT o_orderkey, o_totalprice, 'empty target' AS run FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, 'stored target' FROM orders
WHERE o_orderdate < TIMESTAMP '{ORDER_CUT}' OR o_orderpriority = '1-URGENT'""")
def backfill_or_increment(t):
    """An empty target takes everything; a stored one gets what is new among urgent orders."""
    cols = ["o_orderkey", "o_totalprice"]
    full = t.orders.select(*cols)
    known = t.orders.filter(c("o_orderdate") < moment(ORDER_CUT)).select(*cols)
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(*cols)

    def run(tgt, name):
        done = u.load(tgt, lambda: full, lambda x: u.insert_new(x, urgent, ["o_orderkey"]))
        return done.withColumn("run", F.lit(name))

    return run(full.filter("false"), "empty target").unionByName(run(known, "stored target"))


@query("partition_upsert", f"""
WITH s AS (SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month FROM orders
    WHERE o_orderkey % 5 <> 0 OR o_orderdate < TIMESTAMP '{ORDER_CUT}'),
b AS (SELECT o_orderkey, o_totalprice * 2 AS p, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month FROM orders
    WHERE o_orderdate >= TIMESTAMP '{ORDER_CUT}' AND o_orderstatus = 'O')
SELECT coalesce(s.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(p, o_totalprice) AS o_totalprice, coalesce(o_orderstatus, 'N') AS o_orderstatus,
  coalesce(s.month, b.month) AS month FROM s FULL JOIN b ON s.o_orderkey = b.o_orderkey""")
def partition_upsert(t):
    """Orders stored by month; a batch of recent open orders rewrites the months it touches and no others."""
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month")
    rows = t.orders.filter((c("o_orderkey") % 5 != 0) | (c("o_orderdate") < moment(ORDER_CUT)))
    path = f"{t.scratch()}/orders"
    partitioned.create(rows.select("o_orderkey", "o_totalprice", "o_orderstatus", month), path, "month")
    batch = t.orders.filter((c("o_orderdate") >= moment(ORDER_CUT)) & (c("o_orderstatus") == "O")).select(
        "o_orderkey", (c("o_totalprice") * 2).alias("o_totalprice"), F.lit("N").alias("o_orderstatus"), month
    )
    partitioned.rewrite_partitions(
        t.spark, path, "month", batch, c("month"), lambda stored, new: u.accumulate(stored, new, ["o_orderkey"], [{"o_totalprice": c("s_o_totalprice")}])
    )
    return t.spark.read.parquet(path)


@query("repair_id_chains", """
SELECT o_custkey - o_custkey % 4 AS customer, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY 1""")
def repair_id_chains(t):
    """Customers that each name their predecessor, four to a chain; their orders are counted under the chain's smallest id."""
    links = t.customer.filter(c("c_custkey") % 4 != 0).select("c_custkey", (c("c_custkey") - 1).alias("before"))
    names = identity.resolve_ids(links, "c_custkey", "before", lambda df: t.stage(df, "links"))
    orders = identity.repoint(t.orders.select("o_custkey", "o_totalprice"), names, "o_custkey")
    total = F.sum(c("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total")
    return orders.groupBy(c("o_custkey").alias("customer")).agg(F.count(F.lit(1)).alias("n_orders"), total)
