"""The person chain, tenure and age bands on orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import age_years
from ..plans import people as p
from ..sources.lake import literal_rows
from .fixtures import day
from .registry import query
from .temporal import SLICES

c = F.col


def chain_tables(t, base: str):
    """Assignments of customers, members, employees, managers and peer groups; ``base`` is the day around which everyone moves.

    Customers move five nations on, the smallest supplier of a nation is its member, employees return a year and more before, managers change after."""
    long_ago, far, at = day("1900-01-01"), day("9999-12-31"), day(base)
    moved = F.explode(F.array(
        F.struct(c("c_nationkey").alias("owner"), long_ago.alias("from_date"), at.alias("to_date")),
        F.struct(((c("c_nationkey") + 5) % 25).alias("owner"), at.alias("from_date"), far.alias("to_date")),
    ))
    assignments = t.customer.select(c("c_custkey").alias("customer"), moved.alias("v")).select("customer", "v.*")
    members = t.supplier.groupBy(c("s_nationkey").alias("owner")).agg(F.min("s_suppkey").cast("int").alias("member_key")).select(
        "owner", "member_key", long_ago.alias("from_date"), far.alias("to_date")
    )
    key = c("s_suppkey").cast("int")
    employees = t.supplier.select(
        key.alias("member_key"), key.alias("employee_key"), (key % 3).alias("specialty"), F.date_add(F.date_sub(at, 1096), c("s_nationkey") * 30).alias("first_start"),
        F.date_add(F.date_sub(at, 396), c("s_nationkey") * 30).alias("last_start"), F.when(c("s_acctbal") < 2000, F.date_add(at, 365)).alias("left_on"),
    )
    handed = F.date_add(at, c("s_nationkey") * 10)
    managers = t.supplier.select(key.alias("employee_key"), F.explode(F.array(
        F.struct((key % 7).alias("manager_key"), long_ago.alias("from_date"), handed.alias("to_date")),
        F.struct((key % 7 + 1).alias("manager_key"), handed.alias("from_date"), far.alias("to_date")),
    )).alias("v")).select("employee_key", "v.*")
    groups = literal_rows(
        t.spark, [(s, lo, hi, s * 10 + i) for s in range(3) for i, (lo, hi) in enumerate([(0, 12), (12, 36), (36, None)], 1)],
        "specialty int, lo int, hi int, peer_group_key int",
    )
    return assignments, members, employees, managers, groups


def people_behind(t, entity: str, base: str, lag_days: int = 30) -> p.People:
    """The people behind customers, under the fact's name of a customer."""
    assignments, members, employees, managers, groups = chain_tables(t, base)
    history = p.person_history(entity, assignments.withColumnRenamed("customer", entity), members, employees, managers)
    births = t.customer.select(c("c_custkey").alias(entity), F.date_add(day("1950-01-01"), (c("c_custkey") % 50 * 365).cast("int")).alias("born"))
    bands = literal_rows(t.spark, [(1, 0, 40), (2, 40, 60)], "band_key int, lo int, hi int")
    return p.People(history, groups, births, bands, lag_days)


def people_sql(rows: str, entity: str, at: str, base: str, lag_days: int = 30) -> str:
    """CTE ``ppl``: the keys of the people behind the distinct (pe, pa) of ``rows``."""
    return f"""
asked AS (SELECT DISTINCT {entity} AS pe, {at} AS pa, CAST({at} - {lag_days} AS DATE) AS pd FROM {rows} WHERE {at} IS NOT NULL),
moved AS (SELECT c_custkey, c_nationkey AS own, DATE '1900-01-01' AS m0, DATE '{base}' AS m1 FROM customer
  UNION ALL SELECT c_custkey, (c_nationkey + 5) % 25, DATE '{base}', DATE '9999-12-31' FROM customer),
team AS (SELECT s_nationkey AS own, CAST(min(s_suppkey) AS INTEGER) AS member_key FROM supplier GROUP BY 1),
staff AS (SELECT CAST(s_suppkey AS INTEGER) AS employee_key, CAST(s_suppkey % 3 AS INTEGER) AS specialty, CAST(DATE '{base}' - 1096 + s_nationkey * 30 AS DATE) AS fs,
    CAST(DATE '{base}' - 396 + s_nationkey * 30 AS DATE) AS ls, CASE WHEN s_acctbal < 2000 THEN CAST(DATE '{base}' + 365 AS DATE) ELSE DATE '9999-12-31' END AS lo,
    CAST(DATE '{base}' + s_nationkey * 10 AS DATE) AS handed FROM supplier),
ppl0 AS (SELECT pe, pa, pd, member_key, staff.*, CASE WHEN pd < ls THEN fs ELSE ls END AS began,
    floor(date_diff('day', CAST(DATE '1950-01-01' + CAST(cu.c_custkey % 50 * 365 AS INTEGER) AS DATE), pa) / 365.25) AS age
  FROM asked LEFT JOIN moved ON pe = moved.c_custkey AND m0 <= pd AND pd < m1 LEFT JOIN team ON moved.own = team.own
  LEFT JOIN staff ON member_key = employee_key AND CASE WHEN pd < ls THEN fs ELSE ls END <= pd AND lo >= pd LEFT JOIN customer cu ON pe = cu.c_custkey),
ppl1 AS (SELECT *, CAST(greatest((year(pd) - year(began)) * 12 + month(pd) - month(began), 0) AS INTEGER) AS months FROM ppl0),
ppl AS (SELECT pe, pa, coalesce(member_key, -1) AS member_key, coalesce(employee_key, -1) AS employee_key,
    CAST(coalesce(CASE WHEN pd < handed THEN employee_key % 7 ELSE employee_key % 7 + 1 END, -1) AS INTEGER) AS manager_key,
    CAST(coalesce(specialty * 10 + CASE WHEN months < 12 THEN 1 WHEN months < 36 THEN 2 ELSE 3 END, -1) AS INTEGER) AS peer_group_key,
    CASE WHEN employee_key IS NOT NULL THEN months END AS tenure_months, CASE WHEN age < 0 THEN -1 WHEN age < 40 THEN 1 WHEN age < 60 THEN 2 ELSE -1 END AS age_band_key FROM ppl1)"""


PEOPLE_COLUMNS = ", ".join(f"ppl.{k}" for k in p.PEOPLE_KEYS)


@query("fact_person_keys", f"""
WITH {SLICES},
member AS (SELECT s_nationkey AS owner, CAST(min(s_suppkey) AS INTEGER) AS member_key FROM supplier GROUP BY 1),
emp AS (SELECT CAST(s_suppkey AS INTEGER) AS employee_key, CAST(s_suppkey % 3 AS INTEGER) AS specialty, CAST(DATE '1995-01-01' + s_nationkey * 30 AS DATE) AS fs,
    CAST(DATE '1996-12-01' + s_nationkey * 30 AS DATE) AS ls, CASE WHEN s_acctbal < 2000 THEN DATE '1999-01-01' ELSE DATE '9999-12-31' END AS lo,
    CAST(DATE '1998-01-01' + s_nationkey * 10 AS DATE) AS handed FROM supplier),
o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS on_, CAST(o_orderdate AS DATE) - 30 AS d FROM orders),
e AS (SELECT o.*, member_key, emp.*, CASE WHEN d < ls THEN fs ELSE ls END AS began FROM o LEFT JOIN cust ON o_custkey = c_custkey AND cs <= d AND d < ce
  LEFT JOIN member ON nation = owner
  LEFT JOIN emp ON member_key = employee_key AND CASE WHEN d < ls THEN fs ELSE ls END <= d AND lo >= d),
t AS (SELECT *, CAST(greatest((year(d) - year(began)) * 12 + month(d) - month(began), 0) AS INTEGER) AS months FROM e)
SELECT o_orderkey, coalesce(member_key, -1) AS member_key, coalesce(employee_key, -1) AS employee_key,
  coalesce(CASE WHEN d < handed THEN employee_key % 7 ELSE employee_key % 7 + 1 END, -1) AS manager_key,
  coalesce(specialty * 10 + CASE WHEN months < 12 THEN 1 WHEN months < 36 THEN 2 ELSE 3 END, -1) AS peer_group_key,
  CASE WHEN employee_key IS NOT NULL THEN months END AS tenure_months,
  CASE WHEN floor(date_diff('day', DATE '1990-06-15', on_) / 365.25) < 6 THEN 1 WHEN floor(date_diff('day', DATE '1990-06-15', on_) / 365.25) < 9 THEN 2 ELSE -1 END
    AS age_band_key
FROM t""")
def fact_person_keys(t):
    """Orders with the people responsible 30 days before; a customer's age is counted from one day."""
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("on"))
    assignments, members, employees, managers, groups = chain_tables(t, "1998-01-01")
    assignments = assignments.withColumnRenamed("customer", "o_custkey")
    rows = p.person_keys(orders, "on", "o_custkey", assignments, members, employees, managers, groups, lag_days=30)
    ages = literal_rows(t.spark, [(1, 0, 6), (2, 6, 9)], "band_key int, lo int, hi int")
    return p.with_age_band(rows, ages, age_years(day("1990-06-15"), c("on")), "age_band_key").drop("on", "o_custkey")


@query("person_history", """
WITH moved AS (SELECT c_custkey, c_nationkey AS own, DATE '1900-01-01' AS m0, DATE '1998-01-01' AS m1 FROM customer
  UNION ALL SELECT c_custkey, (c_nationkey + 5) % 25, DATE '1998-01-01', DATE '9999-12-31' FROM customer),
team AS (SELECT s_nationkey AS own, CAST(min(s_suppkey) AS INTEGER) AS member_key FROM supplier GROUP BY 1),
e AS (SELECT CAST(s_suppkey AS INTEGER) AS k, CAST(s_suppkey % 3 AS INTEGER) AS specialty, CAST(DATE '1995-01-01' + s_nationkey * 30 AS DATE) AS fs,
    CAST(DATE '1996-12-01' + s_nationkey * 30 AS DATE) AS ls, CASE WHEN s_acctbal < 2000 THEN DATE '1999-01-02' ELSE DATE '9999-12-31' END AS gone,
    CAST(DATE '1998-01-01' + s_nationkey * 10 AS DATE) AS handed FROM supplier),
m AS (SELECT c_custkey AS customer, moved.own AS owner, member_key, m0, m1 FROM moved LEFT JOIN team ON moved.own = team.own),
cuts AS (SELECT customer, owner, m0, m0 AS d FROM m UNION SELECT customer, owner, m0, unnest([fs, ls, gone, handed]) FROM m JOIN e ON member_key = k),
inside AS (SELECT cuts.*, m.member_key, m.m1 FROM cuts JOIN m ON m.customer = cuts.customer AND m.m0 = cuts.m0 WHERE d >= m.m0 AND d < m.m1),
seg AS (SELECT *, lead(d, 1, m1) OVER (PARTITION BY customer, m0 ORDER BY d) AS nxt FROM inside)
SELECT customer, owner, d AS from_date, nxt AS to_date, member_key, k AS employee_key, specialty, CASE WHEN d < ls THEN fs ELSE ls END AS began,
  CASE WHEN d < handed THEN k % 7 ELSE k % 7 + 1 END AS manager_key
FROM seg LEFT JOIN e ON member_key = k AND fs <= d AND d < gone
WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.k = member_key AND d = x.handed AND NOT (x.fs <= d AND d < x.gone) AND d <> m0)""")
def person_history(t):
    """The chain from customers to their managers as one flat history."""
    assignments, members, employees, managers, _ = chain_tables(t, "1998-01-01")
    return p.person_history("customer", assignments, members, employees, managers)
