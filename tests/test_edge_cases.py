"""Ties, NULLs, boundaries, empty input, calendars."""

import datetime as dt

import pytest
from helpers import rows, same
from pyspark.sql import functions as F

from strataledger.defaults import MAX_DATE, Defaults
from strataledger.functions import dates, numbers, text
from strataledger.functions.hashing import joined_text, with_row_hash
from strataledger.operators import asof, bands, checks, filters, history, joins, pairing, project, upsert
from strataledger.operators.temporal import eligible_at, temporal_join
from strataledger.sources import incremental, lake

D = dt.date
T = dt.datetime
AUDIT = "log_id bigint, entity string, ts timestamp_ntz, state string, paid double"


def audit(spark, data):
    return spark.createDataFrame(data, AUDIT)


def build(df, **kw):
    return history.build_scd2(df, "entity", "ts", "log_id", ["state", "paid"], sparse=["paid"], **kw)


def test_scd2_ties_fill_and_return_to_an_old_value(spark):
    log = audit(spark, [
        (1, "a", T(2024, 1, 1, 9), "x", None),      # NULL first
        (2, "a", T(2024, 1, 1, 9), "y", None),      # same moment: larger log id wins
        (3, "a", T(2024, 1, 2, 9), "y", 5.0),
        (4, "a", T(2024, 1, 3, 9), "y", None),      # filled: no change
        (5, "a", T(2024, 1, 4, 9), "x", None),
        (6, "a", T(2024, 1, 5, 9), "y", None),      # back to an old value: a version again
    ])
    got = [tuple(r) for r in build(log).select("start_date", "end_date", "state", "paid", "current_record").orderBy("start_date").collect()]
    assert got == [
        (D(2024, 1, 1), D(2024, 1, 2), "y", None, 0),
        (D(2024, 1, 2), D(2024, 1, 4), "y", 5.0, 0),
        (D(2024, 1, 4), D(2024, 1, 5), "x", 5.0, 0),
        (D(2024, 1, 5), D(9999, 12, 31), "y", 5.0, 1),
    ]


def test_scd2_empty_single_and_null_key(spark):
    assert build(audit(spark, [])).count() == 0
    one = build(audit(spark, [(1, "a", T(2024, 1, 1), "x", None)])).collect()
    assert len(one) == 1 and one[0]["current_record"] == 1
    null = build(audit(spark, [(1, None, T(2024, 1, 1), "x", None), (2, None, T(2024, 1, 2), "y", None)]))
    assert null.count() == 2


def test_null_in_hash_keeps_the_separator(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    got = [r[0] for r in df.select(joined_text([F.col("x"), F.col("y")])).collect()]
    assert got == ["a|", "|a", "a|"]
    assert with_row_hash(df, ["x", "y"]).select("row_hash").distinct().count() == 2


def test_forward_fill_with_ties_sees_both_values(spark):
    df = spark.createDataFrame([("e", 1, "A", None), ("e", 1, None, "F"), ("e", 2, None, None)], "k string, t int, a string, b string")
    out = history.merge_timelines([df], "k", "t", ["a", "b"])
    assert rows(out) == {("e", 1, "A", "F"): 1, ("e", 2, "A", "F"): 1}


HIST = [("a", "one", D(2024, 1, 1), D(2024, 1, 10)), ("a", "two", D(2024, 1, 10), None)]


def test_temporal_boundaries(spark):
    hist = spark.createDataFrame(HIST, "k string, v string, start_date date, end_date date")
    fact = spark.createDataFrame(
        [(1, "a", D(2024, 1, 1)), (2, "a", D(2024, 1, 10)), (3, "a", D(2023, 12, 31)), (4, None, D(2024, 1, 5)), (5, "a", D(9999, 12, 30))],
        "id int, k string, at date",
    )
    left = temporal_join(fact, hist, ["k"], "at", how="left")
    assert rows(left, "id", "v") == {(1, "one"): 1, (2, "two"): 1, (3, None): 1, (4, None): 1, (5, "two"): 1}
    both = temporal_join(fact, hist, ["k"], "at", closed="both")
    assert rows(both, "id", "v") == {(1, "one"): 1, (2, "one"): 1, (2, "two"): 1, (5, "two"): 1}


def test_eligibility_of_a_returner(spark):
    people = spark.createDataFrame(
        [("p", 7, D(2010, 1, 1), D(2020, 1, 1), D(2022, 1, 1))], "who string, id int, first_start date, last_start date, left_on date"
    )
    refs = spark.createDataFrame([(d, "p") for d in (D(2009, 1, 1), D(2015, 1, 1), D(2021, 1, 1), D(2022, 1, 1), D(2022, 1, 2))], "at date, who string")
    got = eligible_at(refs, people, "who", "at", "first_start", "last_start", "left_on")
    assert sorted(r["at"] for r in got.collect()) == [D(2015, 1, 1), D(2021, 1, 1), D(2022, 1, 1)]


def test_calendar_functions(spark):
    df = spark.createDataFrame([(D(2024, 2, 29), D(2024, 1, 31), D(2024, 2, 1))], "leap date, a date, b date")
    got = df.select(
        F.add_months("leap", 12), dates.months_crossed(F.col("a"), F.col("b")), dates.months_crossed(F.col("b"), F.col("a")),
        dates.tenure_months(F.col("b"), F.col("a")), dates.days_between(F.col("a"), F.col("b")), dates.date_key(F.col("leap")),
        dates.key_date(F.lit(20240229)), dates.age_years(F.lit("2000-01-01").cast("date"), F.lit("2001-01-01").cast("date")),
    ).first()
    assert tuple(got) == (D(2025, 2, 28), 1, -1, 0, 1, 20240229, D(2024, 2, 29), 1)


def test_local_day_over_daylight_saving(spark):
    df = spark.createDataFrame([(T(2024, 3, 10, 7, 59),), (T(2024, 3, 10, 8, 1),), (T(2024, 3, 11, 6, 59),), (T(2024, 3, 11, 7, 1),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(dates.local_date(F.col("ts"))).collect()]
    assert got == [D(2024, 3, 9), D(2024, 3, 10), D(2024, 3, 10), D(2024, 3, 11)]


def test_text_and_numbers(spark):
    df = spark.createDataFrame([("A-b-c", "x1", "2024-02-30"), ("none", "12", "2024-02-29")], "a string, b string, c string")
    got = df.select(
        text.after_first(F.col("a"), "-"), text.before_first(F.col("a"), "-"), numbers.try_int(F.col("b")),
        numbers.is_numeric(F.col("b")), numbers.is_date(F.col("c")),
    ).collect()
    assert [tuple(r) for r in got] == [("b-c", "A", None, 0, 0), ("none", "none", 12, 1, 1)]
    assert spark.range(1).select(text.label_key(F.lit("Ab  ")), text.zero_padded(F.lit(3), 2)).first() == ("ab", "03")


def test_filters_and_unknown(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, s string")
    assert rows(filters.delete_where(df, F.col("s") == "x"), "id") == {(2,): 1, (3,): 1}
    assert rows(df.filter(filters.keep_unknown(F.col("s") != "x")), "id") == {(2,): 1, (3,): 1}
    fixed = project.replace_if_match(df, spark.createDataFrame([(3, None)], "id int, s string"), ["id"], ["s"])
    assert rows(fixed) == {(1, "x"): 1, (2, None): 1, (3, None): 1}


def test_asof_tie_and_tolerance(spark):
    left = spark.createDataFrame([(1, "k", D(2024, 1, 10)), (2, "k", D(2024, 3, 1)), (3, None, D(2024, 1, 1))], "id int, k string, at date")
    right = spark.createDataFrame([("k", D(2024, 1, 10), 1, "a"), ("k", D(2024, 1, 10), 2, "b"), ("k", D(2024, 1, 2), 3, "c")], "k string, d date, n int, v string")
    on = asof.asof_latest(left, right, ["k"], "at", "d", {"v": "v"}, tie="n", max_age_days=30)
    assert rows(on, "id", "v") == {(1, "b"): 1, (2, None): 1, (3, None): 1}
    before = asof.asof_latest(left, right, ["k"], "at", "d", {"v": "v"}, strict=True, tie="n")
    assert rows(before, "id", "v") == {(1, "c"): 1, (2, "b"): 1, (3, None): 1}


def test_prior_within_months_ties_by_id(spark):
    df = spark.createDataFrame([(1, "c", D(2023, 1, 1)), (2, "c", D(2023, 1, 1)), (3, "c", D(2024, 1, 1)), (4, "c", D(2025, 2, 1))], "id int, k string, at date")
    got = asof.prior_within_months(df, ["k"], "at", "id", 12)
    assert rows(got, "id", "has_prior") == {(1, 0): 1, (2, 1): 1, (3, 1): 1, (4, 0): 1}


def test_pairs_at_once_and_in_sequence(spark):
    data = [(1, "a", D(2024, 1, 1), 1, 1), (2, "a", D(2024, 1, 2), 0, 1), (3, "a", D(2024, 1, 3), 1, 0), (4, "a", D(2024, 1, 4), 0, 1), (5, "a", D(2024, 1, 5), 1, 0)]
    df = spark.createDataFrame(data, "id int, k string, at date, o int, c int")
    seq = pairing.sequence_events(df, "k", "at", "id", F.col("o") == 1, F.col("c") == 1)
    assert rows(pairing.pair_events(seq, "at"), "id", "completed", "close_at") == {
        (1, 1, D(2024, 1, 1)): 1, (3, 1, D(2024, 1, 4)): 1, (5, 0, None): 1
    }
    # the event that closed itself leaves nothing open for the closer after it
    assert rows(pairing.unmatched_closers(seq), "id") == {(2,): 1}


def test_crosswalk_keeps_preferred_of_doubles(spark):
    a = spark.createDataFrame([(1, 10, 1), (2, 11, 0), (3, 12, 0)], "ia int, k int, ga int")
    b = spark.createDataFrame([("x", 10, 0), ("y", 10, 1), ("z", 11, 0)], "ib string, k int, gb int")
    assert rows(joins.crosswalk(a, b, "k", "ia", "ib", "ga", "gb")) == {(1, "x"): 1, (1, "y"): 1, (2, "z"): 1}
    a0 = a.withColumn("ga", F.lit(0))
    assert rows(joins.crosswalk(a0, b, "k", "ia", "ib", "ga", "gb")) == {(2, "z"): 1}


def test_bands(spark):
    edges = [(i, i * 3, i * 3 + 3) for i in range(40)] + [(99, 120, None)]
    table = spark.createDataFrame(edges, "band int, lo int, hi int")
    values = spark.range(-5, 400).select(F.col("id").cast("int").alias("v"))
    got = bands.band_lookup(values, table, "v")
    want = {(v, None if v < 0 else 99 if v >= 120 else v // 3): 1 for v in range(-5, 400)}
    assert rows(got, "v", "band") == want


def test_upsert_handles_null_keys(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c"), (None, "x"), (None, "y")], "id int, v string")
    got = upsert.upsert_type1(tgt, src, ["id"], ["v"])
    assert rows(got, "id", "v") == {(1, "a"): 1, (2, "B"): 1, (3, "c"): 1, (None, "n"): 1, (None, "x"): 1, (None, "y"): 1}


@pytest.mark.parametrize("how", ["update", "type1", "accumulate", "insert", "scd2"])
def test_a_key_that_comes_twice_is_an_error_or_reduced(spark, how):
    from pyspark.errors import PySparkException

    tgt = with_row_hash(spark.createDataFrame([(1, "a")], "id int, v string"), ["v"])
    tgt = tgt.withColumns({"start_date": F.lit("2020-01-01").cast("date"), "end_date": F.lit(MAX_DATE).cast("date"), "current_record": F.lit(1)})
    src = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "id int, v string, n int")
    if how in ("update", "type1"):
        src = src.withColumn("id", F.lit(1))
    day = F.lit("2024-01-01").cast("date")
    do = {
        "update": lambda s, **k: upsert.update_rows(tgt, s, ["id"], [{"v": F.col("s_v")}], **k),
        "type1": lambda s, **k: upsert.upsert_type1(tgt.select("id", "v"), s, ["id"], ["v"], **k),
        "accumulate": lambda s, **k: upsert.accumulate(tgt.select("id", "v"), s, ["id"], [], **k),
        "insert": lambda s: upsert.insert_new(tgt.select("id", "v"), s, ["id"]),
        "scd2": lambda s, **k: upsert.upsert_scd2(tgt, s, ["id"], ["v"], day, **k),
    }[how]
    with pytest.raises(PySparkException):
        do(src).collect()
    if how != "insert":
        order = ["n"] if how == "scd2" else [F.desc("n")]
        assert "y" in {r["v"] for r in do(src, newest_first=order).collect()} or how == "scd2"


def test_scd2_keeps_all_rows_and_columns(spark):
    """NULL flags, a surrogate key, audit columns and type-1 columns."""
    schema = "sk int, id int, v string, start_date date, end_date date, current_record int, phone string, loaded string"
    d, far = dt.date(2020, 1, 1), dt.date(9999, 12, 31)
    tgt = with_row_hash(spark.createDataFrame([
        (1, 1, "a", d, dt.date(2021, 1, 1), 0, "p0", "run0"), (2, 1, "b", dt.date(2021, 1, 1), far, 1, "p1", "run1"),
        (3, 2, "c", d, far, 1, "p2", "run1"), (4, 3, "d", d, far, None, "p3", "run1"), (5, 4, "e", d, far, 1, "p4", "run1"),
    ], schema), ["v"])
    src = spark.createDataFrame([(1, "B", "q1", "run2"), (2, "c", "q2", "run2"), (9, "n", "q9", "run2")], "id int, v string, phone string, loaded string")
    got = upsert.upsert_scd2(tgt, src, ["id"], ["v"], F.lit("2024-01-01").cast("date"), type1=["phone"], key="sk")
    assert got.columns == tgt.columns
    day = dt.date(2024, 1, 1)
    assert rows(got, "sk", "id", "v", "start_date", "end_date", "current_record", "phone", "loaded") == dict.fromkeys([
        (1, 1, "a", d, dt.date(2021, 1, 1), 0, "p0", "run0"), (2, 1, "b", dt.date(2021, 1, 1), day, 0, "q1", "run1"),
        (6, 1, "B", day, far, 1, "q1", "run2"), (3, 2, "c", d, far, 1, "q2", "run1"), (4, 3, "d", d, far, None, "p3", "run1"),
        (5, 4, "e", d, far, 1, "p4", "run1"), (7, 9, "n", day, far, 1, "q9", "run2"),
    ], 1)


def test_hash_tells_small_differences(spark):
    rows_ = spark.sql("""SELECT * FROM VALUES (1, 1.001D, TIMESTAMP'2024-01-01 00:00:00.1', 'a|b', 'c'), (2, 1.004D, TIMESTAMP'2024-01-01 00:00:00.1', 'a|b', 'c'),
        (3, 1.001D, TIMESTAMP'2024-01-01 00:00:00.2', 'a|b', 'c'), (4, 1.001D, TIMESTAMP'2024-01-01 00:00:00.1', 'a', 'b|c'),
        (5, CAST('NaN' AS DOUBLE), NULL, NULL, NULL), (6, NULL, NULL, NULL, NULL) AS t(id, x, at, p, q)""")
    hashed = with_row_hash(rows_, ["x", "at", "p", "q"])
    assert hashed.select("row_hash").distinct().count() == 6
    old = with_row_hash(rows_.filter("id < 3"), ["x", "at"], money=True)
    assert old.select("row_hash").distinct().count() == 1


def test_update_needs_one_row_per_key(spark):
    src = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], "id int, v string, n int")
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = upsert.unique_batch(src, ["id"], [F.desc("n")])
    assert rows(upsert.update_type1(tgt, batch, ["id"], ["v"])) == {(1, "new"): 1, (2, "x"): 1}


def test_late_ids_and_unknown_member(spark):
    dim = spark.createDataFrame([(1, "a"), (2, None)], "k int, name string")
    once = upsert.with_unknown(dim, "k", {"name": "[Unknown]"})
    same(once, upsert.with_unknown(once, "k", {"name": "other"}))
    assert rows(once)[(-1, "[Unknown]")] == 1


def test_load_branches(spark):
    tgt = spark.createDataFrame([], "id int")
    full = spark.createDataFrame([(1,)], "id int")
    assert upsert.load(tgt, lambda: full, lambda x: x).count() == 1
    assert upsert.load(full, lambda: tgt, lambda x: x.unionByName(full)).count() == 2


def test_incremental_floor_and_late(spark):
    src = spark.createDataFrame([(1, T(1950, 1, 1)), (2, T(2024, 1, 1)), (3, T(2024, 1, 2, 12))], "id int, ts timestamp_ntz")
    empty = src.filter("false")
    assert incremental.incremental(src, empty, "ts", floor="1990-01-01").count() == 2
    tgt = src.filter("id = 3")
    batch = incremental.incremental(src, tgt, "ts")
    assert rows(batch, "id") == {(3,): 1}
    assert rows(incremental.late_arrivals(src, batch, tgt, ["id"]), "id") == {(1,): 1, (2,): 1}


def test_defaults_table(spark):
    table = spark.createDataFrame([("unknown_number", "-7"), ("unknown_text", "?"), ("other", "z")], "name string, value string")
    found = Defaults.from_table(table)
    assert (found.unknown_number, found.unknown_text, found.max_date) == (-7, "?", "9999-12-31")


def test_files_and_tables(spark, tmp_path):
    log = spark.createDataFrame([("m", "f1")], "member string, file_name string")
    entries = spark.createDataFrame([("m", "f1"), ("m", "f2"), ("m", "f2")], "member string, file_name string")
    assert rows(lake.register_file(log, entries, ["member", "file_name"], ["file_name"])) == {("m", "f1"): 1, ("m", "f2"): 1}
    path = str(tmp_path / "t")
    out = lake.write_table(spark.range(5), path)
    with pytest.raises(ValueError):
        lake.write_table(out.filter("id > 1"), path)
    lake.append_table(spark.range(5, 7), path)
    assert out.count() == 5 and spark.read.parquet(path).count() == 7
    parts = lake.parse_lake_path(F.col("p"))
    got = spark.createDataFrame([("lake/a/2024/01/05/f.parquet",)], "p string").select(*[c.alias(n) for n, c in parts.items()]).first()
    assert tuple(got) == ("lake/a", "2024/01/05", "f.parquet")


def test_write_logged(spark, tmp_path):
    log = lake.write_logged(spark.range(9), str(tmp_path / "t"), "range", "run-9")
    assert (log["n_rows"], log["status"], log["run_id"]) == (9, "Succeeded", "run-9") and log["seconds"] >= 0


def test_null_safe_reconciliation(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    b = spark.createDataFrame([(1, None), (2, None)], "id int, v string")
    assert checks.mismatch_counts(a, b, ["id"], ["v"]).first()[0] == 0
    assert checks.mismatch_counts(a, b, ["id"], ["v"], null_safe=True).first()[0] == 1
    empty = a.filter("false")
    assert checks.mismatch_counts(empty, b, ["id"], ["v"]).first()[0] == 0
