"""Cut keys give what plain windows give, on a table where one user holds a third of all rows."""

import pytest
from helpers import same
from pyspark.sql import functions as F

from strataledger.operators import asof, checks, history, pairing, upsert
from strataledger.operators.hotkeys import piece
from strataledger.operators.ordered import neighbours, numbered, running
from strataledger.operators.temporal import temporal_join
from strataledger.sources.lake import write_table

TINY = True
AT = ["ts", "event_id"]


@pytest.fixture(scope="module")
def skewed(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").drop("props")
    hot = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    nobody = F.pmod(F.xxhash64("event_id"), F.lit(10)) == 1
    user = F.when(hot, F.lit(0)).when(nobody, F.lit(None)).otherwise(F.col("user_id"))
    return events.withColumn("user_id", user.cast("bigint")).cache()


ODD = {
    "double": ["CAST('NaN' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)", "CAST('-Infinity' AS DOUBLE)", "0D", "1e-300D", "-1e300D", "1.001D", "1.004D", "-3.5D"],
    "bigint": ["9223372036854775807", "-9223372036854775808", "0", "1", "-1", "4611686018427387904"],
    "decimal(38,4)": ["9999999999999999999999999999999999.9999", "-9999999999999999999999999999999999.9999", "0.0001", "12345678901234567890.5"],
    "string": ["''", "'a'", "'aa'", "'abc'", "'abcd'", "'abd'", "'é'", "'Z'", "'日本語'"],
    "date": ["DATE'0001-01-01'", "DATE'9999-12-31'", "DATE'2024-02-29'"],
    "timestamp": ["TIMESTAMP'1000-01-01 00:00:00'", "TIMESTAMP'9999-12-31 23:59:59.999999'", "TIMESTAMP'2024-03-10 02:30:00.000001'"],
    "timestamp_ntz": ["TIMESTAMP_NTZ'1000-01-01 00:00:00'", "TIMESTAMP_NTZ'9999-12-31 23:59:59.999999'", "TIMESTAMP_NTZ'2024-03-10 02:30:00.000001'"],
    "boolean": ["true", "false"],
}


@pytest.mark.parametrize("kind", sorted(ODD))
def test_every_type_of_order(spark, kind):
    """NULL, NaN, infinities, ends of ranges: the pieces follow Spark's own order."""
    values = ", ".join([*ODD[kind], "NULL"])
    rows = spark.sql(f"SELECT 7 AS k, CAST(v AS {kind}) AS o FROM (SELECT explode(array({values})) AS v)")
    rows = rows.crossJoin(spark.range(3)).withColumn("k", F.when(F.col("id") == 2, F.lit(None)).otherwise(F.col("k")))
    w = [p[0] for p in rows.select(piece(rows, ["o"]).alias("p"), "o").orderBy("o").select("p").collect()]
    assert w == sorted(w, key=lambda x: (x is not None, x if x is not None else 0)) or kind in ("string", "boolean")

    def run(split):
        seen = neighbours(rows, ["k"], ["o", "id"], before={"p": F.col("o")}, after={"n": F.col("id")}, split=split)
        done = running(seen, ["k"], ["o", "id"], sums={"i": F.lit(1).cast("long")}, maxes={"m": F.col("o")}, fills={"f": F.col("p")}, split=split)
        return done.withColumns({c: F.col(c).cast("string") for c in ("o", "p", "m", "f")})  # Python's NaN equals nothing

    assert same(run(True), run(False)) == rows.count()


def test_no_job_starts_while_plans_are_built(spark, skewed, versions):
    spark.sparkContext.setJobGroup("plans", "plans")
    rows = neighbours(skewed, ["user_id"], AT, before={"p": F.col("value")})
    rows = running(rows, ["user_id"], AT, fills={"f": F.col("p")})
    temporal_join(numbered(rows, ["user_id"], AT).withColumn("day", F.to_date("ts")), versions, ["user_id"], "day")
    asof.asof_latest(skewed.select("event_id", "user_id", "ts"), skewed.select("user_id", F.col("ts").alias("at"), "value"), ["user_id"], "ts", "at", {"value": "seen"})
    upsert.assign_keys(skewed.select("event_id").withColumn("k", F.lit(1)), skewed.select("event_id"), "k", ["event_id"])
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert not started


def test_a_hot_key_is_spread(skewed):
    """No piece holds more than a small part of the hot user's rows."""
    cut = skewed.filter("user_id = 0").groupBy(piece(skewed, AT).alias("p")).count()
    assert cut.agg(F.max("count")).first()[0] <= 5


def test_a_chain_reads_its_input_once(spark, sf):
    """Both readers of cut rows share an exchange."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.read.parquet(f"{sf}/events.parquet")
        for i in range(3):
            rows = neighbours(rows, ["user_id"], AT, before={f"p{i}": F.col("value")})
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("keys", [["user_id"], ["user_id", "event_type"], []])
def test_neighbours(skewed, keys):
    def run(split):
        return neighbours(
            skewed, keys, AT, before={"p": F.col("event_type"), "pv": F.col("value") * 2}, after={"n": F.col("ts")}, split=split
        )

    assert same(run(TINY), run(None)) == 1_000


@pytest.mark.parametrize("keys", [["user_id"], []])
@pytest.mark.parametrize("ties", ["rows", "range"])
def test_running(skewed, keys, ties):
    order = AT if ties == "rows" else ["day"]
    rows = skewed.withColumn("day", F.to_date("ts"))
    bought = F.when(F.col("event_type") == "purchase", F.col("ts"))

    def run(split):
        fills = {"last": bought} if ties == "rows" else {}
        return running(
            rows, keys, order, sums={"n": F.lit(1).cast("long")}, maxes={"top": F.col("value")}, fills=fills, ties=ties, split=split
        )

    assert same(run(TINY), run(None)) == 1_000


def bursts(skewed, kind):
    """Hot users whose rows pile up at one moment, within a second, or with a NULL time."""
    third = F.pmod(F.xxhash64("event_id", F.lit("b")), F.lit(3))
    at = F.lit("2024-01-03 10:00:00").cast("timestamp_ntz")
    near = at + F.make_dt_interval(secs=(F.col("event_id") / 1000).cast("decimal(18,6)"))
    ts = {
        "moment": F.when(third == 0, F.col("ts")).otherwise(at), "all": at, "second": F.when(third == 0, F.col("ts")).otherwise(near),
        "null": F.when(third == 0, F.lit(None)).otherwise(at), "none": F.lit(None).cast("timestamp_ntz"),
    }[kind]
    return skewed.withColumn("ts", ts)


@pytest.mark.parametrize("kind", ["moment", "all", "second", "null", "none"])
def test_bursts(skewed, kind):
    rows = bursts(skewed, kind)
    def run(split):
        seen = neighbours(rows, ["user_id"], AT, before={"p": F.col("event_id")}, after={"n": F.col("value")}, split=split)
        return running(seen, ["user_id"], AT, sums={"i": F.lit(1).cast("long")}, fills={"f": F.col("p")}, split=split)

    assert same(run(TINY), run(None)) == 1_000


def test_history_operators(skewed):
    from strataledger.functions.hashing import with_row_hash

    hashed = with_row_hash(skewed, ["event_type"])
    same(history.changes_only(hashed, ["user_id"], AT, split=TINY), history.changes_only(hashed, ["user_id"], AT, split=False))
    rows = skewed.withColumn("start_date", F.col("ts"))
    same(
        history.close_with_next(rows, ["user_id"], AT, split=TINY), history.close_with_next(rows, ["user_id"], AT, split=False)
    )
    same(
        history.end_of_day_flags(skewed, "user_id", "ts", "event_id", split=TINY),
        history.end_of_day_flags(skewed, "user_id", "ts", "event_id", split=False),
    )
    same(checks.repeated_hash(hashed, "user_id", AT, split=TINY), checks.repeated_hash(hashed, "user_id", AT, split=False))


def test_stitch(skewed):
    rows = skewed.select("user_id", "event_type", F.col("ts").alias("start_date"), F.col("event_id").alias("tie"))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    old, new = rows.filter("event_type <> 'view'"), rows.filter("event_type <> 'click'")
    same(
        history.stitch(old, new, "user_id", cut, ["event_type"], split=TINY),
        history.stitch(old, new, "user_id", cut, ["event_type"], split=False),
    )


@pytest.fixture(scope="module")
def versions(skewed):
    hist = history.build_scd2(skewed.filter("user_id is not null"), "user_id", "ts", "event_id", ["event_type"])
    return hist.select("user_id", F.col("event_type").alias("version"), "start_date", "end_date").cache()


@pytest.mark.parametrize(
    ("how", "closed", "shift"), [("inner", "left", 0), ("left", "left", 5), ("inner", "both", 0), ("left", "both", 5)],
)
def test_temporal_join(skewed, versions, how, closed, shift):
    fact = skewed.withColumn("day", F.to_date("ts"))
    got = temporal_join(fact, versions, ["user_id"], "day", closed=closed, how=how, shift_days=shift)
    fact.createOrReplaceTempView("fact")
    versions.createOrReplaceTempView("versions")
    upper = "<=" if closed == "both" else "<"
    want = fact.sparkSession.sql(f"""SELECT f.*, version, start_date, end_date FROM fact f {how} JOIN versions v ON f.user_id = v.user_id
        AND v.start_date <= date_sub(day, {shift}) AND date_sub(day, {shift}) {upper} v.end_date""")
    assert same(got, want) > 500


@pytest.mark.parametrize("strict", [False, True])
def test_asof(skewed, strict):
    shots = skewed.filter("event_type = 'view'").select("user_id", F.col("ts").alias("at"), "event_id", "value")

    def run(split):
        return asof.asof_latest(
            skewed.select("event_id", "user_id", "ts"), shots, ["user_id"], "ts", "at", {"value": "seen"},
            strict=strict, tie="event_id", max_age_days=4, split=split,
        )

    assert same(run(TINY), run(None)) == 1_000


def test_prior_and_pairs(skewed):
    same(
        asof.prior_within_months(skewed, ["user_id"], "ts", "event_id", 1, split=TINY),
        asof.prior_within_months(skewed, ["user_id"], "ts", "event_id", 1, split=False),
    )

    def seq(split):
        return pairing.sequence_events(
            skewed, "user_id", "ts", "event_id", F.col("event_type") == "error", F.col("event_type") == "purchase", split=split
        )

    same(pairing.pair_events(seq(TINY), "ts"), pairing.pair_events(seq(None), "ts"))
    same(pairing.unmatched_closers(seq(TINY)), pairing.unmatched_closers(seq(None)))


def test_surrogate_keys(spark, skewed, tmp_path):
    tgt = spark.createDataFrame([(41, 7)], "k int, event_id bigint")
    new = skewed.select("event_id")
    same(
        upsert.assign_keys(tgt, new, "k", ["event_id"], split=TINY), upsert.assign_keys(tgt, new, "k", ["event_id"], split=False)
    )
    tables = iter(range(9))
    staged = upsert.assign_keys(tgt, new, "k", ["event_id"], stage=lambda df: write_table(df, f"{tmp_path}/{next(tables)}"))
    same(staged, upsert.assign_keys(tgt, new, "k", ["event_id"], split=False))


@pytest.mark.parametrize("step", ["numbered", "neighbours", "fill"])
def test_chains_grow_by_the_step(spark, sf, step):
    """One scan however many steps are chained, and the same exchanges for each."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    found = []
    for n in (1, 2, 10):
        df = events
        for i in range(n):
            if step == "numbered":
                df = numbered(df, ["user_id"], ["ts", "event_id"], f"s{i}")
            elif step == "neighbours":
                df = neighbours(df, ["user_id"], ["ts", "event_id"], before={f"s{i}": F.col("value")}, after={f"t{i}": F.col("value")})
            else:
                df = running(df, ["user_id"], ["ts", "event_id"], fills={f"s{i}": F.col("value")}, maxes={f"m{i}": F.col("value")})
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        found.append(plan.count("Exchange "))
    assert found[1] <= 2 * found[0] and found[2] <= 10 * found[0]
