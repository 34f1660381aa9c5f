"""Operators on small frames, with the cases real deliveries contain."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions import calendar, casts, keys, masks, measures
from tradewind.operators import governance, joins, lookback, quality, reports
from tradewind.operators.dedup import duplicate_keys, latest_per_key, refuse_duplicates
from tradewind.operators.ntile import bucket_starts, ntile_scores
from tradewind.operators.upsert import merge_columns, union_padded, upsert, upsert_if_newer


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


# --- expressions --------------------------------------------------------------------------------


def test_surrogate_key_normalises(spark):
    a, b, c, d = one(
        spark, keys.surrogate_key(F.lit(" ab ")), keys.surrogate_key(F.lit("AB")),
        keys.surrogate_key(F.lit(None)), keys.surrogate_key(F.lit("_NULL_")),
    )
    assert a == b and c == d and len(a) == 64


def test_measures(spark):
    dec = lambda v: F.lit(v).cast("decimal(18,4)")
    row = one(
        spark,
        measures.margin_pct(dec("200"), dec("150")), measures.margin_pct(dec("0"), dec("1")),
        measures.margin_tier(F.lit(50)), measures.margin_tier(F.lit(25)), measures.margin_tier(F.lit(24.99)),
        measures.margin_tier(F.lit(None).cast("double")),
        measures.is_date_anomaly(F.lit(date(2024, 1, 2)), F.lit(date(2024, 1, 1))),
        measures.is_date_anomaly(F.lit(date(2024, 1, 2)), F.lit(None).cast("date")),
        measures.percent_of(F.lit(1), F.lit(3)), measures.percent_of(F.lit(1), F.lit(0)),
        calendar.day_of_week(F.lit(date(2024, 1, 7))), calendar.month_start(F.lit(date(2024, 2, 9))),
        casts.safe_cast(F.lit("x"), "int", 7), casts.safe_cast(F.lit("8"), "int", 7),
        casts.null_tokens(F.lit(" N/A ")), casts.null_tokens(F.lit(" a ")),
    )
    assert [row[0], row[1]] == [25, None]
    assert list(row[2:8]) == ["high", "medium", "low", "low", True, False]
    assert float(row[8]) == 33.33 and row[9] is None
    assert list(row[10:]) == [0, date(2024, 2, 1), 7, 8, None, "a"]


def test_hours_count_clock_boundaries(spark):
    at = lambda h, m: F.lit(datetime(2024, 1, 1, h, m)).cast("timestamp_ntz")
    assert one(
        spark, calendar.clock_hours_between(at(10, 59), at(11, 1)),
        calendar.clock_hours_between(at(10, 1), at(10, 59)),
    ) == (1, 0)


@pytest.mark.parametrize("r,f,m,segment", [
    (5, 5, 5, "champions"), (3, 3, 1, "loyal"), (5, 1, 1, "new_customer"), (2, 3, 1, "at_risk"),
    (2, 1, 4, "cant_lose"), (1, 1, 1, "lost"), (2, 2, 2, "potential_loyalist"), (5, 3, 2, "loyal"),
])
def test_segments(spark, r, f, m, segment):
    assert one(spark, measures.rfm_segment(F.lit(r), F.lit(f), F.lit(m)))[0] == segment


def test_masks(spark):
    emails = [masks.mask_email(F.lit(v).cast("string"), "ANALYST") for v in ("a@b.c", "plain", None)]
    phones = [masks.mask_phone(F.lit(v).cast("string"), "ANALYST") for v in ("+1-555-12", "9", None)]
    assert tuple(one(spark, *emails, *phones)) == (
        "****@b.c", "****@", None, "***-***-5512", "***-***-9", None,
    )
    assert tuple(one(
        spark, masks.mask_email(F.lit("a@b.c"), "SYSADMIN"), masks.mask_email(F.lit("a@b.c"), "LOADER"),
        masks.mask_number(F.lit(7), "ANALYST"), masks.mask_email(F.lit("jo@b.c"), "ANALYST", "first_letter"),
    )) == ("a@b.c", "***MASKED***", -1, "j****@b.c")


# --- dedup --------------------------------------------------------------------------------------


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "w"), (None, 9, "n")],
        "k string, at int, v string",
    )
    rows = latest_per_key(df, "k", [F.desc_nulls_last("at"), F.asc("v")]).collect()
    assert {(r.k, r.v) for r in rows} == {("a", "y"), ("b", "w")}
    assert [(r.k, r.row_count) for r in duplicate_keys(df, "k").collect()] == [("a", 3)]
    with pytest.raises(ValueError, match="not unique"):
        refuse_duplicates(df, "k", "frame")


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as at")
    plan = latest_per_key(df, "k", [F.desc("at")])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


# --- joins --------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_join_equals_plain_join(spark, no_broadcast, how):
    left = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null when id % 11 = 0 then \"o'h\\\\x\" "
        "else concat('k', id % 400) end as k",
    )
    right = spark.createDataFrame(
        [("hot", 1), ("o'h\\x", 2)] + [(f"k{i}", i) for i in range(0, 400, 2)], "k string, v int"
    )
    ours = joins.join_on_hot_key(left, right, "k", how, spread_by="id")
    plain = left.join(right, "k", how).select(*ours.columns)
    assert Counter(ours.collect()) == Counter(plain.collect())
    # The hot key is spread: no salted partition value holds all of its rows.
    assert "hot" in joins.HotKeys(left, "k").keys


def test_hot_key_is_salted_in_the_plan(spark, no_broadcast):
    left = spark.range(1000).selectExpr("id", "id % 2 as k")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    plan = joins.join_on_hot_key(left, right, "k", spread_by="id")._jdf.queryExecution().toString()
    assert "_salt" in plan and "explode" in plan


def test_small_side_is_left_to_the_optimizer(spark):
    left = spark.range(1000).selectExpr("id", "id % 2 as k")
    right = spark.sql("select * from values (0L, 'a') as t(k, v)")
    plan = joins.join_on_hot_key(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in plan and "BroadcastHashJoin" in plan


def test_broadcast_limit_reads_units(spark):
    for text, value in (("10MB", 10 * 2**20), ("5k", 5120), ("-1", -1), ("77", 77), ("1g", 2**30)):
        held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert joins.broadcast_limit(spark) == value
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


# --- ntile --------------------------------------------------------------------------------------


def test_bucket_starts():
    for buckets in (3, 4, 5):
        for rows in range(0, 40):
            sizes = [rows // buckets + (i < rows % buckets) for i in range(buckets)]
            expected = [sum(sizes[:i]) for i in range(1, buckets) if sum(sizes[:i]) < rows]
            assert sorted(set(bucket_starts(rows, buckets))) == sorted(set(expected))


@pytest.mark.parametrize("rows,distinct", [(3, 1), (5, 2), (23, 3), (1000, 1), (2017, 40), (1, 1)])
def test_ntile_equals_window_ntile(spark, rows, distinct):
    df = spark.range(rows).selectExpr(
        "if(id = 1, null, concat('c', id)) as k",
        f"cast(pmod(hash(id), {distinct}) as int) as days",
        f"cast(pmod(hash(id, 7), {distinct}) as decimal(20,2)) / 3 as spent",
        f"if(id % 5 = 2, null, pmod(hash(id, 9), {distinct})) as gaps",
    )
    scored = ntile_scores(df, "k", {"a": ("days", False), "b": ("spent", True), "c": ("gaps", True)})
    tie = F.asc_nulls_first("k")
    plain = df.withColumns({
        "a": F.ntile(5).over(W.orderBy("days", tie)),
        "b": F.ntile(5).over(W.orderBy(F.desc("spent"), tie)),
        "c": F.ntile(5).over(W.orderBy(F.desc_nulls_last("gaps"), tie)),
    })
    assert Counter(scored.select("k", "a", "b", "c").collect()) == Counter(
        plain.select("k", "a", "b", "c").collect()
    )


# --- upserts ------------------------------------------------------------------------------------


def test_upsert_is_idempotent_and_pads(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([(2, "B", 9), (3, "c", 8)], "k int, v string, extra int")
    once = upsert(target, delta, "k")
    assert {tuple(r) for r in once.collect()} == {(1, "a", None), (2, "B", 9), (3, "c", 8)}
    assert Counter(upsert(once, delta, "k").collect()) == Counter(once.collect())
    assert union_padded(target, delta).columns == ["k", "v", "extra"]


def test_older_delivery_loses(spark):
    target = spark.createDataFrame([(1, 5, "new"), (2, None, "old"), (4, 1, "x")], "k int, at int, v string")
    delta = spark.createDataFrame(
        [(1, 4, "late"), (2, 1, "fresh"), (3, None, "first"), (4, 1, "tie")], "k int, at int, v string"
    )
    rows = {r.k: r.v for r in upsert_if_newer(target, delta, "k", "at").collect()}
    assert rows == {1: "new", 2: "fresh", 3: "first", 4: "tie"}


def test_merge_columns_changes_only_named_ones(spark):
    target = spark.createDataFrame([("a", 1, 1)], "k string, first int, last int")
    source = spark.createDataFrame([("a", 7, 7), ("b", 8, 8)], "k string, first int, last int")
    rows = merge_columns(target, source, ["k"], {"last": F.col("src_last")}).collect()
    assert {tuple(r) for r in rows} == {("a", 1, 7), ("b", 8, 8)}


def test_lookback(spark):
    times = [datetime(2024, 1, d) for d in (1, 5, 6, 9)]
    df = spark.createDataFrame([(t,) for t in times], "at timestamp_ntz")
    mark = lookback.high_mark(df, "at")
    assert mark == times[-1]
    assert lookback.since(df, "at", mark).count() == 2
    assert lookback.too_old(df, "at", mark).count() == 2
    assert lookback.since(df, "at", None).count() == 4
    assert lookback.high_mark(df.limit(0), "at") == datetime(1970, 1, 1)


# --- checks and governance ----------------------------------------------------------------------


def test_checks_count_and_gate(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, None, -2), (None, "z", None), (None, "a", 99)], "k int, w string, n int"
    )
    declared = [
        quality.Check("t", "not_null", "k"), quality.Check("t", "unique", "k"),
        quality.Check("t", "accepted_values", "w", "warn", values=("a", "b")),
        quality.Check("t", "between", "n", "warn", low=0, high=10),
        quality.Check("t", "row_count", low=1, high=4),
        quality.Check("t", "pair_ge", "n", "warn", to=("t", "k")),
    ]
    counted = {(r.test_name, r.status): r.failures for r in quality.count_failures(declared, {"t": df}).collect()}
    assert counted == {
        ("not_null", "error"): 2, ("unique", "error"): 1, ("accepted_values", "warn"): 1,
        ("between", "warn"): 2, ("row_count", "pass"): 0, ("pair_ge", "warn"): 1,
    }
    with pytest.raises(quality.GateError, match="not_null"):
        quality.gate(quality.count_failures(declared, {"t": df}).collect())


def test_checks_store_failures_and_results(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    checks = [quality.Check("t", "not_null", "k", "warn")]
    results = quality.run_checks(spark, checks, {"t": df}, "r1", f"{tmp_path}", tested_at=datetime(2024, 1, 1))
    quality.gate(results)
    assert spark.read.parquet(f"{tmp_path}/failures/not_null_t_k").count() == 1
    log = spark.read.parquet(f"{tmp_path}/results").first()
    assert (log.run_id, log.status, log.failures, log.environment) == ("r1", "warn", 1, "dev")


@pytest.mark.parametrize("hours,status", [(11, "pass"), (13, "warn"), (25, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "at timestamp_ntz")
    row = quality.freshness(df, "s", "at", datetime(2024, 1, 1) + timedelta(hours=hours)).first()
    assert (row.status, row.age_hours) == (status, hours)
    assert quality.freshness(df.limit(0), "s", "at", datetime(2024, 1, 1)).first().status == "error"


def test_row_access_and_masking(spark, no_broadcast):
    df = spark.createDataFrame([(1, "t1", "a@b.c"), (2, "t2", "d@e.f"), (3, None, None)], "k int, tenant_id string, email string")
    access = spark.createDataFrame([("A", "t1"), ("A", "t1"), ("B", "t2")], "role_name string, tenant_id string")
    seen = {role: {r.k for r in governance.row_access(df, access, role).collect()} for role in ("A", "B", "C", "SYSADMIN")}
    assert seen == {"A": {1}, "B": {2}, "C": set(), "SYSADMIN": {1, 2, 3}}
    assert governance.secure_read(df, "A", access).first().email == "***MASKED***"
    assert governance.apply_masking(df, "C", enabled=False).first().email == "a@b.c"


def test_spend_alert_skips_days_without_spend(spark):
    rows = [(date(2024, 1, 1), 10), (date(2024, 1, 3), 40), (date(2024, 1, 20), 99)]
    df = spark.createDataFrame(rows, "day date, amount int")
    found = {r.day.day: (r.earlier_days, r.is_alert) for r in reports.rolling_spend_alert(df, "day", "amount").collect()}
    assert found == {1: (0, False), 3: (1, True), 20: (0, False)}
