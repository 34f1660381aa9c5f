"""Type 2 history: properties over several runs, and stored tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from tradewind.operators.history import history_step, version_at
from tradewind.sources.tables import ConcurrentWrite, StoredTable

T0 = datetime(2024, 1, 1)
SCHEMA = "customer_id string, segment string, updated_at timestamp_ntz"


def day(n):
    return T0 + timedelta(days=n)


def moment_at(n):
    return T0 + timedelta(seconds=n)


def step(spark, held, rows, run, closed=None, **options):
    source = spark.createDataFrame(rows, SCHEMA)
    return history_step(held, source, "customer_id", "updated_at", run, closed_rows=closed, **options)


def spans(df):
    rows = [(r.customer_id, r.segment, r.valid_from, r.valid_to) for r in df.collect()]
    return sorted(rows, key=str)


def test_change_delete_and_late_update(spark):
    first = step(spark, None, [("a", "x", day(1)), ("b", "x", day(1)), ("c", "x", None)], day(2))
    second = step(
        spark, first, [("a", "y", day(5)), ("c", "z", None), ("d", "x", day(6))], day(7)
    )
    assert spans(second) == [
        ("a", "x", day(1), day(5)), ("a", "y", day(5), None), ("b", "x", day(1), day(7)),
        ("c", "x", day(2), None), ("d", "x", day(6), None),
    ]
    # An older update arriving late changes nothing.
    third = step(spark, second.filter("valid_to is null"), [("a", "old", day(3))], day(8), hard_deletes=False)
    assert ("a", "y", day(5), None) in spans(third) and len(spans(third)) == 3


def test_check_strategy_ignores_update_time(spark):
    first = step(spark, None, [("a", "x", day(1)), ("b", None, day(1))], day(2), check_columns=["segment"])
    again = step(spark, first, [("a", "x", day(9)), ("b", "y", day(1))], day(10), check_columns=["segment"])
    assert spans(again) == [
        ("a", "x", day(2), None), ("b", "y", day(10), None), ("b", None, day(2), day(10)),
    ]


def test_intervals_never_overlap(spark, tmp_path):
    """Random runs with deletes, returns and stale updates."""
    rng = random.Random(3)
    table = StoredTable(spark, f"{tmp_path}/history", "is_open")
    for run in range(5):
        rows = [
            (f"c{i}", rng.choice("xyz"), day(rng.randrange(0, run * 10 + 5)))
            for i in range(30) if rng.random() < 0.8
        ]
        at = day(run * 10 + 6)
        if not table.exists():
            versions = step(spark, None, rows, at)
            table.overwrite(versions.selectExpr("*", "valid_to is null as is_open"))
        else:
            closed = table.read(["is_open=false"])
            opened = table.read(["is_open=true"]).drop("is_open")
            versions = step(spark, opened, rows, at, closed)
            table.replace(versions.selectExpr("*", "valid_to is null as is_open"), ["true"])
        found = defaultdict(list)
        for r in table.read().collect():
            found[r.customer_id].append((r.valid_from, r.valid_to or datetime.max))
        assert {r[0] for r in rows} == {
            r.customer_id for r in table.read().filter("valid_to is null").collect()
        }
        for key, intervals in found.items():
            intervals.sort()
            assert sum(end == datetime.max for _, end in intervals) <= 1, key
            for (_, end), (start, _) in zip(intervals, intervals[1:]):
                assert end <= start, (key, intervals)


def test_version_at(spark):
    versions = spark.createDataFrame(
        [("a", "x", day(1), day(5)), ("a", "y", day(5), None)],
        "customer_id string, segment string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    facts = spark.createDataFrame(
        [(1, "a", day(0)), (2, "a", day(1)), (3, "a", day(5)), (4, "b", day(5)), (5, None, day(5))],
        "id int, customer_id string, at timestamp_ntz",
    )
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    results = []
    for limit in (held, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        joined = version_at(facts, versions, "customer_id", "at", spread_by="id")
        results.append({r.id: r.segment for r in joined.collect()})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert results == [{1: None, 2: "x", 3: "y", 4: None, 5: None}] * 2


def test_version_at_many_versions_of_a_hot_key(spark):
    """Merged by time: a hot key in slices, ties at borders, gaps, empty intervals, null keys and moments."""
    rng = random.Random(3)
    intervals, facts = [], []
    for key, versions in [("hot", 300), *[(f"k{i}", 2) for i in range(20)]]:
        at = 0
        for i in range(versions):
            start = at + rng.choice([0, 0, 3])
            at = start + rng.choice([0, 1, 5])
            intervals.append((key, f"{key}-{i}", moment_at(start), None if i == versions - 1 else moment_at(at)))
    for i in range(3000):
        key = rng.choice(["hot"] * 10 + [f"k{rng.randrange(25)}", None])
        moment = moment_at(500) if i % 3 == 0 else moment_at(rng.randrange(-5, 1200))
        facts.append((i, key, None if i % 50 == 7 else moment))
    versions = spark.createDataFrame(intervals, "customer_id string, segment string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    rows = spark.createDataFrame(facts, "id int, customer_id string, at timestamp_ntz")
    expected = {
        i: next((s for k, s, a, b in intervals if k == key and at and a <= at and (b is None or at < b)), None) for i, key, at in facts
    }
    joined = version_at(rows, versions, "customer_id", "at", spread_by="id")
    assert "SortMergeJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    found = joined.collect()
    assert len(found) == len(facts) and {r.id: r.segment for r in found} == expected
    inner = version_at(rows, versions, "customer_id", "at", "inner").collect()
    assert {r.id: r.segment for r in inner} == {i: s for i, s in expected.items() if s}
    assert len({s for s in expected.values()}) > 100


@pytest.mark.parametrize("layout", [{"bucket_by": "k", "buckets": 4}, {"partition_by": "part"}, {}])
def test_upsert_rewrites_only_files_with_a_matched_row(spark, tmp_path, layout):
    table = StoredTable(spark, f"{tmp_path}/t", **layout)
    row = lambda k, v: (k, f"a/b {k % 2}", v)
    frame = lambda rows: spark.createDataFrame(rows, "k int, part string, v string")
    held = {}
    for write in range(3):
        rows = [row(k, f"w{write}") for k in range(write * 10, write * 10 + 10)]
        table.append(frame(rows))
        held |= {r[0]: r for r in rows}
    before = {f for paths in table.listing()["parts"].values() for p in paths for f in table._expanded(p)}
    delta = [row(3, "new"), row(25, "new"), row(99, "added")]
    table.upsert(frame(delta), "k")
    held |= {r[0]: r for r in delta}
    after = {f for paths in table.listing()["parts"].values() for p in paths for f in table._expanded(p)}
    holding = table._files({**table.listing()}, sorted(before), True).filter("k in (3, 25)").select("_file").distinct().count()
    assert len(before - after) == holding == 2
    assert Counter(map(tuple, table.read().collect())) == Counter(held.values())
    table.upsert(frame([row(3, "newer"), row(99, "again")]), "k")
    held |= {3: row(3, "newer"), 99: row(99, "again")}
    assert Counter(map(tuple, table.read().collect())) == Counter(held.values())
    assert table.compact(most=1) >= 1
    assert Counter(map(tuple, table.read().collect())) == Counter(held.values())
    assert all(len(paths) == 1 for paths in table.listing()["parts"].values())


def test_files_follow_partitions_not_tasks(spark, tmp_path):
    """A small write of many tasks gives about one file a partition."""
    table = StoredTable(spark, f"{tmp_path}/t", "part")
    table.overwrite(spark.range(0, 8000, 1, 16).selectExpr("id", "cast(id % 5 as string) as part"))
    assert table.file_count() == 5
    assert table.read().count() == 8000


def test_table_upsert_moves_rows_between_partitions(spark, tmp_path):
    table = StoredTable(spark, f"{tmp_path}/t", "month", ["k"])
    table.overwrite(spark.createDataFrame([(1, "m1", "a"), (2, "m2", "b"), (3, "m3", "c")], "k int, month string, v string"))
    untouched = table.listing()["parts"]["month=m3"]
    delta = spark.createDataFrame([(1, "m2", "A", 5), (4, None, "d", 6)], "k int, month string, v string, extra int")
    table.upsert(delta, "k", batch_id="b1")
    expected = Counter([(1, "m2", "A", 5), (2, "m2", "b", None), (3, "m3", "c", None), (4, None, "d", 6)])
    read = lambda: Counter((r.k, r.month, r.v, r.extra) for r in table.read().collect())
    assert read() == expected
    assert table.listing()["parts"]["month=m3"] == untouched
    assert table.upsert(delta, "k", batch_id="b1") is None
    table.upsert(delta, "k")
    assert read() == expected
    with pytest.raises(ValueError, match="not unique"):
        table.upsert(delta.unionByName(delta), "k")


def test_table_versions_and_views(spark, tmp_path):
    table = StoredTable(spark, f"{tmp_path}/t")
    for i in range(4):
        table.overwrite(spark.createDataFrame([(i,)], "k int"), comment=f"run {i}")
    table.append(spark.createDataFrame([(9, "x")], "k int, more string"), "b")
    assert table.append(spark.createDataFrame([(9, "x")], "k int, more string"), "b") is None
    assert {tuple(r) for r in table.read().collect()} == {(3, None), (9, "x")}
    assert table.listing()["comment"] == "run 3"
    table.as_view("kept_rows")
    assert spark.table("kept_rows").count() == 2
    assert table.expire(keep=1) == 3
    assert table.read().count() == 2
    stale = dict(table.listing())
    with pytest.raises(ConcurrentWrite):
        table._store_listing(stale)
