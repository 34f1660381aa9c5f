"""Feeds: two drops of files and a restart equal one batch."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

from tradewind.plans import staging
from tradewind.sources.tables import StoredTable
from tradewind.streaming import feed

T0 = datetime(2024, 1, 1)
SCHEMA = (
    "order_item_id string, order_id string, product_id string, quantity decimal(10,0), "
    "unit_price decimal(18,4), discount_pct decimal(5,2), _loaded_at timestamp_ntz"
)


def deliveries(spark, rows):
    from decimal import Decimal as D

    full = [(i, "O" + i, p, D(q), D("1.5"), D("0"), T0 + timedelta(hours=h)) for i, p, q, h in rows]
    return spark.createDataFrame(full, SCHEMA)


def test_two_drops_and_restart(spark, tmp_path):
    landing, work = f"{tmp_path}/landing", f"{tmp_path}/work"
    first = deliveries(spark, [("1", "p", 1, 1), ("1", "q", 2, 3), ("2", "p", 1, 1)])
    second = deliveries(spark, [("1", "late", 9, 2), ("3", "p", 1, 5), ("2", "r", 4, 6)])

    def run():
        stream = feed.change_feed(spark, landing, first.schema, files_per_batch=1)
        return feed.upsert_stream(
            stream, staging.stg_order_items, f"{work}/table", "order_item_id", f"{work}/offsets",
            version="_raw_loaded_at",
        )

    first.coalesce(1).write.mode("append").parquet(landing)
    assert run().count() == 2
    second.coalesce(1).write.mode("append").parquet(landing)
    streamed = run()
    batch = staging.stg_order_items(first.unionByName(second))
    assert Counter(streamed.collect()) == Counter(batch.collect())
    version = StoredTable(spark, f"{work}/table").listing()["version"]
    run()
    assert StoredTable(spark, f"{work}/table").listing()["version"] == version


def test_replayed_batch_changes_nothing(spark, tmp_path):
    table = StoredTable(spark, f"{tmp_path}/t")
    rows = staging.stg_order_items(deliveries(spark, [("1", "p", 1, 1)]))
    assert table.upsert(rows, "order_item_id", batch_id="s#0")
    assert table.upsert(rows, "order_item_id", batch_id="s#0") is None


def test_outdated_deliveries_rewrite_nothing(spark, tmp_path):
    from tradewind.sources.tables import StoredTable

    table = StoredTable(spark, f"{tmp_path}/held", bucket_by="k", buckets=2)
    shape = "k string, v int, at int"
    table.upsert(spark.createDataFrame([("a", 1, 5), ("b", 1, 5), ("c", 1, None), (None, 1, 5)], shape), "k", "at", "1")
    before = table.listing()["parts"]
    table.upsert(spark.createDataFrame([("a", 2, 4), ("b", 2, None)], shape), "k", "at", "2")
    assert table.listing()["parts"] == before and table.has_batch("2")
    table.upsert(spark.createDataFrame([("a", 3, 4), ("b", 3, 5), ("c", 3, 1), ("d", 3, 1), (None, 3, 9)], shape), "k", "at", "3")
    assert sorted((r.k or "", r.v) for r in table.read().collect()) == [("", 1), ("", 3), ("a", 1), ("b", 3), ("c", 3), ("d", 3)]
