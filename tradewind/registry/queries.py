"""One query per operator, each over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import calendar, casts, keys, masks
from tradewind.operators import control, governance, history, lookback, quality, reports
from tradewind.operators import upsert as merging
from tradewind.operators.joins import HotKeys
from tradewind.plans import checks, intermediate, marts, staging
from tradewind.registry import shapes
from tradewind.registry.landings import ingest_csv_drift, ingest_csv_orders, ingest_json_layouts, ingest_json_log  # noqa: F401
from tradewind.registry.shapes import AS_OF, AS_OF_TS, table
from tradewind.session import ensure_checkpoint_dir, side_by_side, stage
from tradewind.sources import seeds
from tradewind.sources.tables import StoredTable
from tradewind.streaming import feed

FIRST_RUN = datetime(2001, 1, 1)
SECOND_RUN = datetime(2001, 6, 1)
MARK = datetime(1999, 1, 1)
EVENTS_AS_OF = datetime(2024, 1, 20, 12, 30)
FRESHNESS_TIMES = {
    "purchase": EVENTS_AS_OF, "click": datetime(2024, 1, 31, 15), "view": datetime(2024, 2, 1, 15),
    "signup": datetime(2024, 1, 31, 2), "error": datetime(2024, 3, 1),
}

Query = Callable[[SparkSession, str], DataFrame]


def published(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as bigint, the types both engines share."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- layers -------------------------------------------------------------------------------------


def stg_orders(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_orders(shapes.raw_orders(spark, d))


def stg_items(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_order_items(shapes.raw_order_items(spark, d))


def stg_customers(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_customers(shapes.raw_customers(spark, d))


def stg_products(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_products(shapes.raw_products(spark, d))


def hot_customers(spark: SparkSession, d: str) -> HotKeys:
    return HotKeys(shapes.raw_orders(spark, d), "customer_id")


def enriched(spark: SparkSession, d: str, hot: HotKeys | None = None) -> DataFrame:
    return intermediate.int_orders(
        stg_orders(spark, d), stg_customers(spark, d), stg_items(spark, d),
        hot or hot_customers(spark, d),
    )


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return intermediate.customer_metrics(enriched(spark, d), AS_OF)


def scores(spark: SparkSession, d: str) -> DataFrame:
    return intermediate.rfm_scores(metrics(spark, d))


def first_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """History after a run over the first deliveries of every customer."""
    raw = shapes.raw_customers(spark, d).filter(F.col("_ingestion_run_id") == "run_0")
    source = staging.stg_customers(raw).select(*marts.SNAPSHOT_COLUMNS)
    return history.history_step(None, source, "customer_id", "customer_updated_at", FIRST_RUN)


def second_snapshot(spark: SparkSession, d: str, hard_deletes: bool = True, leaving: bool = False) -> DataFrame:
    """History after a second run over all deliveries; with ``leaving``, customers in debt are no longer delivered."""
    source = stg_customers(spark, d).select(*marts.SNAPSHOT_COLUMNS)
    if leaving:
        gone = table(spark, d, "customer").filter("c_acctbal < 0").selectExpr("cast(c_custkey as string) as customer_id")
        source = source.join(gone, "customer_id", "left_anti")
    return history.history_step(
        first_snapshot(spark, d), source, "customer_id", "customer_updated_at", SECOND_RUN, hard_deletes=hard_deletes,
    )


def customers_dim(spark: SparkSession, d: str) -> DataFrame:
    return marts.dim_customers(second_snapshot(spark, d), scores(spark, d))


def products_dim(spark: SparkSession, d: str) -> DataFrame:
    return marts.dim_products(stg_products(spark, d), seeds.product_categories(spark))


def customer_keys(spark: SparkSession, d: str) -> DataFrame:
    """The key columns of the customer dimension; the fact needs nothing else of it."""
    return marts.customer_versions(history.current_versions(second_snapshot(spark, d)))


def facts(spark: SparkSession, d: str) -> DataFrame:
    hot = hot_customers(spark, d)
    return marts.fct_orders(enriched(spark, d, hot), customer_keys(spark, d), hot=hot)


# --- staging and models -------------------------------------------------------------------------


def stg_orders_dedup(spark, d):
    return published(stg_orders(spark, d))


def stg_order_items_dedup(spark, d):
    return published(stg_items(spark, d))


def stg_products_clean(spark, d):
    return published(stg_products(spark, d))


def stg_customers_flatten(spark, d):
    return published(stg_customers(spark, d))


def events_variant_extract(spark, d):
    events = table(spark, d, "events").withColumn("payload", F.parse_json("props"))
    return published(
        events.select(
            "event_id",
            casts.payload_value("payload", "k", "int").alias("k"),
            casts.payload_value("payload", "k", "string").alias("k_text"),
            casts.payload_value("payload", "absent", "string").alias("absent"),
        )
    )


def orders_enriched(spark, d):
    return published(enriched(spark, d))


def order_item_totals(spark, d):
    totals = intermediate.order_item_totals(stg_items(spark, d))
    return published(totals)


def customer_metrics(spark, d):
    return published(metrics(spark, d))


def rfm_scored(spark, d):
    columns = ["customer_id", "recency_score", "frequency_score", "monetary_score", "rfm_score"]
    return published(scores(spark, d).select(*columns))


def rfm_segments(spark, d):
    grouped = scores(spark, d).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("lifetime_value_usd").alias("lifetime_value_usd"),
        F.max("cancellation_rate_pct").alias("max_cancellation_rate_pct"),
    )
    return published(grouped)


def rfm_best_is_high(spark, d):
    scored = intermediate.rfm_scores(metrics(spark, d), best_is_high=True)
    columns = ["recency_score", "frequency_score", "monetary_score", "rfm_segment"]
    return published(scored.select("customer_id", *columns))


def metrics_backfill(spark, d):
    window = intermediate.customer_metrics(
        enriched(spark, d), AS_OF, date(1997, 1, 1), date(1997, 12, 31)
    )
    return published(window)


def dim_products(spark, d):
    return published(products_dim(spark, d))


def dim_customers(spark, d):
    return published(customers_dim(spark, d))


def fct_orders(spark, d):
    return published(facts(spark, d))


# --- expressions --------------------------------------------------------------------------------


def surrogate_keys(spark, d):
    items = shapes.raw_order_items(spark, d)
    orders = shapes.raw_orders(spark, d)
    by_order = orders.select(
        F.lit("order").alias("kind"), keys.surrogate_key("order_id").alias("sk"),
        keys.customer_key("customer_id").alias("customer_sk"),
    )
    by_line = items.select(
        F.lit("line").alias("kind"), keys.surrogate_key("order_id", "product_id").alias("sk"),
        F.lit(None).cast("string").alias("customer_sk"),
    )
    return by_order.unionByName(by_line)


def date_keys(spark, d):
    orders = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return published(
        orders.select(
            "o_orderkey",
            keys.date_key("day").alias("date_key"),
            calendar.month_start("day").alias("month_start"),
            calendar.year_start("day").alias("year_start"),
            calendar.day_of_week("day").alias("day_of_week"),
            F.quarter("day").alias("quarter"),
            keys.run_stamp("o_orderdate").alias("stamp"),
        )
    )


def safe_cast_defaults(spark, d):
    text = F.when(F.col("event_id") % 7 == 0, F.concat("event_type", F.lit("!"))).otherwise(
        F.col("value").cast("decimal(18,2)").cast("string")
    )
    events = table(spark, d, "events").withColumn("raw", text)
    return published(
        events.select(
            "event_id",
            casts.safe_cast("raw", "decimal(18,2)", 0).alias("amount"),
            casts.safe_cast("raw", "decimal(18,2)").alias("amount_or_null"),
            casts.safe_cast("raw", "date").alias("day"),
            casts.null_tokens(F.when(F.col("event_id") % 3 == 0, " N/A ").otherwise(F.col("raw"))).alias(
                "text"
            ),
        )
    )


def union_pad_columns(spark, d):
    orders = stg_orders(spark, d).select("order_id", "order_status", "order_amount_usd")
    products = stg_products(spark, d).select("product_id", "margin_pct")
    return published(merging.union_padded(orders, products))


def column_names(spark, d):
    """Column lists of two relations, counted per relation next to their row counts."""
    parts = []
    for name in ("orders", "lineitem"):
        df = table(spark, d, name)
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("relation"), F.lit(",".join(df.columns)).alias("columns"), "row_count"
        ))
    return parts[0].unionByName(parts[1])


# --- increments, merges and history -------------------------------------------------------------


def loaded_before(df: DataFrame, moment: datetime) -> DataFrame:
    return df.filter(F.col("_loaded_at") < F.lit(moment).cast("timestamp_ntz"))


def incremental_lookback(spark, d):
    raw = shapes.raw_orders(spark, d)
    mark = lookback.high_mark(loaded_before(raw, MARK), "_loaded_at")
    return published(staging.stg_orders(raw, mark))


def lookback_skipped(spark, d):
    raw = shapes.raw_orders(spark, d)
    mark = lookback.high_mark(loaded_before(raw, MARK), "_loaded_at")
    skipped = lookback.too_old(raw, "_loaded_at", mark)
    return skipped.groupBy("_source_file").agg(F.count(F.lit(1)).alias("skipped"))


def upsert_orders(spark, d):
    raw = shapes.raw_orders(spark, d)
    target = staging.stg_orders(loaded_before(raw, MARK))
    mark = lookback.high_mark(loaded_before(raw, MARK), "_loaded_at")
    return published(merging.upsert(target, staging.stg_orders(raw, mark), "order_id"))


def stored_upsert_partitions(spark, d):
    """The same merge into stored tables: one split by buckets of the key, one by order month, whose rows may move."""
    raw = shapes.raw_orders(spark, d)
    old, delta = staging.stg_orders(loaded_before(raw, MARK)), staging.stg_orders(
        raw, lookback.high_mark(loaded_before(raw, MARK), "_loaded_at"))
    work = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    month = F.date_format("order_date", "yyyy-MM").alias("order_month")

    def merged(layout: str) -> DataFrame:
        if layout == "buckets":
            stored = StoredTable(spark, f"{work}/{layout}", bucket_by="order_id")
            stored.overwrite(old)
            stored.upsert(delta, "order_id")
            rows = stored.read()
        else:
            stored = StoredTable(spark, f"{work}/{layout}", "order_month")
            stored.overwrite(old.select("*", month))
            stored.upsert(delta.select("*", month), "order_id")
            rows = stored.read().drop("order_month")
        return rows.withColumn("layout", F.lit(layout))

    buckets, months = side_by_side(spark, merged, ["buckets", "months"])
    return published(buckets.unionByName(months))


def upsert_newer_wins(spark, d):
    """The late batch holds the first deliveries, which must not displace the later ones."""
    raw = shapes.raw_orders(spark, d)
    late = staging.stg_orders(raw.filter(F.col("_ingestion_run_id") == "run_0"))
    early = staging.stg_orders(raw.filter(F.col("_ingestion_run_id") != "run_0"))
    return published(merging.upsert_if_newer(early, late, "order_id", "_raw_loaded_at"))


def upsert_new_columns(spark, d):
    products = stg_products(spark, d)
    old = products.select("product_id", "product_name", "category")
    changed = products.filter("margin_pct >= 60").select(
        "product_id", F.upper("product_name").alias("product_name"), "category", "margin_pct"
    )
    return published(merging.upsert(old, changed, "product_id"))


def fct_late_lines(spark, d):
    """Increment of the fact that also takes older orders whose lines came after the mark."""
    hot = hot_customers(spark, d)
    rows = marts.fct_orders(
        enriched(spark, d, hot), customer_keys(spark, d), MARK, items=stg_items(spark, d), hot=hot
    )
    return published(rows.select("order_id", "order_status", "revenue_usd", "_raw_loaded_at"))


def scd2_snapshot(spark, d):
    return published(second_snapshot(spark, d, hard_deletes=False, leaving=True))


def scd2_hard_delete(spark, d):
    return published(second_snapshot(spark, d, leaving=True))


def scd2_check_strategy(spark, d):
    """Versions by comparing columns: segment or country changed."""
    raw = shapes.raw_customers(spark, d).filter(F.col("_ingestion_run_id") == "run_0")
    watched = ["customer_segment", "country_code"]
    args = ("customer_id", "customer_updated_at")
    before = staging.stg_customers(raw).select("customer_id", "customer_updated_at", *watched)
    after = stg_customers(spark, d).select("customer_id", "customer_updated_at", *watched)
    first = history.history_step(None, before, *args, FIRST_RUN, check_columns=watched)
    return published(history.history_step(first, after, *args, SECOND_RUN, check_columns=watched))


def scd2_as_of_join(spark, d):
    versions = second_snapshot(spark, d, leaving=True).select(
        "customer_id", F.col("customer_segment").alias("segment_then"), "valid_from", "valid_to"
    )
    orders = stg_orders(spark, d).select("order_id", "customer_id", "order_date")
    return published(
        history.version_at(
            orders, versions, "customer_id", "order_date", "left", "order_id", hot_customers(spark, d)
        )
    )


# --- reports ------------------------------------------------------------------------------------


def revenue_by_region_month(spark, d):
    rows = enriched(spark, d)
    return published(
        reports.revenue_by_region_month(rows, seeds.country_codes(spark), "billing_country_code")
    )


def new_vs_returning(spark, d):
    grouped = enriched(spark, d).groupBy("customer_type_at_order", "order_year").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("revenue_usd").alias("revenue_usd")
    )
    return published(grouped)


def rolling_spend_alert(spark, d):
    events = table(spark, d, "events").select(
        F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,2)").alias("spent")
    )
    return published(reports.rolling_spend_alert(events, "day", "spent", percent=101))


# --- checks -------------------------------------------------------------------------------------


def dq_suite(spark, d):
    """Every declared check with its number of failures.

    Models are stored before they are checked, as a run does, so no check builds them again, and by column, as a
    check reads few of them. Those that don't need each other are built at the same time.
    """
    hot = hot_customers(spark, d)

    def built(*models: Callable[[], DataFrame]) -> list[DataFrame]:
        return side_by_side(spark, lambda model: stage(model(), "model"), list(models))

    orders, customers, items, products, versions = built(
        *[partial(model, spark, d) for model in (stg_orders, stg_customers, stg_items, stg_products, second_snapshot)]
    )
    rows, dim_products = built(
        lambda: intermediate.int_orders(orders, customers, items, hot),
        lambda: marts.dim_products(products, seeds.product_categories(spark)),
    )
    value = intermediate.int_lifetime_value(rows, AS_OF)
    dim = stage(marts.dim_customers(versions, value), "model")
    tables = {
        "raw_orders": shapes.raw_orders(spark, d),
        "raw_customers": shapes.raw_customers(spark, d),
        "raw_order_items": shapes.raw_order_items(spark, d),
        "raw_products": shapes.raw_products(spark, d),
        "stg_orders": orders,
        "stg_customers": customers,
        "stg_order_items": items,
        "stg_products": products,
        "fct_orders": stage(marts.fct_orders(rows, dim, hot=hot), "model"),
        "dim_customers": dim,
        "dim_products": dim_products,
    }
    return quality.count_failures(checks.all_checks(AS_OF_TS), tables)


def dq_not_null(spark, d):
    tables = {"raw_orders": shapes.raw_orders(spark, d)}
    chosen = [c for c in checks.SOURCE_CHECKS if c.table == "raw_orders"]
    return quality.count_failures(chosen, tables)


def dq_unique(spark, d):
    check = quality.Check("raw_order_items", "unique", "order_item_id")
    return quality.failing_rows(check, {"raw_order_items": shapes.raw_order_items(spark, d)})


def dq_accepted_values(spark, d):
    check = quality.Check(
        "stg_customers", "accepted_values", "customer_segment", "warn", values=checks.SEGMENTS
    )
    rows = quality.failing_rows(check, {"stg_customers": stg_customers(spark, d)})
    return rows.select("customer_id", "customer_segment")


def dq_between(spark, d):
    check = quality.Check("stg_order_items", "between", "quantity", "warn", low=5, high=45)
    rows = quality.failing_rows(check, {"stg_order_items": stg_items(spark, d)})
    return published(rows.select("order_item_id", "quantity"))


def dq_relationships(spark, d):
    check = quality.Check(
        "stg_orders", "relationships", "customer_id", "warn", to=("stg_customers", "customer_id")
    )
    tables = {"stg_orders": stg_orders(spark, d), "stg_customers": stg_customers(spark, d)}
    return quality.failing_rows(check, tables).select("order_id", "customer_id")


def dq_pair_ge(spark, d):
    check = quality.Check(
        "stg_products", "pair_ge", "list_price_usd", to=("stg_products", "unit_cost_usd")
    )
    rows = quality.failing_rows(check, {"stg_products": stg_products(spark, d)})
    return published(rows.select("product_id", "list_price_usd", "unit_cost_usd"))


def dq_row_count(spark, d):
    return quality.row_count_failure(stg_orders(spark, d), 1, 10)


def dq_date_anomaly(spark, d):
    return quality.date_anomalies(stg_orders(spark, d)).select("order_id", "order_date", "shipped_date")


def dq_duplicate_keys(spark, d):
    return quality.duplicate_keys(
        shapes.raw_orders(spark, d).select(keys.surrogate_key("order_id").alias("order_sk")), "order_sk"
    )


def dq_orphan_orders(spark, d):
    raw_keys = shapes.raw_orders(spark, d).select(keys.customer_key("customer_id").alias("customer_sk"))
    hot = HotKeys(raw_keys, "customer_sk")
    return quality.orphan_orders(facts(spark, d), customer_keys(spark, d), AS_OF_TS, hot=hot)


def dq_revenue_reconciliation(spark, d):
    rows = quality.revenue_mismatch(enriched(spark, d), stg_items(spark, d), "order_amount_usd")
    return published(rows)


def dq_freshness(spark, d):
    """Every type of event as a source read at a time of its own: fresh, late or stale."""
    parts = []
    for kind, now in FRESHNESS_TIMES.items():
        known = F.col("ts") <= F.lit(now).cast("timestamp_ntz")
        rows = table(spark, d, "events").filter((F.col("event_type") == kind) & known)
        parts.append(quality.freshness(rows, kind, "ts", now))
    return reduce(DataFrame.unionByName, parts)


# --- governance ---------------------------------------------------------------------------------


def mask_by_role(spark, d):
    customers = stg_customers(spark, d)
    columns = ["customer_id"]
    for role in ("TRANSFORMER", "ANALYST", "LOADER"):
        name = role.lower()
        columns += [
            masks.mask_email("email", role).alias(f"email_{name}"),
            masks.mask_phone("phone", role).alias(f"phone_{name}"),
            masks.mask_string("last_name", role).alias(f"last_name_{name}"),
            masks.mask_number(F.year("date_of_birth"), role).cast("bigint").alias(f"birth_{name}"),
        ]
    columns.append(masks.mask_email("email", "ANALYST", "first_letter").alias("email_first_letter"))
    return customers.select(*columns)


def masked_customers(spark, d):
    """The policy of the customer table as an analyst reads it."""
    shown = governance.apply_masking(stg_customers(spark, d), "ANALYST")
    return shown.select("customer_id", "email", "phone", "country_code")


def row_access(spark, d):
    tenant = F.concat(F.lit("tenant_"), F.col("c_nationkey").cast("string"))
    customers = table(spark, d, "customer").select("c_custkey", tenant.alias("tenant_id"))
    access = table(spark, d, "nation").select(
        F.concat(F.lit("ANALYST_R"), F.col("n_regionkey").cast("string")).alias("role_name"),
        F.concat(F.lit("tenant_"), F.col("n_nationkey").cast("string")).alias("tenant_id"),
    )
    return governance.row_access(customers, access, "ANALYST_R2")


def safe_customer_view(spark, d):
    return published(governance.safe_customer_view(customers_dim(spark, d), "ANALYST"))


# --- control tables -----------------------------------------------------------------------------


def file_log(spark: SparkSession, d: str) -> DataFrame:
    """The event table read as a file log: one file per user, its states by event type."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "FAILED").when(kind == "click", "IN_PROGRESS").otherwise("SUCCESS")
    )
    return table(spark, d, "events").select(
        F.col("event_id").alias("log_id"),
        F.concat(F.lit("orders/file_"), F.col("user_id").cast("string"), F.lit(".csv")).alias("file_path"),
        F.lit("ECOMMERCE").alias("source_schema"),
        F.lit("ORDERS").alias("target_table"),
        status.alias("load_status"),
        F.when(kind == "purchase", (F.col("value") * 10).cast("bigint")).alias("rows_loaded"),
        F.lit(0).cast("bigint").alias("rows_rejected"),
        F.when(kind == "error", F.concat(F.lit("bad row "), F.col("props"))).alias("error_message"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("completed_at"),
    )


def latest_file_status(spark, d):
    return control.latest_file_status(file_log(spark, d))


def files_pending_retry(spark, d):
    before = file_log(spark, d).filter(F.col("started_at") <= F.lit(EVENTS_AS_OF).cast("timestamp_ntz"))
    return control.files_pending_retry(before, EVENTS_AS_OF)


def new_files_anti_join(spark, d):
    listing = table(spark, d, "events").select(
        F.concat(F.lit("orders/file_"), (F.col("user_id") * 2).cast("string"), F.lit(".csv")).alias(
            "file_path"
        )
    ).distinct()
    return control.new_files(listing, file_log(spark, d), "ORDERS")


def _registry_rows(events: DataFrame) -> DataFrame:
    """Columns as registered: one per payload value, in a table per event type."""
    value = F.get_json_object("props", "$.k")
    seen = events.groupBy("event_type", value.alias("k")).agg(
        F.min("ts").alias("first_seen_at"), F.max("ts").alias("last_seen_at"), F.min("event_id").alias("n")
    )
    return seen.select(
        F.lit("RAW").alias("target_database"),
        F.lit("ECOMMERCE").alias("target_schema"),
        F.upper("event_type").alias("target_table"),
        F.concat(F.lit("C"), F.col("k")).alias("column_name"),
        F.when(F.col("n") % 2 == 0, "string").otherwise("bigint").alias("column_data_type"),
        (F.col("n") % 5 != 0).alias("is_active"),
        "first_seen_at",
        "last_seen_at",
        F.concat(F.lit("f"), F.col("n").cast("string")).alias("added_via_file"),
    )


def _registry_halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, d, "events")
    middle = F.lit(datetime(2024, 1, 3)).cast("timestamp_ntz")
    return _registry_rows(events.filter(F.col("ts") < middle)), _registry_rows(
        events.filter(F.col("ts") >= middle)
    )


def schema_registry_merge(spark, d):
    held, seen = _registry_halves(spark, d)
    return control.merge_registry(held, seen)


def schema_drift_report(spark, d):
    return control.schema_drift_report(_registry_rows(table(spark, d, "events")))


def task_run_seconds(spark, d):
    log = file_log(spark, d).select("log_id", "started_at", "completed_at")
    return published(control.with_run_seconds(log))


# --- streaming ----------------------------------------------------------------------------------


def stream_dedup_upsert(spark, d):
    """Order lines as an append-only feed, merged into a staged table batch by batch."""
    source = table(spark, d, "lineitem").schema
    stream = feed.change_feed(spark, f"{d}/lineitem.parque[t]", source)
    work = f"{ensure_checkpoint_dir(spark)}/feed-{uuid.uuid4().hex}"
    stored = feed.upsert_stream(
        shapes.order_items_shape(stream), staging.stg_order_items, f"{work}/table", "order_item_id",
        f"{work}/offsets", version="_raw_loaded_at",
    )
    return published(stored)


def stream_batches_upsert(spark, d):
    """Order lines in three drops, the last of them outdated re-deliveries, and a restart without news; one batch a drop."""
    lines = shapes.raw_order_items(spark, d)
    work = f"{ensure_checkpoint_dir(spark)}/feed-{uuid.uuid4().hex}"
    loaded = F.col("_loaded_at")
    outdated = lines.withColumns({
        "quantity": (F.col("quantity") + 1).cast(lines.schema["quantity"].dataType), "_loaded_at": loaded - F.expr("interval 1 day"),
    })
    old = loaded < F.lit(datetime(1995, 1, 1))
    merged = StoredTable(spark, f"{work}/table", bucket_by="order_item_id")
    for drop in (lines.filter(old), lines.filter(F.coalesce(~old, F.lit(True))), outdated, None):
        if drop is not None:
            drop.write.mode("append").parquet(f"{work}/landing")
        stream = feed.change_feed(spark, f"{work}/landing", lines.schema)
        stored = feed.upsert_stream(
            stream, staging.stg_order_items, merged, "order_item_id", f"{work}/offsets", version="_raw_loaded_at",
        )
    return published(stored)


NAMES = """
stg_orders_dedup stg_order_items_dedup stg_products_clean stg_customers_flatten
events_variant_extract orders_enriched order_item_totals customer_metrics rfm_scored rfm_segments
rfm_best_is_high metrics_backfill dim_products dim_customers fct_orders surrogate_keys date_keys
safe_cast_defaults union_pad_columns column_names incremental_lookback lookback_skipped
upsert_orders upsert_newer_wins upsert_new_columns fct_late_lines scd2_snapshot scd2_hard_delete
scd2_check_strategy scd2_as_of_join revenue_by_region_month new_vs_returning rolling_spend_alert
dq_suite dq_not_null dq_unique dq_accepted_values dq_between dq_relationships dq_pair_ge
dq_row_count dq_date_anomaly dq_duplicate_keys dq_orphan_orders dq_revenue_reconciliation
dq_freshness mask_by_role masked_customers row_access safe_customer_view latest_file_status
files_pending_retry new_files_anti_join schema_registry_merge schema_drift_report task_run_seconds
stream_dedup_upsert stream_batches_upsert stored_upsert_partitions ingest_csv_orders ingest_csv_drift ingest_json_layouts ingest_json_log
""".split()


def registered() -> dict[str, Query]:
    return {name: globals()[name] for name in NAMES}
