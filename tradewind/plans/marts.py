"""Dimensions and the order fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import casts, keys, measures
from tradewind.operators.history import current_versions
from tradewind.operators.joins import HotKeys, join_on_hot_key
from tradewind.operators.lookback import DEFAULT_DAYS, since

SNAPSHOT_COLUMNS = [
    "customer_id", "email", "first_name", "last_name", "country_code", "customer_segment",
    "acquisition_channel", "is_email_verified", "customer_created_at", "customer_updated_at",
]
_COUNTERS = ["total_orders", "completed_orders", "cancelled_orders", "lifetime_value_usd"]
_METRICS = [
    "avg_order_value_usd", "max_order_value_usd", "first_order_date", "last_order_date",
    "customer_tenure_days", "days_since_last_order", "avg_days_to_ship", "cancellation_rate_pct",
    "rfm_score", "rfm_segment", "recency_score", "frequency_score", "monetary_score",
]


def customer_versions(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows under their dimension names, with the key and the current flag."""
    return snapshot.select(
        keys.customer_key("customer_id").alias("customer_sk"),
        *[c for c in SNAPSHOT_COLUMNS if c != "customer_updated_at"],
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        F.col("version_updated_at").alias("snapshot_updated_at"),
    )


def dim_customers(snapshot: DataFrame, lifetime_value: DataFrame) -> DataFrame:
    """Current customers with their order history; counters are 0 for those without orders."""
    profile = customer_versions(current_versions(snapshot)).drop("snapshot_updated_at")
    behaviour = lifetime_value.select("customer_id", *_COUNTERS, *_METRICS)
    joined = profile.join(behaviour, "customer_id", "left")
    zero_filled = {c: F.coalesce(c, F.lit(0).cast(behaviour.schema[c].dataType)) for c in _COUNTERS}
    flags = {
        "has_placed_order": F.col("total_orders") > 0,
        "is_active": F.coalesce(
            F.col("days_since_last_order") <= measures.ACTIVE_DAYS, F.lit(False)
        ),
    }
    return joined.withColumns(zero_filled).withColumns(flags).select(
        *profile.columns, *_COUNTERS, *_METRICS, *flags
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with the parent of their category and a margin tier."""
    lookup = categories.select(
        casts.upper_text("category_name").alias("_category"), "parent_category"
    )
    keyed = products.withColumn("_category", casts.upper_text("category"))
    joined = join_on_hot_key(keyed, lookup, "_category", spread_by="product_id")
    return joined.select(
        keys.surrogate_key("product_id").alias("product_sk"),
        "product_id",
        "product_name",
        "category",
        "brand",
        F.coalesce("parent_category", F.lit("Uncategorized")).alias("parent_category"),
        "unit_cost_usd",
        "list_price_usd",
        "margin_pct",
        measures.margin_tier("margin_pct").alias("margin_tier"),
        "is_active",
    )


def touched_orders(enriched: DataFrame, items: DataFrame, mark: datetime, days: int = DEFAULT_DAYS) -> DataFrame:
    """Enriched orders with a line newer than the mark, whatever the load time of the order."""
    fresh = since(items, "_raw_loaded_at", mark, days).select("order_id").distinct()
    return enriched.join(fresh, "order_id", "left_semi")


def fct_orders(
    enriched: DataFrame, customers: DataFrame, mark: datetime | None = None,
    days: int = DEFAULT_DAYS, items: DataFrame | None = None, hot: HotKeys | None = None,
) -> DataFrame:
    """One row per order.

    With a mark only orders loaded since then (less the look-back) come out; passing ``items`` as
    well adds older orders whose lines arrived late.
    """
    chosen = since(enriched, "_raw_loaded_at", mark, days)
    if mark is not None and items is not None:
        late = touched_orders(enriched, items, mark, days)
        chosen = chosen.unionByName(late.join(chosen.select("order_id"), "order_id", "left_anti"))
    current = customers.filter("is_current").select("customer_id", "customer_sk")
    joined = join_on_hot_key(chosen, current, "customer_id", spread_by="order_id", hot=hot)
    return joined.select(
        keys.surrogate_key("order_id").alias("order_sk"),
        "order_id",
        "customer_id",
        "customer_sk",
        F.col("order_date").alias("order_date_day"),
        keys.date_key("order_date").alias("order_date_key"),
        "order_month",
        "order_year",
        "order_quarter",
        "order_day_of_week",
        "order_status",
        "payment_method",
        "billing_country_code",
        F.col("country_code").alias("customer_country_code"),
        "customer_segment",
        "acquisition_channel",
        "customer_type_at_order",
        "is_completed",
        "order_amount_usd",
        "revenue_usd",
        "items_total_usd",
        "discounted_items_total_usd",
        "avg_discount_pct",
        measures.gross_margin("revenue_usd", "discounted_items_total_usd").alias("gross_margin_usd"),
        "line_item_count",
        "total_quantity",
        "distinct_product_count",
        "max_unit_price_usd",
        "days_to_ship",
        "shipped_date",
        measures.status_flag("order_status", "cancelled").alias("is_cancelled"),
        measures.status_flag("order_status", "refunded").alias("is_refunded"),
        "_raw_loaded_at",
    )
