"""Enriched orders and customer lifetime value."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import calendar, measures
from tradewind.operators.joins import HotKeys, join_on_hot_key
from tradewind.operators.ntile import ntile_scores

# Range that keeps every dated order; a run narrows it for a backfill.
ALL_DATES = (date(1900, 1, 1), date(9999, 12, 31))


def order_item_totals(items: DataFrame) -> DataFrame:
    """Line measures per order. Every aggregate combines before the shuffle; the distinct product
    count first groups by order and product, so one huge order spreads over its products."""
    discounted = F.when(F.col("discount_pct") > 0, F.col("line_total_usd"))
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total_usd").alias("items_total_usd"),
        F.sum(discounted).alias("discounted_items_total_usd"),
        F.avg("discount_pct").alias("avg_discount_pct"),
        F.max("unit_price_usd").alias("max_unit_price_usd"),
        F.count_distinct("product_id").alias("distinct_product_count"),
    )


def int_orders(
    orders: DataFrame, customers: DataFrame, items: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """One row per order that is not anomalous, with customer context, calendar and revenue."""
    context = customers.select(
        "customer_id", "country_code", "customer_segment", "acquisition_channel", "customer_created_at"
    )
    # Orders and line totals are both hashed on order_id here, so this join adds no shuffle.
    sized = orders.filter(~F.col("is_date_anomaly")).join(order_item_totals(items), "order_id", "left")
    joined = join_on_hot_key(sized, context, "customer_id", spread_by="order_id", hot=hot)
    return joined.select(
        "order_id",
        "customer_id",
        "country_code",
        "customer_segment",
        "acquisition_channel",
        "order_status",
        "order_date",
        "shipped_date",
        "payment_method",
        "billing_country_code",
        "is_completed",
        calendar.month_start("order_date").alias("order_month"),
        calendar.year_start("order_date").alias("order_year"),
        calendar.day_of_week("order_date").alias("order_day_of_week"),
        F.quarter("order_date").alias("order_quarter"),
        "order_amount_usd",
        "items_total_usd",
        "discounted_items_total_usd",
        "avg_discount_pct",
        F.coalesce("items_total_usd", "order_amount_usd").alias("revenue_usd"),
        "line_item_count",
        "total_quantity",
        "distinct_product_count",
        "max_unit_price_usd",
        calendar.days_between("order_date", "shipped_date").alias("days_to_ship"),
        measures.customer_type("customer_created_at", "order_date").alias("customer_type_at_order"),
        "_raw_loaded_at",
        "_source_file",
    )


def customer_metrics(
    enriched: DataFrame, as_of: date, start: date = ALL_DATES[0], end: date = ALL_DATES[1]
) -> DataFrame:
    """Order history per customer inside a date range; orders without a date are left out."""
    done = F.col("is_completed")
    revenue = F.col("revenue_usd")
    first, last = F.min("order_date"), F.max("order_date")
    return (
        enriched.filter(F.col("order_date").between(F.lit(start), F.lit(end)))
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_if(done).alias("completed_orders"),
            F.count_if(F.col("order_status") == "cancelled").alias("cancelled_orders"),
            F.sum(F.when(done, revenue).otherwise(0)).alias("lifetime_value_usd"),
            F.avg(F.when(done, revenue)).alias("avg_order_value_usd"),
            F.max(revenue).alias("max_order_value_usd"),
            first.alias("first_order_date"),
            last.alias("last_order_date"),
            F.datediff(last, first).alias("customer_tenure_days"),
            F.datediff(F.lit(as_of), last).alias("days_since_last_order"),
            F.avg("days_to_ship").alias("avg_days_to_ship"),
        )
    )


def rfm_scores(metrics: DataFrame, best_is_high: bool = False) -> DataFrame:
    """Quintiles of recency, frequency and spend over all customers, and the segment they give.

    As scored by default, 1 is the most recent, most frequent and highest-spending fifth;
    ``best_is_high`` turns all three scales round.
    """
    scored = ntile_scores(
        metrics,
        "customer_id",
        {
            "recency_score": ("days_since_last_order", best_is_high),
            "frequency_score": ("total_orders", not best_is_high),
            "monetary_score": ("lifetime_value_usd", not best_is_high),
        },
    )
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.withColumns({
        "rfm_score": total,
        "rfm_segment": measures.rfm_segment("recency_score", "frequency_score", "monetary_score"),
        "cancellation_rate_pct": measures.percent_of("cancelled_orders", "total_orders"),
    })


def int_lifetime_value(
    enriched: DataFrame, as_of: date, start: date = ALL_DATES[0], end: date = ALL_DATES[1],
    best_is_high: bool = False,
) -> DataFrame:
    return rfm_scores(customer_metrics(enriched, as_of, start, end), best_is_high)
