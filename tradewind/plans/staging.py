"""Raw rows to clean, typed, deduplicated rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import casts, measures
from tradewind.operators.dedup import latest_per_key
from tradewind.operators.lookback import DEFAULT_DAYS, since


def stg_orders(raw: DataFrame, mark: datetime | None = None, days: int = DEFAULT_DAYS) -> DataFrame:
    """Last delivery per order, cleaned. Ties on load time go to the later run, then file."""
    latest = latest_per_key(
        since(raw, "_loaded_at", mark, days),
        "order_id",
        [
            F.desc_nulls_last("_loaded_at"),
            F.desc_nulls_last("_ingestion_run_id"),
            F.desc_nulls_last("_source_file"),
        ],
    )
    typed = latest.select(
        F.col("order_id").cast("string"),
        F.col("customer_id").cast("string"),
        casts.lower_text("order_status").alias("order_status"),
        F.col("order_amount").cast("decimal(18,2)").alias("order_amount_usd"),
        casts.try_date("order_date").alias("order_date"),
        casts.try_date("shipped_date").alias("shipped_date"),
        casts.lower_text("payment_method").alias("payment_method"),
        casts.upper_text("billing_country").alias("billing_country_code"),
        F.col("_loaded_at").alias("_raw_loaded_at"),
        "_source_file",
        "_ingestion_run_id",
    )
    return typed.withColumns({
        "is_completed": measures.is_completed("order_status"),
        "is_date_anomaly": measures.is_date_anomaly("order_date", "shipped_date"),
    })


def flatten_customers(raw: DataFrame) -> DataFrame:
    """One typed row per delivery: the direct column first, then the payload key."""

    def either(column: str) -> F.Column:
        return F.coalesce(
            F.col(column).cast("string"), casts.payload_value("raw_payload", column, "string")
        )

    def inside(key: str, datatype: str = "string") -> F.Column:
        return casts.payload_value("raw_payload", key, datatype).alias(key)

    return raw.select(
        either("customer_id").alias("customer_id"),
        either("email").alias("email"),
        either("phone").alias("phone"),
        F.upper(either("country")).alias("country_code"),
        inside("first_name"),
        inside("last_name"),
        inside("date_of_birth", "date"),
        inside("customer_segment"),
        inside("acquisition_channel"),
        inside("is_email_verified", "boolean"),
        F.coalesce(
            casts.try_timestamp("created_at"),
            casts.try_timestamp(casts.payload_value("raw_payload", "created_at", "string")),
        ).alias("customer_created_at"),
        casts.try_timestamp(casts.payload_value("raw_payload", "updated_at", "string")).alias(
            "customer_updated_at"
        ),
        F.col("_loaded_at").alias("_raw_loaded_at"),
        "_source_file",
        "_ingestion_run_id",
    )


def stg_customers(raw: DataFrame, mark: datetime | None = None, days: int = DEFAULT_DAYS) -> DataFrame:
    """Latest version per customer by its own update time, then by load time."""
    return latest_per_key(
        flatten_customers(since(raw, "_loaded_at", mark, days)),
        "customer_id",
        [
            F.desc_nulls_last("customer_updated_at"),
            F.desc_nulls_last("_raw_loaded_at"),
            F.desc_nulls_last("_ingestion_run_id"),
            F.desc_nulls_last("_source_file"),
        ],
    )


def stg_order_items(raw: DataFrame, mark: datetime | None = None, days: int = DEFAULT_DAYS) -> DataFrame:
    """Last delivery per line. The line total ignores the discount."""
    latest = latest_per_key(
        since(raw, "_loaded_at", mark, days),
        "order_item_id",
        [
            F.desc_nulls_last("_loaded_at"),
            F.desc_nulls_last("product_id"),
            F.desc_nulls_last("quantity"),
            F.desc_nulls_last("unit_price"),
            F.desc_nulls_last("discount_pct"),
            F.desc_nulls_last("order_id"),
        ],
    )
    return latest.select(
        F.col("order_item_id").cast("string"),
        F.col("order_id").cast("string"),
        F.col("product_id").cast("string"),
        F.col("quantity").cast("int").alias("quantity"),
        (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("line_total_usd"),
        F.col("discount_pct").cast("decimal(5,2)").alias("discount_pct"),
        F.col("unit_price").cast("decimal(18,2)").alias("unit_price_usd"),
        F.col("_loaded_at").alias("_raw_loaded_at"),
    )


def stg_products(raw: DataFrame, mark: datetime | None = None, days: int = DEFAULT_DAYS) -> DataFrame:
    """Last delivery per product with its margin; an unreadable active flag counts as active."""
    latest = latest_per_key(
        since(raw, "_loaded_at", mark, days),
        "product_id",
        [F.desc_nulls_last("_loaded_at"), F.desc_nulls_last("list_price"), F.desc_nulls_last("unit_cost")],
    )
    typed = latest.select(
        F.col("product_id").cast("string"),
        F.trim("product_name").alias("product_name"),
        casts.upper_text("category").alias("category"),
        casts.upper_text("brand").alias("brand"),
        F.col("unit_cost").cast("decimal(18,4)").alias("unit_cost_usd"),
        F.col("list_price").cast("decimal(18,4)").alias("list_price_usd"),
        casts.safe_cast(F.col("is_active").cast("string"), "boolean", True).alias("is_active"),
        F.col("_loaded_at").alias("_raw_loaded_at"),
    )
    return typed.withColumn("margin_pct", measures.margin_pct("list_price_usd", "unit_cost_usd"))
