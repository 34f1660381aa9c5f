"""The declared checks of every layer."""

from __future__ import annotations

from datetime import datetime

from tradewind.functions import measures
from tradewind.operators.dedup import duplicate_keys
from tradewind.operators.quality import Check, orphan_orders, revenue_mismatch

STATUSES = tuple(measures.ORDER_STATUSES)
SEGMENTS = tuple(measures.CUSTOMER_SEGMENTS)


def _not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", c) for c in columns]


def _unique(table: str, *columns: str) -> list[Check]:
    return [Check(table, "unique", c) for c in columns]


def _at_least_zero(table: str, column: str, high: float | None = None) -> Check:
    return Check(table, "between", column, "warn", low=0, high=high)


def _accepted(table: str, column: str, values: tuple, severity: str = "error") -> Check:
    return Check(table, "accepted_values", column, severity, values=values)


SOURCE_CHECKS = [
    *_not_null("raw_orders", "order_id", "customer_id", "_loaded_at"),
    *_not_null("raw_customers", "customer_id", "_loaded_at"),
    *_not_null("raw_order_items", "order_item_id", "order_id", "product_id", "_loaded_at"),
    *_not_null("raw_products", "product_id", "_loaded_at"),
]

STAGING_CHECKS = [
    *_not_null(
        "stg_orders", "order_id", "customer_id", "order_status", "order_amount_usd", "order_date",
        "_raw_loaded_at",
    ),
    *_unique("stg_orders", "order_id"),
    Check("stg_orders", "relationships", "customer_id", "warn", to=("stg_customers", "customer_id")),
    _accepted("stg_orders", "order_status", STATUSES, "warn"),
    _at_least_zero("stg_orders", "order_amount_usd"),
    *_not_null("stg_customers", "customer_id", "email", "country_code"),
    *_unique("stg_customers", "customer_id"),
    _accepted("stg_customers", "customer_segment", SEGMENTS, "warn"),
    *_not_null("stg_order_items", "order_item_id", "order_id", "product_id", "quantity"),
    *_unique("stg_order_items", "order_item_id"),
    _at_least_zero("stg_order_items", "quantity", 10000),
    _at_least_zero("stg_order_items", "line_total_usd"),
    *_not_null("stg_products", "product_id", "product_name"),
    *_unique("stg_products", "product_id"),
    _at_least_zero("stg_products", "unit_cost_usd"),
]

MART_CHECKS = [
    *_not_null("fct_orders", "order_sk", "order_id", "order_date_day", "revenue_usd", "_raw_loaded_at"),
    *_unique("fct_orders", "order_sk"),
    Check("fct_orders", "not_null", "customer_sk", "warn"),
    Check("fct_orders", "relationships", "customer_sk", "warn", to=("dim_customers", "customer_sk")),
    _accepted("fct_orders", "order_status", STATUSES),
    _at_least_zero("fct_orders", "revenue_usd"),
    _at_least_zero("fct_orders", "line_item_count"),
    *_not_null("dim_customers", "customer_sk", "customer_id", "country_code", "is_active", "is_current"),
    *_unique("dim_customers", "customer_sk", "customer_id"),
    _accepted("dim_customers", "customer_segment", SEGMENTS, "warn"),
    _at_least_zero("dim_customers", "lifetime_value_usd"),
    _accepted("dim_customers", "rfm_segment", tuple(measures.RFM_SEGMENTS), "warn"),
    *_not_null("dim_products", "product_sk", "product_id", "product_name", "is_active"),
    *_unique("dim_products", "product_sk", "product_id"),
    _accepted("dim_products", "margin_tier", tuple(measures.MARGIN_TIERS)),
]


def singular_checks(as_of: datetime) -> list[Check]:
    """The three checks that are whole queries."""
    return [
        Check("fct_orders", "no_duplicate_order_keys",
              custom=lambda t: duplicate_keys(t["fct_orders"], "order_sk")),
        Check("fct_orders", "orders_have_valid_customers",
              custom=lambda t: orphan_orders(t["fct_orders"], t["dim_customers"], as_of)),
        Check("fct_orders", "revenue_matches_line_items",
              custom=lambda t: revenue_mismatch(t["fct_orders"], t["stg_order_items"])),
    ]


def all_checks(as_of: datetime) -> list[Check]:
    return SOURCE_CHECKS + STAGING_CHECKS + MART_CHECKS + singular_checks(as_of)
