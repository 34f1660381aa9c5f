"""Business measures and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.keys import as_column

# Accepted words of the coded columns.
ORDER_STATUSES = [
    "pending", "processing", "shipped", "delivered", "completed", "cancelled", "refunded",
]
COMPLETED_STATUSES = ["delivered", "completed"]
CUSTOMER_SEGMENTS = ["bronze", "silver", "gold", "platinum", "vip"]
MARGIN_TIERS = ["high", "medium", "low"]
RFM_SEGMENTS = [
    "champions", "loyal", "new_customer", "at_risk", "cant_lose", "lost", "potential_loyalist",
]
ACTIVE_DAYS = 90


def is_completed(status: Column | str) -> Column:
    return as_column(status).isin(COMPLETED_STATUSES)


def is_date_anomaly(ordered: Column | str, shipped: Column | str) -> Column:
    """Shipped before ordered; a missing date is no anomaly."""
    return F.coalesce(as_column(shipped) < as_column(ordered), F.lit(False))


def status_flag(status: Column | str, wanted: str) -> Column:
    return F.when(as_column(status) == wanted, 1).otherwise(0).cast("int")


def margin_pct(list_price: Column | str, cost: Column | str) -> Column:
    price, unit_cost = as_column(list_price), as_column(cost)
    return F.when(price > 0, F.round((price - unit_cost) / price * 100, 2))


def margin_tier(margin: Column | str) -> Column:
    value = as_column(margin)
    return F.when(value >= 50, "high").when(value >= 25, "medium").otherwise("low")


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """Percentage with two decimals; null when the whole is zero."""
    total = F.nullif(as_column(whole), F.lit(0)).cast("decimal(20,0)")
    return F.round(as_column(part).cast("decimal(20,0)") / total * 100, 2)


def customer_type(created: Column | str, ordered: Column | str) -> Column:
    same_day = F.to_date(as_column(created)) == as_column(ordered)
    return F.when(same_day, "new").otherwise("returning")


def gross_margin(revenue: Column | str, discounted: Column | str) -> Column:
    """Revenue less the full price of the discounted lines (not less cost)."""
    zero = F.lit(0)
    return F.coalesce(as_column(revenue), zero) - F.coalesce(as_column(discounted), zero)


def rfm_segment(recency: Column | str, frequency: Column | str, monetary: Column | str) -> Column:
    """Segment label; rules are tried in order and the first that holds wins."""
    r, f, m = as_column(recency), as_column(frequency), as_column(monetary)
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "champions")
        .when((r >= 3) & (f >= 3), "loyal")
        .when((r >= 4) & (f <= 2), "new_customer")
        .when((r <= 2) & (f >= 3), "at_risk")
        .when((r <= 2) & (m >= 4), "cant_lose")
        .when(r <= 1, "lost")
        .otherwise("potential_loyalist")
    )
