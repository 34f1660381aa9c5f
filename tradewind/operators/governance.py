"""Masking policies, tenant row access and the safe customer view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import masks
from tradewind.operators.joins import join_on_hot_key

CUSTOMER_POLICY: dict[str, Callable[[str, str], Column]] = {
    "email": masks.mask_email,
    "phone": masks.mask_phone,
}


def apply_masking(
    df: DataFrame, role: str, policy: dict[str, Callable] = CUSTOMER_POLICY, enabled: bool = True
) -> DataFrame:
    """Replace the columns a policy names by what ``role`` may see of them."""
    if not enabled:
        return df
    shown = {c: mask(c, role) for c, mask in policy.items() if c in df.columns}
    return df.withColumns(shown) if shown else df


def row_access(df: DataFrame, access_map: DataFrame, role: str, tenant: str = "tenant_id") -> DataFrame:
    """Rows of the tenants mapped to ``role``; the full-access roles see every row."""
    if role in masks.FULL_ROLES:
        return df
    allowed = access_map.filter(F.col("role_name") == role)
    tenants = allowed.select(F.col("tenant_id").alias(tenant)).distinct()
    return join_on_hot_key(df, tenants, tenant, "left_semi")


def safe_customer_view(customers: DataFrame, role: str, enabled: bool = True) -> DataFrame:
    """Active customers without direct identifiers; unknown roles get no email at all."""
    shown = apply_masking(customers, role, {"email": masks.mask_email}, enabled)
    viewers = ["ANALYST", "TRANSFORMER", "DATA_ENGINEER", "SYSADMIN"]
    email = F.col("email") if role in viewers else F.lit(None).cast("string")
    columns = [
        "customer_sk", "customer_id", email.alias("email"), "country_code", "customer_segment",
        "lifetime_value_usd", "total_orders", "first_order_date", "last_order_date", "is_active",
    ]
    if "_model_updated_at" in customers.columns:
        columns.append("_model_updated_at")
    return shown.filter("is_active").select(*columns)


def secure_read(
    df: DataFrame, role: str, access_map: DataFrame | None = None, tenant: str = "tenant_id",
    policy: dict[str, Callable] = CUSTOMER_POLICY, enabled: bool = True,
) -> DataFrame:
    """What ``role`` reads of ``df``: row access first, then masks, in one plan."""
    rows = df if access_map is None else row_access(df, access_map, role, tenant)
    return apply_masking(rows, role, policy, enabled)
