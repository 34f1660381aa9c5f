"""Role-dependent masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.keys import as_column

# Roles and replacement texts of the masking rules.
FULL_ROLES = ["TRANSFORMER", "DATA_ENGINEER", "SYSADMIN", "ACCOUNTADMIN"]
PARTIAL_ROLES = ["ANALYST"]
MASKED = "***MASKED***"
MASKED_NUMBER = -1


def mask_email(column: Column | str, role: str, style: str = "domain") -> Column:
    """Full value, ``****@domain`` (``first_letter`` keeps one letter), or the masked text."""
    value = as_column(column)
    if role in FULL_ROLES:
        return value
    if role in PARTIAL_ROLES:
        lead = F.left(value, F.lit(1)) if style == "first_letter" else F.lit("")
        return F.concat(lead, F.lit("****@"), F.split_part(value, F.lit("@"), F.lit(2)))
    return F.lit(MASKED)


def mask_phone(column: Column | str, role: str) -> Column:
    """Full value, the last four digits, or the masked text."""
    value = as_column(column)
    if role in FULL_ROLES:
        return value
    if role in PARTIAL_ROLES:
        digits = F.regexp_replace(value, "[^0-9]", "")
        return F.concat(F.lit("***-***-"), F.right(digits, F.lit(4)))
    return F.lit(MASKED)


def mask_string(column: Column | str, role: str) -> Column:
    return as_column(column) if role in FULL_ROLES else F.lit(MASKED)


def mask_number(column: Column | str, role: str) -> Column:
    return as_column(column) if role in FULL_ROLES else F.lit(MASKED_NUMBER)
