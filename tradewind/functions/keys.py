"""Surrogate and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*columns: Column | str) -> Column:
    """SHA-256 hex over the normalised texts, nulls spelled ``_null_``, joined by two bars."""
    parts = [
        F.upper(F.trim(F.coalesce(as_column(c).cast("string"), F.lit("_null_")))) for c in columns
    ]
    return F.sha2(F.concat_ws("||", *parts), 256)


def customer_key(column: Column | str) -> Column:
    """Plain MD5 of the customer id: this dimension does not normalise its key first."""
    return F.md5(as_column(column))


def date_key(column: Column | str) -> Column:
    """Calendar date as a yyyymmdd integer."""
    return F.date_format(as_column(column), "yyyyMMdd").cast("int")


def run_stamp(column: Column | str) -> Column:
    """Timestamp as ``yyyyMMdd_HHmmss`` text, used to name runs."""
    return F.date_format(as_column(column), "yyyyMMdd_HHmmss")
