"""Tolerant casts and text clean-up for raw values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.keys import as_column

# Texts that mean "no value" in a delimited file.
NULL_TOKENS = ["NULL", "null", "", "NA", "N/A"]


def safe_cast(column: Column | str, datatype: str, default: object = None) -> Column:
    """Cast, giving null (or ``default``) where the value does not fit."""
    value = as_column(column).try_cast(datatype)
    if default is None:
        return value
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(value, fallback.cast(datatype))


def try_date(column: Column | str) -> Column:
    return as_column(column).cast("string").try_cast("date")


def try_timestamp(column: Column | str) -> Column:
    return as_column(column).cast("string").try_cast("timestamp_ntz")


def null_tokens(column: Column | str) -> Column:
    """Trim a raw text field and turn the null tokens into real nulls."""
    text = F.trim(as_column(column))
    return F.when(~text.isin(NULL_TOKENS), text)


def lower_text(column: Column | str) -> Column:
    return F.lower(F.trim(as_column(column)))


def upper_text(column: Column | str) -> Column:
    return F.upper(F.trim(as_column(column)))


def payload_value(payload: Column | str, key: str, datatype: str) -> Column:
    """Typed value of one top-level key of a variant payload, null if absent or unfit."""
    return F.try_variant_get(as_column(payload), f"$.{key}", datatype)


def quoted(name: str) -> str:
    """A column name as it stands in expressions, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
