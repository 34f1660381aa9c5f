"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: str | list[str], order: list[Column]) -> DataFrame:
    """First row per key under ``order``; rows with a null key are refused before the shuffle.

    The filter sits directly on the row number, so the plan carries a partial window limit ahead of
    the exchange: a key holding a third of all rows sends at most one row per input task.
    """
    names = [keys] if isinstance(keys, str) else keys
    for name in names:
        df = df.filter(F.col(name).isNotNull())
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*names).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def duplicate_keys(df: DataFrame, keys: str | list[str], count_name: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    names = [keys] if isinstance(keys, str) else keys
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias(count_name))
    return counted.filter(F.col(count_name) > 1)


def refuse_duplicates(df: DataFrame, keys: str | list[str], what: str) -> None:
    """Raise if ``keys`` are not unique; only one offending key reaches the driver."""
    offender = duplicate_keys(df, keys).limit(1).collect()
    if offender:
        raise ValueError(f"{what}: key {keys} is not unique, e.g. {offender[0].asDict()}")
