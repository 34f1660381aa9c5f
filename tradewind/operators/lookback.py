"""Incremental predicate on load time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
DEFAULT_DAYS = 3


def high_mark(target: DataFrame | None, column: str) -> datetime:
    """Latest load time in the target, the epoch for an empty or missing one."""
    if target is None:
        return EPOCH
    return target.agg(F.max(column).cast("timestamp_ntz")).first()[0] or EPOCH


def since(df: DataFrame, column: str, mark: datetime | None, days: int = DEFAULT_DAYS) -> DataFrame:
    """Rows loaded no earlier than ``days`` before the mark; everything when there is no mark.

    The mark is a literal, so the predicate reaches the Parquet scan.
    """
    if mark is None:
        return df
    return df.filter(F.col(column) >= F.lit(mark - timedelta(days=days)).cast("timestamp_ntz"))


def too_old(df: DataFrame, column: str, mark: datetime, days: int = DEFAULT_DAYS) -> DataFrame:
    """The rows ``since`` leaves out, so a run can report how many it skipped."""
    start = F.lit(mark - timedelta(days=days)).cast("timestamp_ntz")
    return df.filter(~F.coalesce(F.col(column) >= start, F.lit(False)))
