"""Calendar attributes of a date and differences between moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.keys import as_column


def month_start(column: Column | str) -> Column:
    return F.trunc(as_column(column), "MM")


def year_start(column: Column | str) -> Column:
    return F.trunc(as_column(column), "YYYY")


def day_of_week(column: Column | str) -> Column:
    """Sunday is 0, Saturday is 6."""
    return F.dayofweek(as_column(column)) - 1


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start))


def clock_hours_between(start: Column | str, end: Column | str) -> Column:
    """Hour boundaries crossed: both ends are cut to the hour before subtracting."""
    return F.timestamp_diff(
        "HOUR", F.date_trunc("hour", as_column(start)), F.date_trunc("hour", as_column(end))
    )


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff(
        "SECOND", F.date_trunc("second", as_column(start)), F.date_trunc("second", as_column(end))
    )
