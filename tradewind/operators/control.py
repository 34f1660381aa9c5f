"""Views over the control tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.calendar import clock_hours_between, seconds_between
from tradewind.operators.dedup import latest_per_key
from tradewind.operators.upsert import merge_columns

REGISTRY_KEY = ["target_database", "target_schema", "target_table", "column_name"]


class RunNotReady(RuntimeError):
    """The latest run of a task is missing or has not succeeded."""


def latest_file_status(log: DataFrame) -> DataFrame:
    """Last event per file; events of one file are ordered by start time, then log id."""
    latest = latest_per_key(log, "file_path", [F.desc_nulls_last("started_at"), F.desc_nulls_last("log_id")])
    return latest.select(
        "file_path", "source_schema", "target_table", "load_status", "rows_loaded", "rows_rejected",
        "completed_at", "error_message",
    )


def files_pending_retry(log: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    """Files whose last state is FAILED and at least ``hours`` clock hours old."""
    now = F.lit(as_of).cast("timestamp_ntz")
    old = clock_hours_between("completed_at", now) >= hours
    return latest_file_status(log).filter((F.col("load_status") == "FAILED") & old)


def new_files(listing: DataFrame, log: DataFrame, target_table: str | None = None) -> DataFrame:
    """Listed files the log does not hold as loaded (into ``target_table``)."""
    loaded = log.filter(F.col("load_status") == "SUCCESS")
    if target_table is not None:
        loaded = loaded.filter(F.col("target_table") == target_table)
    return listing.join(loaded.select("file_path").distinct(), "file_path", "left_anti")


def schema_drift_report(registry: DataFrame) -> DataFrame:
    """Active registered columns, by table and first sighting."""
    return registry.filter("is_active").orderBy("target_table", "first_seen_at", "column_name").select(
        "target_database", "target_schema", "target_table", "column_name", "column_data_type",
        "first_seen_at", "added_via_file",
    )


def merge_registry(registry: DataFrame, seen: DataFrame) -> DataFrame:
    """Known columns get a new last sighting and turn active again; unknown ones are added."""
    matched = {"last_seen_at": F.col("src_last_seen_at"), "is_active": F.lit(True)}
    return merge_columns(registry, seen, REGISTRY_KEY, matched)


def with_run_seconds(task_log: DataFrame) -> DataFrame:
    return task_log.withColumn("execution_seconds", seconds_between("started_at", "completed_at"))


def require_latest_success(
    task_log: DataFrame, task_name: str, as_of: datetime, minutes: int = 30
) -> None:
    """Raise unless the task's latest run of the last ``minutes`` succeeded."""
    start = F.lit(as_of - timedelta(minutes=minutes)).cast("timestamp_ntz")
    latest = (
        task_log.filter((F.col("task_name") == task_name) & (F.col("scheduled_at") >= start))
        .orderBy(F.desc_nulls_last("scheduled_at"), F.desc_nulls_last("started_at"))
        .select("status").limit(1).collect()
    )
    if not latest or latest[0]["status"] != "SUCCEEDED":
        raise RunNotReady(f"{task_name}: {latest[0]['status'] if latest else 'no recent run'}")
