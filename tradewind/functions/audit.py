"""Audit columns added to model and raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(run_ts: object = None) -> Column:
    """The injected run time, or the current one."""
    value = F.current_timestamp() if run_ts is None else F.lit(run_ts)
    return value.cast("timestamp_ntz")


def with_model_audit(
    df: DataFrame, model: str, schema: str = "analytics", run_id: str = "manual", run_ts: object = None
) -> DataFrame:
    return df.withColumns({
        "_model_updated_at": moment(run_ts),
        "_model_run_id": F.lit(run_id),
        "_model_schema": F.lit(schema),
        "_model_name": F.lit(model),
    })


def load_audit(source_file: Column, run_id: str, run_ts: object = None) -> dict[str, Column]:
    return {
        "_loaded_at": moment(run_ts),
        "_source_file": source_file,
        "_ingestion_run_id": F.lit(run_id),
    }
