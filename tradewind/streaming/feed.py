"""Append-only change feeds merged into stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradewind.sources.tables import StoredTable


def change_feed(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Rows of files that keep arriving under ``path``; the checkpoint remembers what was read."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def start_upsert(
    stream: DataFrame, model: Callable[[DataFrame], DataFrame], table: str | StoredTable, key: str,
    checkpoint: str, version: str | None = None, every: str | None = None,
):
    """Start merging each micro-batch, run through ``model``, into a table by key.

    ``model`` deduplicates within the batch; the table refuses a batch id it already holds, so a
    replayed batch changes nothing. Without ``every`` (such as ``"15 minutes"``) the query stops
    when all files present at its start are merged.
    """
    spark = stream.sparkSession
    target = StoredTable(spark, table) if isinstance(table, str) else table

    def merge(batch: DataFrame, batch_id: int) -> None:
        target.upsert(model(batch), key, version, batch_id=f"{checkpoint}#{batch_id}")

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    timing = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**timing).start()


def upsert_stream(
    stream: DataFrame, model: Callable[[DataFrame], DataFrame], table: str | StoredTable, key: str,
    checkpoint: str, version: str | None = None,
) -> DataFrame:
    """Merge everything present now and return the table."""
    query = start_upsert(stream, model, table, key, checkpoint, version)
    query.awaitTermination()
    return (StoredTable(stream.sparkSession, table) if isinstance(table, str) else table).read()
