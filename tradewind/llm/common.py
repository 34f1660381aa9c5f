"""Shared folder, stored intermediate tables and Arrow text helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one NumPy step inside a task works on.
STEP_BYTES = 4 << 20
#: Bytes of an Arrow batch on its way to a Python worker; rows alone don't bound it.
BATCH_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; only a local session may use one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tradewind-llm-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def work_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


#: Lets Spark delete the shuffle files of a query as soon as the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffles of queries begun and ended in here go with them."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there: cuts lineage, keeps pruning.

    Nothing reads the shuffles behind the written files again, so they go when the write ends.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`stored` wrote for ``tables``; nothing may read them, or what is made of them, later."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def read_all(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables that :func:`stored` wrote with one schema; ``tables`` holds them."""
    every = tables[0].sparkSession.read.schema(tables[0].schema).parquet(*(t.stored_at for t in tables))
    every.tables = tables
    return every


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, so that they need not be installed there, and bound Arrow batches; once a session."""
    context = spark.sparkContext
    if not getattr(context, "_tradewind_sent", False):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="tradewind-code-")) / "tradewind_modules.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        context._tradewind_sent = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``size`` bytes of text; a row is never cut."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(np.asarray(lengths(texts)))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, base + size, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def lengths(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes per row, 0 for null."""
    _, starts, ends = utf8(texts)
    return ends - starts


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text bytes of a column, and where each row starts and ends in them; null rows are empty."""
    wide = texts.cast(pa.large_string())
    if wide.null_count:
        wide = wide.fill_null("")
    _, borders, data = wide.buffers()
    borders = np.frombuffer(borders, np.int64, len(wide) + 1, wide.offset * 8) if borders else np.zeros(len(wide) + 1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data, borders[:-1], borders[1:]
