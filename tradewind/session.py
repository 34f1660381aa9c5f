"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Shuffle partition counts are left to the
# cluster; adaptive execution coalesces them downwards.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "tradewind", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder named in ``spark.checkpoint.dir``; only local runs may fall back to /tmp."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tradewind-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there, whole or by column."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held.staged_at = path
    return held


def unstage(spark: SparkSession, *paths: str) -> None:
    """Delete what :func:`stage` wrote; nothing may read it later."""
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def side_by_side(spark: SparkSession, work: Callable, items: list) -> list:
    """``work`` on every item from a thread of its own, so independent jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=max(len(items), 1)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
