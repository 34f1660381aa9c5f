"""Keyed merge of a delta into a target, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_padded(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both; columns of ``first`` then the new ones of ``second``, missing ones null."""
    return first.unionByName(second, allowMissingColumns=True)


def new_columns(known: DataFrame, incoming: DataFrame) -> list[str]:
    have = {c.lower() for c in known.columns}
    return [c for c in incoming.columns if c.lower() not in have]


def upsert(target: DataFrame, delta: DataFrame, key: str | list[str]) -> DataFrame:
    """Delta rows replace target rows of the same key or are added; other target rows stay.

    Columns only the delta has are appended, null for untouched rows. Keys of the delta must be
    unique.
    """
    kept = target.join(delta, [key] if isinstance(key, str) else key, "left_anti")
    return union_padded(kept, delta)


def is_newer(version: str) -> Column:
    """A delta row's ``version`` displaces ``_held``: a later or equal one, or any if none is held."""
    return F.coalesce(F.col(version) >= F.col("_held"), F.col("_held").isNull())


def upsert_if_newer(target: DataFrame, delta: DataFrame, key: str, version: str) -> DataFrame:
    """Upsert that lets an older re-delivery lose: the row with the later ``version`` wins.

    A delta row wins a tie, and a version that is present beats one that is absent.
    """
    existing = target.select(key, F.col(version).alias("_held")).withColumn("_known", F.lit(True))
    newer = (
        delta.join(existing, key, "left")
        .filter(F.col("_known").isNull() | is_newer(version))
        .drop("_held", "_known")
    )
    return upsert(target, newer, key)


def merge_columns(
    target: DataFrame, source: DataFrame, keys: list[str], when_matched: dict[str, Column]
) -> DataFrame:
    """Insert unknown keys whole; for known keys change only the ``when_matched`` columns.

    Expressions in ``when_matched`` refer to source columns by a ``src_`` prefix.
    """
    renamed = source.select(*[F.col(c).alias(f"src_{c}") for c in source.columns])
    on = [F.col(k).eqNullSafe(F.col(f"src_{k}")) for k in keys]
    known = target.withColumn("_in_target", F.lit(True))
    offered = renamed.withColumn("_in_source", F.lit(True))
    joined = known.join(offered, on, "full_outer")
    held = F.col("_in_target").isNotNull()
    both = held & F.col("_in_source").isNotNull()
    columns = []
    for name in target.columns:
        fresh = F.col(f"src_{name}") if name in source.columns else F.lit(None)
        value = F.when(~held, fresh)
        if name in when_matched:
            value = value.when(both, when_matched[name])
        columns.append(value.otherwise(F.col(name)).cast(target.schema[name].dataType).alias(name))
    return joined.select(*columns)
