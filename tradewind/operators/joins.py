"""Equi-joins that survive a key holding a large share of the left rows."""

from __future__ import annotations

import re
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLITS = 64
SUPPORT = 0.01
_UNITS = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30}


def broadcast_limit(spark: SparkSession) -> int:
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).lower()
    match = re.fullmatch(r"(-?\d+)([bkmg]?)b?", text)
    return int(match.group(1)) * _UNITS[match.group(2)] if match else 0


def estimated_size(df: DataFrame) -> int:
    """Size in bytes the optimizer expects; the same figure its broadcast rule looks at."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class HotKeys:
    """Every key above a ``support`` share of the rows of ``df``, and maybe some below it.

    Found when first asked for, in one pass over one column without a shuffle; never more than
    ``1 / support`` entries. One object serves all joins on the same key, and its ``df`` may be the
    raw table a join's left side is built from.
    """

    def __init__(self, df: DataFrame, key: str, support: float = SUPPORT):
        self._rows = df.select(key).filter(F.col(key).isNotNull())
        self._key, self._support = key, support

    @cached_property
    def keys(self) -> list:
        found = self._rows.freqItems([self._key], self._support).first()
        return list(found[0] or [])


def one_of(column: str, values: list) -> Column:
    """``column in values`` for texts, numbers and dates, parsed as one expression."""
    if not values:
        return F.lit(False)

    def literal(value) -> str:
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        if isinstance(value, date):
            kind = "timestamp_ntz" if isinstance(value, datetime) else "date"
            return f"{kind}'{value}'"
        return str(value)

    return F.expr(f"`{column}` in ({', '.join(literal(v) for v in values)})")


def join_on_hot_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    spread_by: str | list[str] | None = None,
    condition: Column | None = None,
    hot: HotKeys | None = None,
    splits: int = SPLITS,
) -> DataFrame:
    """Join on ``key`` (plus ``condition``), spreading hot and null left keys over ``splits``.

    A right side under the session's broadcast threshold is left to the optimizer, which broadcasts
    it. Beyond that size the left rows of hot keys get a salt taken from ``spread_by`` and only the
    right rows of those keys (at most ``1 / support`` of them) are repeated per salt. The salt is a
    hash of row values, so recomputing a lost task gives the same rows. ``hot`` saves looking for hot
    keys in ``left`` itself. ``how`` is one of inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    matched = right.withColumnRenamed(key, "_right_key")
    on = F.col(key) == F.col("_right_key")
    if condition is not None:
        on = on & condition
    small = estimated_size(right) <= broadcast_limit(left.sparkSession)
    if small:
        return left.join(matched, on, how).drop("_right_key")

    names = [spread_by] if isinstance(spread_by, str) else (spread_by or left.columns)
    spread = F.pmod(F.xxhash64(*names), F.lit(splits)).cast("int")
    keys = (hot or HotKeys(left, key)).keys
    every = F.sequence(F.lit(0), F.lit(splits - 1))
    left_salt = F.when(F.col(key).isNull() | one_of(key, keys), spread).otherwise(0)
    right_salts = F.when(one_of("_right_key", keys), every).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("_salt", left_salt)
    salted_right = matched.filter(F.col("_right_key").isNotNull()).withColumn(
        "_right_salt", F.explode(right_salts)
    )
    joined = salted_left.join(salted_right, on & (F.col("_salt") == F.col("_right_salt")), how)
    return joined.drop("_salt", "_right_salt", "_right_key")
