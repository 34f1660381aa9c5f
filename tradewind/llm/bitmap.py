"""A one-hash Bloom filter of bounded size, filled by Spark and sent to the tasks.

It only spares work: a key that was put in is always found, and what is let through by chance is sorted
out later by an exact join. Its size follows the number of keys up to ``MAX_BITS`` and never beyond.
"""

from __future__ import annotations

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 27
BITS_PER_KEY = 16


def bitmap(keys: DataFrame, column: str, max_bits: int = MAX_BITS) -> Broadcast:
    """The filter of a column of longs that are hashes; null keys are left out."""
    spark = keys.sparkSession
    n = keys.count()
    bits = 1 << max(16, min(max_bits, n * BITS_PER_KEY).bit_length() - 1)
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        keys.filter(F.col(column).isNotNull())
        .select(F.shiftright(place, 6).alias("at"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits"))
    )
    found = words.toArrow()  # at most bits / 64 rows
    table = np.zeros(bits // 64, np.int64)
    table[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return spark.sparkContext.broadcast(table)


def held(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter."""
    place = keys.astype(np.int64, copy=False) & (len(table) * 64 - 1)
    return (table[place >> 6] >> (place & 63)) & 1 == 1
