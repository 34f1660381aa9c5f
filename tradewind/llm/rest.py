"""Values of keys beyond those of a learnt table that tasks hold in memory, joined to the texts by Spark.

What a text takes from such a table is a sum over its keys. Tasks add up the keys they hold; the keys of the
rest are found in the texts here, and their values summed per text. Both together give the sum over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.bitmap import bitmap, held
from tradewind.llm.common import steps, stored

#: Sums are whole numbers of this many parts, so that they don't depend on the order of the rows.
PARTS = 1e9
TEXT_KEY = ["__text_a", "__text_b"]


def text_key(text: Column) -> list[Column]:
    """Two hashes that stand for a text; equal texts have equal sums."""
    return [F.xxhash64(text).alias(TEXT_KEY[0]), F.xxhash64(F.lit(1), text).alias(TEXT_KEY[1])]


def sums(
    texts: DataFrame, keys_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], rest: DataFrame, width: int,
    step: int,
) -> DataFrame:
    """The hashes of each text in ``text`` that has a key of ``rest`` (key long, value of ``width`` doubles), and ``__more``:
    for each value the sum over the text's keys, repeats included, in parts. ``keys_of`` gives keys and their rows."""
    sent = bitmap(rest, "key")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, size=step):
            keys, rows = keys_of(batch.column(2))
            here = held(sent.value, keys.view(np.int64)) if len(keys) else np.zeros(0, bool)
            keys, rows = keys[here], rows[here]
            order = np.lexsort((keys, rows))
            keys, rows = keys[order], rows[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows[at])), batch.column(1).take(pa.array(rows[at])),
                pa.array(keys[at].view(np.int64)), pa.array(np.diff(np.append(at, len(keys)))),
            ], names=[*TEXT_KEY, "key", "n"])

    chosen = texts.filter("text is not null").select(*text_key(F.col("text")), "text")
    found = chosen.mapInArrow(find, f"{TEXT_KEY[0]} long, {TEXT_KEY[1]} long, key long, n long")
    once = found.groupBy(*TEXT_KEY, "key").agg(F.max("n").alias("n"))  # copies of a text count once
    values = [F.sum(F.round(F.col("value")[i] * F.col("n") * PARTS).cast("long")) for i in range(width)]
    return stored(once.join(rest, "key").groupBy(*TEXT_KEY).agg(F.array(*values).alias("__more")), "rest")
