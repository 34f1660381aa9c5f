"""Equal-count buckets over all rows without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tradewind.session import cut_lineage, side_by_side

# monotonically_increasing_id() keeps the partition number above this bit.
_PARTITION_SHIFT = 33


def bucket_starts(rows: int, buckets: int) -> list[int]:
    """Zero-based row offsets at which buckets 2, 3, ... begin; larger buckets come first."""
    size, extra = divmod(rows, buckets)
    starts = [b * size + min(b, extra) for b in range(1, buckets)]
    return [s for s in starts if s < rows]


def bucket_borders(df: DataFrame, key: str, column: str, descending: bool, buckets: int) -> list[Row]:
    """The (value, tie) rows at which buckets 2, 3, ... begin; at most ``buckets - 1`` of them.

    Narrow rows are range-partitioned and sorted, then stored, so the counts per partition and the
    lookup of border rows see one and the same order. Only the counts, one per partition, and the
    border rows reach the driver.
    """
    by_value = F.desc_nulls_last("value") if descending else F.asc_nulls_last("value")
    order = [by_value, F.asc_nulls_first("tie")]
    ranked = cut_lineage(
        df.select(F.col(column).alias("value"), F.col(key).alias("tie"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("position", F.monotonically_increasing_id())
    )
    counts = (
        ranked.groupBy(F.shiftright("position", _PARTITION_SHIFT).alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("position").alias("first"))
        .orderBy("part")
        .collect()
    )
    starts = bucket_starts(sum(c["rows"] for c in counts), buckets)
    wanted, passed = [], 0
    for count in counts:
        here = [s for s in starts if passed <= s < passed + count["rows"]]
        wanted += [count["first"] + s - passed for s in here]
        passed += count["rows"]
    return ranked.filter(F.col("position").isin(wanted)).collect() if wanted else []


def _reached(df: DataFrame, key: str, column: str, descending: bool, border: Row) -> Column:
    """Whether a row sorts at or after a border row."""
    value, tie = F.col(column), F.col(key)
    if border["value"] is None:
        beyond, level = F.lit(False), value.isNull()
    else:
        start = F.lit(border["value"]).cast(df.schema[column].dataType)
        beyond = value.isNull() | (value < start if descending else value > start)
        level = value == start
    if border["tie"] is None:
        after = F.lit(True)
    else:
        after = tie.isNotNull() & (tie >= F.lit(border["tie"]).cast(df.schema[key].dataType))
    return F.coalesce(beyond | (level & after), F.lit(False))


def ntile_scores(
    df: DataFrame, key: str, scores: dict[str, tuple[str, bool]], buckets: int = 5
) -> DataFrame:
    """Add one ``ntile`` column per entry of ``scores``: name -> (column, descending).

    ``key`` must be unique; it breaks ties in ascending order, nulls first. Null values come last.
    The scores find their border rows side by side; scoring is then a plain projection.
    """
    base = cut_lineage(df)

    def borders(name: str) -> list[Row]:
        return bucket_borders(base, key, *scores[name], buckets)

    columns = {}
    for name, found in zip(scores, side_by_side(df.sparkSession, borders, list(scores))):
        score = F.lit(1)
        for border in found:
            score = score + _reached(base, key, *scores[name], border).cast("int")
        columns[name] = score
    return base.withColumns(columns)
