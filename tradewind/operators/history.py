"""Type 2 history: versions of a row with validity intervals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.casts import quoted
from tradewind.operators.joins import HotKeys, broadcast_limit, estimated_size, join_on_hot_key, one_of

VERSION_COLUMNS = ["version_id", "version_updated_at", "valid_from", "valid_to"]


def _version_id(key: str) -> F.Column:
    start = F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), start))


def history_step(
    open_rows: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str,
    run_ts: datetime,
    check_columns: list[str] | None = None,
    hard_deletes: bool = True,
    closed_rows: DataFrame | None = None,
) -> DataFrame:
    """Versions after one run: kept and newly opened ones (``valid_to`` null) and just-closed ones.

    A row changes when its ``updated_at`` is later than the stored one, or, with ``check_columns``,
    when any of those differs. A changed row closes at the new update time (at the run time under
    ``check_columns``), a key missing from the source closes at the run time. Only open versions
    are matched; ``closed_rows`` is looked at for keys that come back, whose new version must not
    begin before the last one ended. Keys of ``source`` must be unique.
    """
    now = F.lit(run_ts).cast("timestamp_ntz")
    stamp = now if check_columns else F.coalesce(F.col(updated_at).cast("timestamp_ntz"), now)
    fresh = source.withColumns({"version_updated_at": stamp, "valid_from": stamp})
    if closed_rows is not None:
        ended = closed_rows.groupBy(key).agg(F.max("valid_to").alias("_ended"))
        returning = fresh.join(ended, key, "left")
        fresh = returning.withColumn("valid_from", F.greatest("valid_from", "_ended")).drop("_ended")
    fresh = fresh.withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    fresh = fresh.withColumn("version_id", _version_id(key))
    columns = [c for c in source.columns if c != key]
    layout = [key, *columns, *VERSION_COLUMNS]
    if open_rows is None:
        return fresh.select(*layout)

    new = fresh.select(key, F.struct(*layout).alias("_new"))
    old = open_rows.select(key, F.struct(*layout).alias("_old"))
    if check_columns:
        differs = [~F.col(f"_new.{c}").eqNullSafe(F.col(f"_old.{c}")) for c in check_columns]
        changed = F.array_contains(F.array(*differs), True)
    else:
        changed = F.coalesce(
            F.col(f"_new.{updated_at}").cast("timestamp_ntz") > F.col("_old.version_updated_at"),
            F.lit(False),
        )
    joined = old.join(new, key, "full_outer")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    replaced = has_old & has_new & changed
    # A version never closes before it began.
    closing = F.when(replaced, F.greatest("_new.valid_from", "_old.valid_from"))
    if hard_deletes:
        closing = closing.when(has_old & ~has_new, F.greatest(now, F.col("_old.valid_from")))
    stored = F.when(has_old, F.col("_old").withField("valid_to", closing))
    opened = F.when(has_new & (~has_old | replaced), F.col("_new"))
    versions = joined.select(F.explode(F.array_compact(F.array(stored, opened))).alias("v"))
    return versions.select("v.*")


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col("valid_to").isNull())


#: With no more versions of a key than this, a small table of versions is joined as it is.
FEW_VERSIONS = 16
SLICES = 64


def version_at(
    facts: DataFrame, versions: DataFrame, key: str, moment: str, how: str = "left",
    spread_by: str | list[str] | None = None, hot: HotKeys | None = None,
) -> DataFrame:
    """As-of join: the version with ``valid_from <= moment < valid_to`` (open ends count).

    Intervals of one key must not overlap. ``valid_from`` and ``valid_to`` of the version stay in the result.
    Facts without key or moment match nothing; ``how`` is left or inner. A broadcast is made only of a table of versions that
    is under the session's threshold and holds few versions of each key; otherwise facts and versions are merged by time.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how}")
    if estimated_size(versions) <= broadcast_limit(facts.sparkSession):
        most = versions.groupBy(key).count().agg(F.max("count")).first()[0] or 0
        if most <= FEW_VERSIONS:
            at = F.col(moment).cast("timestamp_ntz")
            inside = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
            return join_on_hot_key(facts, versions, key, how, spread_by, inside, hot)
    return _merged_by_time(facts, versions, key, moment, how, spread_by, hot or HotKeys(facts, key))


def _borders(facts: DataFrame, key: str, keys: list) -> DataFrame | None:
    """Moments that cut the facts of each hot key into :data:`SLICES` slices; at most one row per hot key."""
    if not keys:
        return None
    shares = F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)])
    micros = F.unix_micros(F.col("_at").cast("timestamp"))
    cut = F.percentile_approx(micros, shares, 10_000).alias("_cuts")
    rows = facts.filter(one_of(key, keys) & F.col("_at").isNotNull()).groupBy(key).agg(cut)
    return F.broadcast(rows.withColumnRenamed(key, "_cut_key"))


def _merged_by_time(facts, versions, key, moment, how, spread_by, hot) -> DataFrame:
    """Facts and versions in one order of time per key, the last version carried forward to the facts after it.

    A hot key is cut into slices of time of about equal numbers of facts. A version goes to every slice
    its interval meets, so each slice is merged alone; a moment that holds several borders is dealt to
    all slices that it closes or opens. Work is linear in facts and versions.
    """
    names = [spread_by] if isinstance(spread_by, str) else (spread_by or facts.columns)
    spread = F.xxhash64(*[F.col(quoted(n)) for n in names])
    keys = hot.keys
    left = facts.withColumn("_at", F.col(moment).cast("timestamp_ntz"))
    held = [c for c in versions.columns if c != key]
    right = versions.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        key, F.col("valid_from").cast("timestamp_ntz").alias("_at"), F.col("valid_to").cast("timestamp_ntz").alias("_until"),
        F.struct(*[F.col(quoted(c)) for c in held]).alias("_version"),
    )
    borders = _borders(left, key, keys)
    low = lambda at: F.size(F.filter("_cuts", lambda b: b < F.unix_micros(at.cast("timestamp"))))
    high = lambda at: F.size(F.filter("_cuts", lambda b: b <= F.unix_micros(at.cast("timestamp"))))
    at, until = F.col("_at"), F.col("_until")
    alone = F.col(key).isNull() | at.isNull()
    if borders is None:
        own, every = F.lit(0), F.array(F.lit(0))
    else:
        left = left.join(borders, F.col(key) == F.col("_cut_key"), "left").drop("_cut_key")
        right = right.join(borders, F.col(key) == F.col("_cut_key"), "left").drop("_cut_key")
        own = F.when(F.col("_cuts").isNull(), 0).otherwise(
            low(at) + F.pmod(spread, (high(at) - low(at) + 1).cast("bigint")).cast("int"))
        last = F.when(until.isNull(), F.lit(SLICES - 1)).otherwise(F.greatest(low(until), low(at)))
        every = F.when(F.col("_cuts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(low(at), last))
    # Rows that match nothing need no order; they are dealt out evenly.
    slot = F.when(alone, F.pmod(spread, F.lit(SLICES)).cast("int")).otherwise(own).alias("_slot")
    first = left.select(*[F.col(quoted(c)) for c in facts.columns], "_at", slot, F.lit(True).alias("_is_fact"))
    second = right.select(key, "_at", "_until", "_version", F.explode(every).alias("_slot"), F.lit(False).alias("_is_fact"))
    order = Window.partitionBy(key, "_slot").orderBy("_at", "_is_fact", F.col("_until").asc_nulls_last())
    carried = F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = first.unionByName(second, allowMissingColumns=True).withColumn("_carried", carried).filter("_is_fact")
    ends = F.col("_carried.valid_to")
    fits = ~F.col("_carried").isNull() & ~alone & (ends.isNull() | (at < ends))
    rows = rows.withColumn("_carried", F.when(fits, F.col("_carried")))
    if how == "inner":
        rows = rows.filter(F.col("_carried").isNotNull())
    return rows.select(*[F.col(quoted(c)) for c in facts.columns], *[F.col(f"_carried.{quoted(c)}").alias(c) for c in held])
