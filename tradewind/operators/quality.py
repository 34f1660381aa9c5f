"""Data checks: failing rows, counted results, freshness and the gate."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.dedup import duplicate_keys
from tradewind.operators.joins import HotKeys, join_on_hot_key

RESULT_SCHEMA = (
    "run_id string, model_name string, test_name string, test_column string, status string, "
    "failures bigint, severity string, tested_at timestamp_ntz, environment string"
)


class GateError(RuntimeError):
    """A check of severity error failed; the layers behind it must not be built."""


@dataclass(frozen=True)
class Check:
    """One declared check on ``table.column``.

    ``kind`` is one of not_null, unique, accepted_values, between, relationships, pair_ge,
    row_count or a name of ``custom``: a function from all tables to failing rows.
    """

    table: str
    kind: str
    column: str | None = None
    severity: str = "error"
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    to: tuple[str, str] | None = None
    custom: object = None

    @property
    def name(self) -> str:
        parts = [self.kind, self.table, self.column or ""]
        return "_".join(p for p in parts if p)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bad_row(check: Check) -> str | None:
    """SQL condition of a failing row, for the kinds that look at one row at a time."""
    column = f"`{check.column}`"
    if check.kind == "not_null":
        return f"{column} is null"
    if check.kind == "accepted_values":
        return f"{column} not in ({', '.join(_text(v) for v in check.values)})"
    if check.kind == "between":
        limits = [] if check.low is None else [f"{column} < {check.low}"]
        limits += [] if check.high is None else [f"{column} > {check.high}"]
        return " or ".join(limits)
    if check.kind == "pair_ge":
        return f"{column} < `{check.to[1]}`"
    return None


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key the parent does not hold."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return join_on_hot_key(child.filter(F.col(column).isNotNull()), keys, column, "left_anti")


def row_count_failure(df: DataFrame, low: int | None, high: int | None) -> DataFrame:
    """One row with the count when it is out of range, else none."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col("row_count") < low)
    if high is not None:
        bad = bad | (F.col("row_count") > high)
    return counted.filter(bad)


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows (or keys, for unique) that violate a check."""
    if check.custom is not None:
        return check.custom(tables)
    df = tables[check.table]
    condition = bad_row(check)
    if condition is not None:
        return df.filter(condition)
    if check.kind == "unique":
        return duplicate_keys(df.filter(F.col(check.column).isNotNull()), check.column)
    if check.kind == "relationships":
        return orphans(df, check.column, tables[check.to[0]], check.to[1])
    if check.kind == "row_count":
        return row_count_failure(df, check.low, check.high)
    raise ValueError(f"unknown check {check.kind}")


def _label(check: Check) -> str:
    column = _text(check.column) if check.column else "cast(null as string)"
    return (
        f"{_text(check.table)} as model_name, {_text(check.kind)} as test_name, "
        f"{column} as test_column, {_text(check.severity)} as severity"
    )


def count_failures(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check with its number of failures.

    All row-level checks of a table share one scan of it.
    """
    per_row = defaultdict(list)
    rest = []
    for check in checks:
        single = check.custom is None and bad_row(check) is not None
        (per_row[check.table] if single else rest).append(check)
    counted = []
    for table, group in per_row.items():
        counts = [F.expr(f"count_if({bad_row(c)})").alias(f"c{i}") for i, c in enumerate(group)]
        rows = ", ".join(f"struct({_label(c)}, c{i} as failures)" for i, c in enumerate(group))
        counted.append(tables[table].agg(*counts).selectExpr(f"inline(array({rows}))"))
    for check in rest:
        total = failing_rows(check, tables).agg(F.count(F.lit(1)).alias("failures"))
        counted.append(total.selectExpr(f"inline(array(struct({_label(check)}, failures)))"))
    return reduce(DataFrame.unionByName, counted).withColumn("status", F.expr(
        "case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'error' end"
    ))


def result_rows(counted: DataFrame, run_id: str, environment: str, tested_at: datetime) -> DataFrame:
    """Counted checks in the shape of the result log."""
    return counted.select(
        F.lit(run_id).alias("run_id"), "model_name", "test_name", "test_column", "status", "failures",
        "severity", F.lit(tested_at).cast("timestamp_ntz").alias("tested_at"),
        F.lit(environment).alias("environment"),
    )


def run_checks(
    spark: SparkSession, checks: list[Check], tables: dict[str, DataFrame], run_id: str,
    store: str, environment: str = "dev", tested_at: datetime | None = None,
) -> list:
    """Count failures, store the failing rows of each failed check and append the result log.

    Returns the result rows, one per declared check.
    """
    at = tested_at or datetime.now(timezone.utc).replace(tzinfo=None)
    results = result_rows(count_failures(checks, tables), run_id, environment, at).collect()
    failed = {(r["model_name"], r["test_name"], r["test_column"]) for r in results if r["failures"]}
    for check in checks:
        if (check.table, check.kind, check.column) in failed:
            rows = failing_rows(check, tables)
            rows.write.mode("overwrite").parquet(f"{store}/failures/{check.name}")
    log = spark.createDataFrame(results, RESULT_SCHEMA)
    log.coalesce(1).write.mode("append").parquet(f"{store}/results")
    return results


def gate(results: list) -> None:
    """Raise if any check of severity error failed."""
    broken = [
        f"{r['test_name']}({r['model_name']}.{r['test_column']}): {r['failures']}"
        for r in results if r["status"] == "error"
    ]
    if broken:
        raise GateError("; ".join(sorted(broken)))


def freshness(
    df: DataFrame, source: str, loaded_at: str, as_of: datetime,
    warn_hours: int = 12, error_hours: int = 24,
) -> DataFrame:
    """Age of the newest row against both limits; a source without rows is an error."""
    now = F.lit(as_of).cast("timestamp_ntz")
    newest = F.col("max_loaded_at")

    def older_than(hours: int) -> Column:
        return newest < F.lit(as_of - timedelta(hours=hours)).cast("timestamp_ntz")

    status = (
        F.when(newest.isNull() | older_than(error_hours), "error")
        .when(older_than(warn_hours), "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(loaded_at).alias("max_loaded_at")).select(
        F.lit(source).alias("source"),
        "max_loaded_at",
        F.timestamp_diff("HOUR", newest, now).alias("age_hours"),
        status.alias("status"),
    )


def orphan_orders(
    facts: DataFrame, customers: DataFrame, as_of: datetime, hours: int = 6,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Orders without a customer row, older than ``hours`` before the start of ``as_of``'s day."""
    day = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    cutoff = F.lit(day - timedelta(hours=hours)).cast("timestamp_ntz")
    old = facts.filter(F.col("order_date_day").cast("timestamp_ntz") < cutoff)
    known = customers.select("customer_sk")
    lost = join_on_hot_key(old, known, "customer_sk", "left_anti", spread_by="order_id", hot=hot)
    return lost.select("order_id", "customer_id", "order_date_day", "order_status")


def revenue_mismatch(
    facts: DataFrame, items: DataFrame, header: str = "revenue_usd", percent: int = 5, floor: int = 1
) -> DataFrame:
    """Completed orders whose header differs from the line sum by > ``percent`` and > ``floor``.

    ``header`` may name ``order_amount_usd`` to compare the delivered header amount instead.
    """
    heads = facts.filter("is_completed").select("order_id", F.col(header).alias("header_revenue_usd"))
    sums = items.groupBy("order_id").agg(F.sum("line_total_usd").alias("computed_revenue_usd"))
    joined = heads.join(sums, "order_id", "left")
    gap = F.abs(F.col("header_revenue_usd") - F.coalesce("computed_revenue_usd", F.lit(0)))
    head = F.col("header_revenue_usd")
    share = F.col("abs_diff").cast("double") / head.cast("double") * 100
    # The limits are compared as exact decimals; the percentage is for the reader.
    beyond = (F.col("abs_diff") * 100 > head * percent) & (F.col("abs_diff") > floor)
    return (
        joined.withColumn("abs_diff", gap)
        .filter((head > 0) & beyond)
        .withColumn("pct_diff", share)
    )


def date_anomalies(orders: DataFrame) -> DataFrame:
    return orders.filter("is_date_anomaly")
