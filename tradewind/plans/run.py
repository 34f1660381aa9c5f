"""One run over stored layers: load, stage, check, snapshot, build marts, check, freshness."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.audit import with_model_audit
from tradewind.operators.dedup import refuse_duplicates
from tradewind.operators.history import history_step
from tradewind.operators.joins import HotKeys
from tradewind.operators.lookback import DEFAULT_DAYS, high_mark, too_old
from tradewind.operators.quality import freshness, gate, run_checks
from tradewind.plans import checks, intermediate, marts, staging
from tradewind.session import cut_lineage, side_by_side
from tradewind.sources import seeds
from tradewind.sources.ingest import FORMATS, RawZone, ingest, utc_now
from tradewind.sources.landing import entity_sources
from tradewind.sources.tables import StoredTable

FACT_COMMENT = "Orders with amounts, flags and keys; order_sk is unique, and later runs merge by it."


@dataclass
class RunConfig:
    """Parameters of one run."""

    run_id: str
    run_ts: datetime = field(default_factory=utc_now)
    full_refresh: bool = False
    lookback_days: int = DEFAULT_DAYS
    start_date: date = intermediate.ALL_DATES[0]
    end_date: date = intermediate.ALL_DATES[1]
    touch_late_lines: bool = False
    best_is_high: bool = False
    environment: str = "dev"
    stop_on_error: bool = True


# Model, key, and whether rows carry model audit columns, per staged entity.
STAGED: dict[str, tuple[Callable, str, bool]] = {
    "orders": (staging.stg_orders, "order_id", True),
    "customers": (staging.stg_customers, "customer_id", True),
    "order_items": (staging.stg_order_items, "order_item_id", False),
    "products": (staging.stg_products, "product_id", True),
}


class Warehouse:
    """Stored layers under one root, and the steps that bring them up to date."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.raw = RawZone(spark, f"{self.root}/raw_zone")

    def _table(self, layer: str, name: str, partition: str | None = None, cluster=None) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/{layer}/{name}", partition, cluster)

    def staged(self, entity: str) -> StoredTable:
        # Deliveries come in order of time, so a merge touches few load dates of the big tables.
        if entity in ("orders", "order_items"):
            return self._table("staging", entity, "_loaded_date")
        return StoredTable(self.spark, f"{self.root}/staging/{entity}", bucket_by=STAGED[entity][1])

    def snapshot(self) -> StoredTable:
        return self._table("snapshots", "customers", "is_open")

    def dim_customers(self) -> StoredTable:
        return self._table("marts", "dim_customers", None, ["customer_id", "country_code"])

    def dim_products(self) -> StoredTable:
        return self._table("marts", "dim_products", None, ["category", "is_active"])

    def fct_orders(self) -> StoredTable:
        return self._table("marts", "fct_orders", "order_month", ["order_date_day", "customer_sk"])

    # --- steps -----------------------------------------------------------------------------------

    def load(self, landing: str, config: RunConfig) -> list[dict]:
        sources = entity_sources(landing, FORMATS)
        return ingest(self.raw, list(sources.values()), config.run_id, config.run_ts)

    def stage(self, entity: str, config: RunConfig) -> int:
        """Merge new raw rows into a staging table; returns the raw rows left out as too old."""
        model, key, audited = STAGED[entity]
        table, raw = self.staged(entity), self.raw.read(entity)
        fresh = config.full_refresh or not table.exists()
        mark = None if fresh else high_mark(table.read(), "_raw_loaded_at")
        rows = model(raw, mark, config.lookback_days)
        if audited:
            rows = with_model_audit(rows, f"stg_{entity}", "staging", config.run_id, config.run_ts)
        if table.partition_by:
            rows = rows.withColumn("_loaded_date", F.to_date("_raw_loaded_at"))
        if fresh:
            table.overwrite(rows)
            return 0
        table.upsert(rows, key)
        return too_old(raw, "_loaded_at", mark, config.lookback_days).count()

    def take_snapshot(self, config: RunConfig) -> None:
        table = self.snapshot()
        source = self.staged("customers").read().select(*marts.SNAPSHOT_COLUMNS)
        refuse_duplicates(source, "customer_id", "snapshot source")
        step = dict(key="customer_id", updated_at="customer_updated_at", run_ts=config.run_ts)
        if not table.exists():
            versions = history_step(None, source, **step)
            table.overwrite(versions.withColumn("is_open", F.col("valid_to").isNull()))
            return
        opened = table.read(["is_open=true"]).drop("is_open")
        closed = table.read(["is_open=false"])
        versions = history_step(opened, source, closed_rows=closed, **step)
        # The open part is replaced; versions closed now join the closed part, which stays as it is.
        table.replace(versions.withColumn("is_open", F.col("valid_to").isNull()), ["true"])

    def enriched(self) -> tuple[DataFrame, HotKeys]:
        orders = self.staged("orders").read()
        hot = HotKeys(orders, "customer_id")
        customers, items = self.staged("customers").read(), self.staged("order_items").read()
        return intermediate.int_orders(orders, customers, items, hot), hot

    def build_marts(self, config: RunConfig) -> None:
        rows, hot = self.enriched()
        table = self.fct_orders()
        fresh = config.full_refresh or not table.exists()
        if fresh:
            # Both marts need every order now; otherwise the fact reads only its increment.
            rows = cut_lineage(rows)
        value = intermediate.int_lifetime_value(
            rows, config.run_ts.date(), config.start_date, config.end_date, config.best_is_high
        )
        snapshot = self.snapshot().read(["is_open=true"])
        customers = marts.dim_customers(snapshot, value)
        self.dim_customers().overwrite(
            customers.withColumn("_model_updated_at", F.lit(config.run_ts).cast("timestamp_ntz"))
        )
        products = marts.dim_products(self.staged("products").read(), seeds.product_categories(self.spark))
        self.dim_products().overwrite(
            products.withColumn("_model_updated_at", F.lit(config.run_ts).cast("timestamp_ntz"))
        )
        mark = None if fresh else high_mark(table.read(), "_raw_loaded_at")
        late = self.staged("order_items").read() if config.touch_late_lines else None
        facts = marts.fct_orders(
            rows, self.dim_customers().read(), mark, config.lookback_days, late, hot
        ).withColumn("_model_updated_at", F.lit(config.run_ts).cast("timestamp_ntz"))
        if fresh:
            table.overwrite(facts, FACT_COMMENT)
        else:
            table.upsert(facts, "order_sk")

    def tables(self, marts_too: bool = True) -> dict[str, DataFrame]:
        found = {f"raw_{e}": self.raw.read(e) for e in STAGED}
        found |= {f"stg_{e}": self.staged(e).read() for e in STAGED}
        if marts_too:
            found["fct_orders"] = self.fct_orders().read()
            found["dim_customers"] = self.dim_customers().read()
            found["dim_products"] = self.dim_products().read()
        return found

    def check(self, layer: str, config: RunConfig) -> list:
        """Run a layer's checks, store failures and results, and stop the run on an error."""
        declared = {
            "staging": checks.SOURCE_CHECKS + checks.STAGING_CHECKS,
            "marts": checks.MART_CHECKS + checks.singular_checks(config.run_ts),
        }[layer]
        results = run_checks(
            self.spark, declared, self.tables(layer == "marts"), config.run_id, f"{self.root}/checks",
            config.environment, config.run_ts,
        )
        if config.stop_on_error:
            gate(results)
        return results

    def source_freshness(self, as_of: datetime) -> list:
        return [
            freshness(self.raw.read(e), f"raw_{e}", "_loaded_at", as_of).first() for e in STAGED
        ]

    def run(self, landing: str, config: RunConfig) -> dict:
        """Everything in order; a failed check of severity error ends the run there."""
        loads = self.load(landing, config)
        counts = side_by_side(self.spark, lambda entity: self.stage(entity, config), list(STAGED))
        skipped = dict(zip(STAGED, counts))
        results = self.check("staging", config)
        self.take_snapshot(config)
        self.build_marts(config)
        results += self.check("marts", config)
        return {
            "loads": loads,
            "rows_too_old": skipped,
            "checks": results,
            "freshness": self.source_freshness(config.run_ts),
        }
