"""Loading of landed files into raw tables: infer, evolve, load what is new, log."""

from __future__ import annotations

import threading
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tradewind.functions.audit import load_audit
from tradewind.functions.casts import quoted
from tradewind.operators.control import latest_file_status, merge_registry, new_files
from tradewind.session import side_by_side
from tradewind.sources.landing import (
    FILE, UNREADABLE, EntitySource, Layout, compare_columns, forget, list_files, look_at, rows_of,
)
from tradewind.sources.tables import StoredTable

AUDIT_SCHEMA = "_loaded_at timestamp_ntz, _source_file string, _ingestion_run_id string, _loaded_date date"
FILE_LOG_SCHEMA = (
    "log_id string, file_name string, file_path string, file_size_bytes bigint, "
    "file_last_modified timestamp_ntz, source_schema string, target_table string, rows_loaded bigint, "
    "rows_rejected bigint, load_status string, error_message string, started_at timestamp_ntz, "
    "completed_at timestamp_ntz, run_id string, _created_at timestamp_ntz, _updated_at timestamp_ntz"
)
REGISTRY_SCHEMA = (
    "registry_id string, target_database string, target_schema string, target_table string, "
    "column_name string, column_data_type string, is_active boolean, first_seen_at timestamp_ntz, "
    "last_seen_at timestamp_ntz, added_via_file string"
)
TASK_LOG_SCHEMA = (
    "execution_id string, task_name string, task_schema string, task_database string, "
    "scheduled_at timestamp_ntz, started_at timestamp_ntz, completed_at timestamp_ntz, status string, "
    "rows_processed bigint, error_message string, query_id string"
)

# Columns of the raw tables as declared before any file is seen.
DECLARED = {
    "orders": "order_id string, customer_id string, order_status string, order_amount decimal(18,2), "
    "order_date date, shipped_date date, payment_method string, billing_country string",
    "customers": "customer_id string, raw_payload variant, email string, phone string, country string, "
    "created_at timestamp_ntz",
    "order_items": "order_item_id string, order_id string, product_id string, quantity decimal(10,0), "
    "unit_price decimal(18,4), discount_pct decimal(5,2)",
    "products": "product_id string, product_name string, category string, brand string, "
    "unit_cost decimal(18,4), list_price decimal(18,4), is_active boolean",
}
FORMATS = {"orders": "csv", "customers": "json", "order_items": "csv", "products": "csv"}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _declared_schema(ddl: str | None) -> T.StructType:
    return T.StructType.fromDDL(ddl) if ddl else T.StructType([])


class RawZone:
    """Raw tables and their control tables under one root."""

    def __init__(self, spark: SparkSession, root: str, database: str = "RAW", schema: str = "ECOMMERCE"):
        self.spark, self.root = spark, root.rstrip("/")
        self.database, self.schema = database, schema
        # Entities load side by side; their small appends to the shared logs take turns.
        self._turn = threading.Lock()
        self._looked_at: dict[EntitySource, dict[tuple, Layout]] = {}

    def target(self, entity: str) -> str:
        return f"{self.database}.{self.schema}.{entity.upper()}"

    def table(self, entity: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/raw/{entity}", "_loaded_date")

    def read(self, entity: str) -> DataFrame:
        return self.table(entity).read()

    # --- control tables --------------------------------------------------------------------------

    def _control(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/control/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def file_log(self) -> DataFrame:
        return self._control("file_log", FILE_LOG_SCHEMA)

    def task_log(self) -> DataFrame:
        return self._control("task_log", TASK_LOG_SCHEMA)

    def _registry(self) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/control/schema_registry")

    def registry(self) -> DataFrame:
        table = self._registry()
        return table.read() if table.exists() else self.spark.createDataFrame([], REGISTRY_SCHEMA)

    def log_task(
        self, task: str, status: str, started_at: datetime, rows: int = 0, error: str | None = None
    ) -> None:
        """Best effort: a log that cannot be written must not hide the failure it reports."""
        row = (None, task, self.schema, self.database, started_at, started_at, utc_now(), status, rows, error, None)
        try:
            events = self.spark.createDataFrame([row], TASK_LOG_SCHEMA)
            events = events.withColumn("execution_id", F.expr("uuid()"))
            with self._turn:
                events.coalesce(1).write.mode("append").parquet(f"{self.root}/control/task_log")
        except Exception:  # noqa: BLE001
            pass

    def _log_files(
        self, files: DataFrame, entity: str, status: str, run_id: str, started: datetime,
        loaded: Column | None = None, rejected: Column | None = None, error: Column | None = None,
    ) -> None:
        nothing = F.lit(None)
        now = F.lit(utc_now()).cast("timestamp_ntz")
        done = now if status != "IN_PROGRESS" else nothing.cast("timestamp_ntz")
        columns = {
            "log_id": F.expr("uuid()"),
            "source_schema": F.lit(self.schema),
            "target_table": F.lit(self.target(entity)),
            "rows_loaded": F.coalesce(loaded, F.lit(0)) if loaded is not None else F.lit(0),
            "rows_rejected": F.coalesce(rejected, F.lit(0)) if rejected is not None else F.lit(0),
            "load_status": F.lit(status),
            "error_message": nothing if error is None else error,
            # The final event of a file starts after its first one, so it sorts last.
            "started_at": F.lit(started).cast("timestamp_ntz") if status == "IN_PROGRESS" else now,
            "completed_at": done,
            "run_id": F.lit(run_id),
            "_created_at": now,
            "_updated_at": now,
        }
        schema = T.StructType.fromDDL(FILE_LOG_SCHEMA)
        events = files.withColumns(columns)
        events = events.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        with self._turn:
            events.coalesce(1).write.mode("append").parquet(f"{self.root}/control/file_log")

    def _register(self, entity: str, fields: list[T.StructField], via: str, at: datetime) -> None:
        rows = [
            (None, self.database, self.schema, entity.upper(), f.name, f.dataType.simpleString(), True, at, at, via)
            for f in fields
        ]
        seen = self.spark.createDataFrame(rows, REGISTRY_SCHEMA)
        seen = seen.withColumn("registry_id", F.md5(F.concat_ws(".", "target_table", "column_name")))
        with self._turn:
            self._registry().overwrite(merge_registry(self.registry(), seen))

    # --- procedures ------------------------------------------------------------------------------

    def pending(self, source: EntitySource) -> DataFrame:
        """Landed files not yet loaded into the entity's table."""
        return new_files(list_files(self.spark, source), self.file_log(), self.target(source.name))

    def infer_and_evolve(
        self, source: EntitySource, run_id: str | None = None, run_ts: datetime | None = None,
        declared: str | None = None,
    ) -> dict:
        """Create the raw table from its files, or add the columns new files bring.

        Existing columns are never dropped or retyped. A column none of whose new values fits its
        stored type is reported under ``type_changes`` and in the task log.
        """
        started = run_ts or utc_now()
        result = {
            "entity_name": source.name, "stage_path": source.path, "target_table": self.target(source.name),
            "run_id": run_id or f"manual_{started:%Y%m%d_%H%M%S}", "columns_added": [], "type_changes": [],
            "table_created": False, "status": "SUCCESS", "error": None,
        }
        try:
            table = self.table(source.name)
            held = table.schema()
            files = self.pending(source).collect()
            if not files:
                if held is None:
                    raise ValueError(f"no columns inferred from {source.path}: no files")
                return result
            known = held or _declared_schema(declared or DECLARED.get(source.name))
            # A file that cannot be read is left to the load, which records it as failed.
            layouts = self._layouts(source, {r["file_path"]: r["load_path"] for r in files})
            if not layouts:
                raise ValueError(f"no columns inferred from {source.path}: no readable file")
            scans = [rows_of(self.spark, layout) for layout in layouts]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
            found = compare_columns(rows, known.fields)
            added = found.added
            result["type_changes"] = [
                {"column": f.name, "type": f.dataType.simpleString()} for f in found.changed
            ]
            if held is None:
                schema = T.StructType([*known.fields, *added, *T.StructType.fromDDL(AUDIT_SCHEMA).fields])
                table.overwrite(self.spark.createDataFrame([], schema))
                result["table_created"] = True
                self._register(source.name, [*known.fields, *added], source.path, started)
            elif added:
                empty = self.spark.createDataFrame([], T.StructType([*held.fields, *added]))
                table.append(empty)
                result["columns_added"] = [
                    {"column": f.name, "type": f.dataType.simpleString()} for f in added
                ]
                self._register(source.name, added, source.path, started)
            if result["type_changes"]:
                changes = "; ".join(f"{c['column']}: no value fits {c['type']}" for c in result["type_changes"])
                self.log_task(f"infer_{source.name}", "FAILED", started, error=f"type change, {changes}")
        except Exception as error:  # noqa: BLE001
            result.update(status="FAILED", error=str(error))
            self.log_task(f"infer_{source.name}", "FAILED", started, error=str(error))
        return result

    def _layout(self, source: EntitySource, paths: dict[str, str]) -> Layout:
        """Layout of some files; the load that follows an inference over the same files reuses it."""
        known = self._looked_at.setdefault(source, {})
        key = tuple(sorted(paths))
        if key not in known:
            known[key] = look_at(self.spark, source.file_format, paths)
        return known[key]

    def _layouts(self, source: EntitySource, paths: dict[str, str]) -> list[Layout]:
        """Layouts that cover all files that can be opened."""
        try:
            return [self._layout(source, paths)]
        except Exception:  # noqa: BLE001
            if len(paths) == 1:
                return []
            items = list(paths.items())
            half = len(items) // 2
            return self._layouts(source, dict(items[:half])) + self._layouts(source, dict(items[half:]))

    def load_new_files(
        self, source: EntitySource, run_id: str, run_ts: datetime | None = None
    ) -> dict:
        """Load files the log does not hold as loaded; all of them in one job.

        Columns match by name in any case. A row with a value that does not fit its column is
        rejected and counted. If a job fails, its files are split in two and tried again, down to
        the file at fault, which is logged as FAILED while the others load.
        """
        result = {
            "entity": source.name, "files_processed": 0, "rows_loaded": 0, "rows_rejected": 0,
            "errors": [], "status": "SUCCESS",
        }
        started = run_ts or utc_now()
        self._finish_interrupted(source, run_id)
        files = self.pending(source).collect()
        if not files:
            result["status"] = "NO_NEW_FILES"
            return result
        listed = self.spark.createDataFrame(files)
        self._log_files(listed, source.name, "IN_PROGRESS", run_id, started)
        self._load(source, files, run_id, started, result)
        for layout in self._looked_at.pop(source, {}).values():
            forget(self.spark, layout)
        if result["errors"]:
            result["status"] = "PARTIAL_FAILURE"
        return result

    def _load(self, source: EntitySource, files: list, run_id: str, started: datetime, result: dict) -> None:
        paths = {row["file_path"]: row["load_path"] for row in files}
        listed = self.spark.createDataFrame(files)
        try:
            rows = self._typed(source, paths, run_id, started)
            written = self.table(source.name).append_accepted(rows, "_rejected")
        except Exception as error:  # noqa: BLE001
            if len(files) > 1:
                half = len(files) // 2
                self._load(source, files[:half], run_id, started, result)
                self._load(source, files[half:], run_id, started, result)
                return
            message = str(error)
            self._log_files(
                listed, source.name, "FAILED", run_id, started, error=F.lit(message)
            )
            result["errors"].append({"file": files[0]["file_name"], "error": message})
            return
        self._log_loaded(source, listed, written, run_id, started, result)

    def _log_loaded(
        self, source: EntitySource, listed: DataFrame, written: DataFrame, run_id: str, started: datetime,
        result: dict | None = None,
    ) -> None:
        counts = written.groupBy(F.col("_source_file").alias("file_path")).agg(
            F.count_if(~F.col("_rejected")).alias("loaded"), F.count_if("_rejected").alias("rejected")
        )
        joined = listed.join(counts, "file_path", "left")
        self._log_files(
            joined, source.name, "SUCCESS", run_id, started, F.col("loaded"), F.col("rejected")
        )
        if result is not None:
            totals = joined.agg(F.count(F.lit(1)), F.sum("loaded"), F.sum("rejected")).first()
            result["files_processed"] += totals[0]
            result["rows_loaded"] += totals[1] or 0
            result["rows_rejected"] += totals[2] or 0

    def _typed(self, source: EntitySource, paths: dict[str, str], run_id: str, started: datetime) -> DataFrame:
        schema = self.table(source.name).schema()
        if schema is None:
            raise FileNotFoundError(f"{self.target(source.name)} does not exist; infer it first")
        rows = rows_of(self.spark, self._layout(source, paths))
        audit = {f.name for f in T.StructType.fromDDL(AUDIT_SCHEMA).fields}
        columns, misfits = [], []
        for field in schema.fields:
            if field.name in audit:
                continue
            name = field.name.lower()
            if name not in rows.columns:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
                continue
            raw = F.col(quoted(name))
            if isinstance(field.dataType, T.VariantType):
                given = isinstance(rows.schema[name].dataType, T.VariantType)
                value = raw if given else F.parse_json(F.to_json(raw))
            else:
                value = raw.try_cast(field.dataType)
                misfits.append(raw.isNotNull() & value.isNull())
            columns.append(value.alias(field.name))
        if UNREADABLE in rows.columns:
            misfits.append(F.col(UNREADABLE))
        rejected = reduce(lambda a, b: a | b, misfits, F.lit(False))
        typed = rows.select(*columns, rejected.alias("_rejected"), FILE)
        loaded = load_audit(F.col(FILE), run_id, started)
        return typed.withColumns(loaded).withColumn("_loaded_date", F.to_date("_loaded_at")).drop(FILE)

    def _finish_interrupted(self, source: EntitySource, run_id: str) -> None:
        """Log files as loaded whose rows are in the table although their run never said so."""
        table = self.table(source.name)
        log = self.file_log().filter(F.col("target_table") == self.target(source.name))
        open_files = latest_file_status(log).filter(F.col("load_status") == "IN_PROGRESS")
        if not table.exists() or not open_files.limit(1).collect():
            return
        started = log.filter(F.col("load_status") == "IN_PROGRESS").select(
            *[c for c in log.columns if c.startswith("file_")]
        )
        listed = started.join(open_files.select("file_path"), "file_path", "left_semi").dropDuplicates(
            ["file_path"]
        )
        present = table.read().select("_source_file", F.lit(False).alias("_rejected")).join(
            listed.select(F.col("file_path").alias("_source_file")), "_source_file", "left_semi"
        )
        done = listed.join(
            present.select(F.col("_source_file").alias("file_path")).distinct(), "file_path", "left_semi"
        )
        self._log_loaded(source, done, present, run_id, utc_now())


def ingest(
    zone: RawZone, sources: list[EntitySource], run_id: str, run_ts: datetime | None = None
) -> list[dict]:
    """Infer, then load, every entity; the results of the loads in the order of ``sources``."""

    def one(source: EntitySource) -> dict:
        inferred = zone.infer_and_evolve(source, run_id, run_ts)
        if inferred["status"] == "FAILED":
            return {"entity": source.name, "status": "FAILED", "errors": [inferred["error"]]}
        started = run_ts or utc_now()
        loaded = zone.load_new_files(source, run_id, run_ts)
        zone.log_task(f"load_{source.name}", "SUCCEEDED", started, loaded["rows_loaded"])
        return loaded

    return side_by_side(zone.spark, one, sources)
