"""The given tables landed as files in awkward layouts, loaded, and shown with their counts.

What a file holds is derived from whole tables by arithmetic on their keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.operators.control import latest_file_status
from tradewind.registry.shapes import table
from tradewind.session import ensure_checkpoint_dir
from tradewind.sources.ingest import RawZone
from tradewind.sources.landing import EntitySource

FILES = 5
#: One order of so many has a quoted note that never ends, a note of two lines, an amount that is no number.
BROKEN, TWO_LINES, NO_NUMBER = 101, 7, 211


def _folder(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _land(lines: DataFrame, path: str) -> None:
    """``part, at, value`` as one text file per part, its lines by ``at``."""
    lines.repartition(FILES, "part").sortWithinPartitions("part", "at").select("part", "value").write.partitionBy("part").text(path)


def order_lines(orders: DataFrame, header: str, fields: str) -> DataFrame:
    """CSV lines of orders, dealt over files, each of which begins with a header."""
    note = f"""case when o_orderkey % {BROKEN} = 3 then concat('"', o_orderpriority)
        when o_orderkey % {TWO_LINES} = 2 then concat('"', o_orderpriority, ', "" said\n', o_orderstatus, '"')
        when o_orderkey % 11 = 4 then concat(o_orderstatus, ' 5" wide') else concat('"', o_orderpriority, '"') end"""
    amount = f"if(o_orderkey % {NO_NUMBER} = 5, 'n.a.!', cast(cast(o_totalprice as decimal(18,2)) as string))"
    rows = orders.withColumns({"note": F.expr(note), "amount": F.expr(amount), "day": F.expr("cast(to_date(o_orderdate) as string)")})
    body = rows.select((F.col("o_orderkey") % FILES).alias("part"), F.col("o_orderkey").alias("at"), F.expr(f"concat_ws(',', {fields})").alias("value"))
    heads = orders.sparkSession.range(FILES).select(F.col("id").alias("part"), F.lit(-1).cast("long").alias("at"), F.lit(header).alias("value"))
    return body.union(heads)


def _loaded_orders(spark: SparkSession, d: str) -> RawZone:
    """Orders up to 1997 landed and loaded, then the later ones with their columns in another order and a new one."""
    orders = table(spark, d, "orders")
    path, zone = _folder(spark, "landing"), RawZone(spark, _folder(spark, "zone"))
    source = EntitySource("orders", path, "csv")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    _land(order_lines(orders.filter(early), " order_id,CUSTOMER_ID,note,order_amount,order_date", "o_orderkey, o_custkey, note, amount, day"), f"{path}/early")
    _load(zone, source, "first")
    _land(order_lines(orders.filter(~early), "note,order_date,Order_Id,coupon,order_amount", "note, day, o_orderkey, o_custkey % 9, amount"), f"{path}/late")
    _load(zone, source, "second")
    return zone


def _load(zone: RawZone, source: EntitySource, run: str) -> None:
    inferred = zone.infer_and_evolve(source, run)
    if inferred["status"] == "FAILED":
        raise RuntimeError(inferred["error"])
    loaded = zone.load_new_files(source, run)
    if loaded["errors"]:
        raise RuntimeError(str(loaded["errors"]))


def _counts(zone: RawZone) -> DataFrame:
    """Per landed file its folder, part and counts."""
    log = latest_file_status(zone.file_log())
    return log.select(
        F.regexp_extract("file_path", "/([a-z]+)/part=", 1).alias("layout"), F.regexp_extract("file_path", "part=([0-9]+)", 1).cast("bigint").alias("part"),
        "rows_loaded", "rows_rejected", "load_status",
    )


def ingest_csv_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as loaded from quoted CSV files whose notes span lines or never end."""
    held = _loaded_orders(spark, d).read("orders")
    return held.select("order_id", "customer_id", "note", F.col("order_amount").cast("double").alias("order_amount"), "order_date", "coupon", "_ingestion_run_id")


def ingest_csv_drift(spark: SparkSession, d: str) -> DataFrame:
    """Per file of two loads with different columns, the rows loaded and rejected."""
    return _counts(_loaded_orders(spark, d))


def _customer_lines(customers: DataFrame, layout: str) -> DataFrame:
    """Customers as JSON text in one of several layouts; ``at`` leaves room for lines before and after."""
    fields = F.struct(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("it's"), F.col("c_mktsegment").alias("a.b"),
        F.concat(F.lit('{[ "'), "c_mktsegment").alias("c[0]"), F.struct(F.array(F.struct(F.col("c_nationkey").alias("n"))).alias("x")).alias("deep"),
    )
    text = F.to_json(fields)
    pretty = F.to_json(fields, {"pretty": "true"})
    last = F.col("c_custkey") == F.max("c_custkey").over(Window.partitionBy("part"))
    part, at = (F.col("c_custkey") / 4).cast("long") % FILES, F.col("c_custkey")
    value = {
        "lines": text,
        "array": F.concat(pretty, F.when(last, "\n]").otherwise(",")),
        "joined": F.concat(pretty, F.when(at % 3 == 0, "").otherwise("\n")),
        # Text after a line cut short would count as part of what that line left open.
        "broken": F.when(at % 53 == 7, F.left(text, F.lit(40))).when(at % 59 == 31, F.lit("not json")).otherwise(text),
    }[layout]
    before = {"array": "[", "broken": '{"customer_id": '}.get(layout)
    rows = customers.withColumn("part", part)
    body = rows.select("part", at.alias("at"), value.alias("value"))
    if before:
        body = body.union(rows.groupBy("part").agg(F.lit(-1).cast("long").alias("at"), F.lit(before).alias("value")))
    return body


LAYOUTS = ["lines", "array", "joined", "broken"]


def _loaded_customers(spark: SparkSession, d: str) -> RawZone:
    """A quarter of the customers in each layout, landed and loaded."""
    customers = table(spark, d, "customer")
    path, zone = _folder(spark, "landing"), RawZone(spark, _folder(spark, "zone"))
    for i, layout in enumerate(LAYOUTS):
        _land(_customer_lines(customers.filter(F.col("c_custkey") % 4 == i), layout), f"{path}/{layout}")
    _load(zone, EntitySource("customers", path, "json"), "first")
    return zone


def ingest_json_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Customers as loaded from lines, pretty arrays, joined objects and files with bad lines; keys with quotes, dots and brackets."""
    held = _loaded_customers(spark, d).read("customers")
    return held.select(
        "customer_id", F.col("`it's`").alias("name"), F.col("`a.b`").alias("segment"), F.col("`c[0]`").alias("bracket"),
        F.try_variant_get("raw_payload", "$.deep.x[0].n", "bigint").alias("nation"),
    )


def ingest_json_log(spark: SparkSession, d: str) -> DataFrame:
    """Per JSON file the objects loaded and rejected."""
    return _counts(_loaded_customers(spark, d))
