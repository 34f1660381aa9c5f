"""The suite of checks reads its stored models by column."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from tradewind.registry import queries


def test_suite_reads_models_by_column(spark, tmp_path):
    rows = spark.range(60).withColumn("day", F.expr("cast(date_add(date'1995-01-01', cast(id * 37 as int)) as timestamp_ntz)"))
    given = {
        "customer": rows.selectExpr(
            "id as c_custkey", "concat('Customer#', id) as c_name", "cast(id % 25 as int) as c_nationkey", "id * 10.5D - 50 as c_acctbal", "'BUILDING' as c_mktsegment"),
        "orders": rows.selectExpr(
            "id as o_orderkey", "id % 45 as o_custkey", "if(id % 2 = 0, 'F', 'O') as o_orderstatus", "100D + id as o_totalprice", "day as o_orderdate", "'1-URGENT' as o_orderpriority"),
        "lineitem": rows.selectExpr(
            "id % 50 as l_orderkey", "id % 20 as l_partkey", "id % 7 as l_suppkey", "cast(id div 50 + 1 as int) as l_linenumber", "cast(id % 9 + 1 as double) as l_quantity",
            "90D + id as l_extendedprice", "0.05D as l_discount", "0.01D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", "day as l_shipdate"),
        "part": rows.limit(20).selectExpr(
            "id as p_partkey", "concat('part ', id) as p_name", "'Brand#11' as p_brand", "'SMALL PLATED TIN' as p_type", "cast(id as int) as p_size", "10D + id as p_retailprice"),
        "supplier": rows.limit(7).selectExpr("id as s_suppkey", "concat('Supplier#', id) as s_name", "cast(id as int) as s_nationkey", "5D as s_acctbal"),
        "nation": rows.limit(25).selectExpr("cast(id as int) as n_nationkey", "concat('N', id) as n_name", "cast(id % 5 as int) as n_regionkey"),
        "region": rows.limit(5).selectExpr("cast(id as int) as r_regionkey", "concat('R', id) as r_name"),
    }
    for name, table in given.items():
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    suite = queries.dq_suite(spark, str(tmp_path))
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        suite.explain()
    assert "ExistingRDD" not in plan.getvalue()
    found = {(r.model_name, r.test_name, r.test_column): r.failures for r in suite.collect()}
    assert len(found) == 68
    assert found["fct_orders", "unique", "order_sk"] == 0 and found["stg_orders", "relationships", "customer_id"] is not None
