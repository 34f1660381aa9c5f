"""The given tables in the shape of the shop's raw deliveries.

Every column is derived from a whole table by arithmetic on its key, so the shapes grow with the
tables. They carry what raw deliveries carry: repeated and null keys, padded and mixed-case text,
unreadable dates and flags, payload-only customers, orders without lines, orphans.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tradewind.sources.seeds import COUNTRY_CODES

AS_OF = date(2001, 9, 1)
AS_OF_TS = datetime(2001, 9, 1)

# Country per nation number, and the words picked by key arithmetic.
NATION_CODES = [line.split(",")[0] for line in COUNTRY_CODES.splitlines()]
PAYMENT_METHODS = ["credit_card", "paypal", "debit_card", "google_pay", "apple_pay"]
CHANNELS = ["organic_search", "paid_social", "email", "referral"]
SEGMENT_OF_MARKET = {
    "AUTOMOBILE": "bronze", "BUILDING": "silver", "FURNITURE": "gold", "HOUSEHOLD": "platinum",
    "MACHINERY": "vip",
}
CATEGORY_OF_TYPE = {
    "ECONOMY": "Electronics", "LARGE": "Clothing", "MEDIUM": "Home & Garden", "PROMO": "Books & Media",
    "SMALL": "Toys & Games", "STANDARD": "Curiosities",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(words: list[str], index: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"element_at(array({listed}), cast({index} + 1 as int))"


def _map(words: dict[str, str], column: str) -> str:
    branches = " ".join(f"when '{k}' then '{v}'" for k, v in words.items())
    return f"case {column} {branches} end"


def _delivered(df: DataFrame, *conditions: str) -> DataFrame:
    """Each row as delivery 0, and again as delivery 1, 2, ... where that condition holds."""
    again = [f"if({c}, {i}, null)" for i, c in enumerate(conditions, 1)]
    numbers = ", ".join(["0", *again])
    return df.selectExpr("*", f"explode(filter(array({numbers}), x -> x is not null)) as delivery")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    word = """case when o_orderkey % 20 = 0 then 'cancelled' when o_orderkey % 20 = 1 then 'refunded'
        when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'shipped'
        else 'pending' end"""
    delivered = _delivered(
        table(spark, folder, "orders"), "o_orderkey % 10 = 0", "o_orderkey % 501 = 7"
    )
    return delivered.selectExpr("*", f"{word} as word", "to_date(o_orderdate) as day").selectExpr(
        "if(delivery <> 2, cast(o_orderkey as string), null) as order_id",
        """case when o_orderkey % 211 = 9 then null
            when o_orderkey % 307 = 11 then concat('X', cast(o_custkey as string))
            else cast(o_custkey as string) end as customer_id""",
        "concat('  ', upper(if(delivery = 1, 'delivered', word)), ' ') as order_status",
        "cast(o_totalprice as decimal(18,2)) as order_amount",
        "if(o_orderkey % 997 = 5, '2001-13-45', cast(day as string)) as order_date",
        """if(word in ('pending', 'cancelled'), null,
            cast(date_add(day, cast(o_orderkey % 9 - 1 as int)) as string)) as shipped_date""",
        f"concat(' ', upper({_pick(PAYMENT_METHODS, 'o_orderkey % 5')})) as payment_method",
        f"concat(if(o_orderkey % 41 = 0, 'zz', lower({_pick(NATION_CODES, 'o_custkey % 25')})), ' ')"
        " as billing_country",
        "cast(date_add(day, delivery + 1) as timestamp_ntz) as _loaded_at",
        "concat('orders_', cast(o_orderkey % 7 as string), '.csv') as _source_file",
        "concat('run_', cast(delivery as string)) as _ingestion_run_id",
    )


def order_items_shape(lines: DataFrame) -> DataFrame:
    """Works on the table and on a stream of it."""
    return lines.selectExpr(
        "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as order_item_id",
        "cast(l_orderkey as string) as order_id",
        "cast(l_partkey as string) as product_id",
        "cast(round(l_quantity) as decimal(10,0)) as quantity",
        """cast(cast((cast(round(l_extendedprice * 100) as bigint) * 100)
            div cast(round(l_quantity) as bigint) as decimal(18,0)) * 0.0001BD
            as decimal(18,4)) as unit_price""",
        "cast(round(l_discount * 100) as decimal(5,2)) as discount_pct",
        "l_shipdate as _loaded_at",
    )


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return order_items_shape(table(spark, folder, "lineitem"))


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    segment = f"""case when delivery = 1 then 'vip' when c_custkey % 97 = 3 then 'unknown'
        else {_map(SEGMENT_OF_MARKET, "c_mktsegment")} end"""
    payload = f"""to_json(named_struct(
        'customer_id', k,
        'email', concat('p', k, '@payload.example'),
        'phone', concat('+1-555-9', k),
        'first_name', concat('First', k),
        'last_name', concat('Last', k),
        'country', nation,
        'date_of_birth', cast(date_add(date'1960-01-01', cast(c_custkey % 15000 as int)) as string),
        'customer_segment', {segment},
        'acquisition_channel', {_pick(CHANNELS, 'c_custkey % 4')},
        'is_email_verified', c_custkey % 4 <> 0,
        'created_at', concat(cast(created as string), 'T10:23:00Z'),
        'updated_at', if(c_custkey % 211 = 0, 'not a time',
            concat(cast(date_add(created, 10 + 30 * delivery) as string), 'T10:23:00Z'))))"""
    direct = "c_custkey % 3 <> 1"
    return _delivered(table(spark, folder, "customer"), "c_custkey % 5 = 0").selectExpr(
        "*",
        "cast(c_custkey as string) as k",
        "date_add(date'1995-01-01', cast(c_custkey * 37 % 2400 as int)) as created",
        f"lower({_pick(NATION_CODES, 'c_nationkey')}) as nation",
    ).selectExpr(
        f"if({direct}, k, null) as customer_id",
        f"if(c_custkey % 3 <> 0, parse_json({payload}), null) as raw_payload",
        f"if({direct}, concat('user', k, '@example.com'), null) as email",
        f"if({direct}, concat('+1-555-', k), null) as phone",
        f"if({direct}, nation, null) as country",
        f"if({direct}, concat(cast(created as string), ' 00:00:00'), null) as created_at",
        "cast(date_add(created, delivery + 1) as timestamp_ntz) as _loaded_at",
        "concat('customers_', cast(c_custkey % 3 as string), '.json') as _source_file",
        "concat('run_', cast(delivery as string)) as _ingestion_run_id",
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    return _delivered(table(spark, folder, "part"), "p_partkey % 10 = 0").selectExpr(
        "*",
        """if(p_partkey % 401 = 0, 0, cast(round(p_retailprice * 100) as bigint) + delivery * 100)
            as price""",
    ).selectExpr(
        "cast(p_partkey as string) as product_id",
        "concat(' ', p_name, '  ') as product_name",
        f"concat(' ', {_map(CATEGORY_OF_TYPE, 'p_type')}) as category",
        "concat(lower(p_brand), ' ') as brand",
        """cast(cast(price * if(p_partkey % 53 = 7, 110, 100 - 2 * p_size) as decimal(18,0)) * 0.0001BD
            as decimal(18,4)) as unit_cost""",
        "cast(cast(price as decimal(18,0)) * 0.01BD as decimal(18,4)) as list_price",
        """case when p_partkey % 11 = 0 then null when p_partkey % 50 = 3 then 'maybe'
            when p_partkey % 7 = 0 then 'false' else 'true' end as is_active""",
        "cast(date_add(date'2001-01-01', delivery) as timestamp_ntz) as _loaded_at",
    )
