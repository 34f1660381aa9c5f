"""The same results in plain SQL over the same tables.

The statements share named subqueries; each statement carries only those it refers to.
"""

from __future__ import annotations

import re

from tradewind.functions import measures
from tradewind.plans import checks
from tradewind.registry.landings import BROKEN, FILES, NO_NUMBER, TWO_LINES
from tradewind.registry.shapes import (
    AS_OF_TS, CATEGORY_OF_TYPE, CHANNELS, NATION_CODES, PAYMENT_METHODS, SEGMENT_OF_MARKET,
)
from tradewind.sources.seeds import COUNTRY_CODES, PRODUCT_CATEGORIES


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _case(column: str, words: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + " END"


def _values(text: str, columns: str) -> str:
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in line.split(",")) + ")" for line in text.splitlines())
    return f"SELECT * FROM (VALUES {rows}) v({columns})"


def _average(total: str, count: str) -> str:
    """Mean of two-digit decimals, rounded half up to six digits by whole-number arithmetic."""
    millionths = f"(CAST({total} * 100 AS HUGEINT) * 20000 + {count}) // (2 * {count})"
    return f"CASE WHEN {count} > 0 THEN CAST({millionths} AS DOUBLE) / 1000000 END"


CTES: dict[str, str] = {}

CTES["country_codes"] = _values(COUNTRY_CODES, "country_code, country_name, region")
CTES["product_categories"] = _values(PRODUCT_CATEGORIES, "category_id, category_name, parent_category")

CTES["deliveries"] = """
SELECT o.*, d.delivery,
  CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled' WHEN o_orderkey % 20 = 1 THEN 'refunded'
       WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'shipped'
       ELSE 'pending' END AS word
FROM orders o JOIN (VALUES (0), (1), (2)) d(delivery)
  ON delivery = 0 OR (delivery = 1 AND o_orderkey % 10 = 0) OR (delivery = 2 AND o_orderkey % 501 = 7)
"""
CTES["raw_orders"] = f"""
SELECT
  CASE WHEN delivery <> 2 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
  CASE WHEN o_orderkey % 211 = 9 THEN NULL
       WHEN o_orderkey % 307 = 11 THEN 'X' || CAST(o_custkey AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN delivery = 1 THEN 'delivered' ELSE word END AS order_status,
  CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount,
  CASE WHEN o_orderkey % 997 <> 5 THEN CAST(o_orderdate AS DATE) END AS order_date,
  CASE WHEN word NOT IN ('pending', 'cancelled')
       THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 - 1 AS INTEGER) END AS shipped_date,
  {_list(PAYMENT_METHODS)}[o_orderkey % 5 + 1] AS payment_method,
  CASE WHEN o_orderkey % 41 = 0 THEN 'ZZ' ELSE {_list(NATION_CODES)}[o_custkey % 25 + 1] END AS billing_country,
  CAST(CAST(o_orderdate AS DATE) + delivery + 1 AS TIMESTAMP) AS _loaded_at,
  'orders_' || CAST(o_orderkey % 7 AS VARCHAR) || '.csv' AS _source_file,
  'run_' || CAST(delivery AS VARCHAR) AS _ingestion_run_id
FROM deliveries
"""
_STG_ORDERS = """
SELECT order_id, customer_id, order_status, order_amount AS order_amount_usd, order_date, shipped_date,
  payment_method, billing_country AS billing_country_code, _loaded_at AS _raw_loaded_at, _source_file,
  _ingestion_run_id, order_status IN ('delivered', 'completed') AS is_completed,
  coalesce(shipped_date < order_date, FALSE) AS is_date_anomaly
FROM {source} WHERE order_id IS NOT NULL {extra}
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _loaded_at DESC NULLS LAST,
  _ingestion_run_id DESC NULLS LAST, _source_file DESC NULLS LAST) = 1
"""


def _orders_when(condition: str) -> str:
    return _STG_ORDERS.format(source="raw_orders", extra=f"AND {condition}")


CTES["stg_orders"] = _STG_ORDERS.format(source="raw_orders", extra="")
CTES["raw_order_items"] = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
  CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
  CAST(round(l_quantity) AS BIGINT) AS quantity,
  CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * 100) // CAST(round(l_quantity) AS BIGINT)
    AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS unit_price,
  CAST(round(l_discount * 100) AS DECIMAL(5,2)) AS discount_pct, l_shipdate AS _loaded_at
FROM lineitem
"""
CTES["stg_order_items"] = """
SELECT order_item_id, order_id, product_id, quantity,
  CAST(CAST(quantity AS DECIMAL(10,0)) * unit_price AS DECIMAL(18,2)) AS line_total_usd, discount_pct,
  CAST(unit_price AS DECIMAL(18,2)) AS unit_price_usd, _loaded_at AS _raw_loaded_at
FROM raw_order_items WHERE order_item_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY _loaded_at DESC NULLS LAST,
  product_id DESC NULLS LAST, quantity DESC NULLS LAST, unit_price DESC NULLS LAST,
  discount_pct DESC NULLS LAST, order_id DESC NULLS LAST) = 1
"""
CTES["customer_deliveries"] = f"""
SELECT c.*, d.delivery, CAST(c_custkey AS VARCHAR) AS k,
  DATE '1995-01-01' + CAST(c_custkey * 37 % 2400 AS INTEGER) AS created,
  lower({_list(NATION_CODES)}[c_nationkey + 1]) AS nation,
  CASE WHEN delivery = 1 THEN 'vip' WHEN c_custkey % 97 = 3 THEN 'unknown'
       ELSE {_case("c_mktsegment", SEGMENT_OF_MARKET)} END AS segment
FROM customer c JOIN (VALUES (0), (1)) d(delivery)
  ON delivery = 0 OR c_custkey % 5 = 0
"""
CTES["raw_customers"] = f"""
SELECT
  CASE WHEN c_custkey % 3 <> 1 THEN k END AS customer_id,
  CASE WHEN c_custkey % 3 <> 0 THEN json_object(
    'customer_id', k, 'email', 'p' || k || '@payload.example', 'phone', '+1-555-9' || k,
    'first_name', 'First' || k, 'last_name', 'Last' || k, 'country', nation,
    'date_of_birth', strftime(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d'),
    'customer_segment', segment,
    'acquisition_channel', {_list(CHANNELS)}[c_custkey % 4 + 1],
    'is_email_verified', c_custkey % 4 <> 0,
    'created_at', strftime(created, '%Y-%m-%dT10:23:00Z'),
    'updated_at', CASE WHEN c_custkey % 211 = 0 THEN 'not a time'
      ELSE strftime(created + 10 + 30 * delivery, '%Y-%m-%dT10:23:00Z') END) END AS raw_payload,
  CASE WHEN c_custkey % 3 <> 1 THEN 'user' || k || '@example.com' END AS email,
  CASE WHEN c_custkey % 3 <> 1 THEN '+1-555-' || k END AS phone,
  CASE WHEN c_custkey % 3 <> 1 THEN nation END AS country,
  CASE WHEN c_custkey % 3 <> 1 THEN CAST(created AS TIMESTAMP) END AS created_at,
  CAST(created + delivery + 1 AS TIMESTAMP) AS _loaded_at,
  'customers_' || CAST(c_custkey % 3 AS VARCHAR) || '.json' AS _source_file,
  'run_' || CAST(delivery AS VARCHAR) AS _ingestion_run_id
FROM customer_deliveries
"""
CTES["flat_customers"] = """
SELECT coalesce(customer_id, raw_payload ->> '$.customer_id') AS customer_id,
  coalesce(email, raw_payload ->> '$.email') AS email,
  coalesce(phone, raw_payload ->> '$.phone') AS phone,
  upper(coalesce(country, raw_payload ->> '$.country')) AS country_code,
  raw_payload ->> '$.first_name' AS first_name, raw_payload ->> '$.last_name' AS last_name,
  CAST(raw_payload ->> '$.date_of_birth' AS DATE) AS date_of_birth,
  raw_payload ->> '$.customer_segment' AS customer_segment,
  raw_payload ->> '$.acquisition_channel' AS acquisition_channel,
  CAST(raw_payload ->> '$.is_email_verified' AS BOOLEAN) AS is_email_verified,
  coalesce(created_at, TRY_CAST(raw_payload ->> '$.created_at' AS TIMESTAMP)) AS customer_created_at,
  TRY_CAST(raw_payload ->> '$.updated_at' AS TIMESTAMP) AS customer_updated_at,
  _loaded_at AS _raw_loaded_at, _source_file, _ingestion_run_id
FROM raw_customers
"""
_STG_CUSTOMERS = """
SELECT * FROM flat_customers WHERE customer_id IS NOT NULL {extra}
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_updated_at DESC NULLS LAST,
  _raw_loaded_at DESC NULLS LAST, _ingestion_run_id DESC NULLS LAST, _source_file DESC NULLS LAST) = 1
"""
CTES["stg_customers"] = _STG_CUSTOMERS.format(extra="")
CTES["first_customers"] = _STG_CUSTOMERS.format(extra="AND _ingestion_run_id = 'run_0'")
CTES["raw_products"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  upper({_case("p_type", CATEGORY_OF_TYPE)}) AS category, upper(p_brand) AS brand,
  CAST(CAST(price * (CASE WHEN p_partkey % 53 = 7 THEN 110 ELSE 100 - 2 * p_size END) AS DECIMAL(18,0))
    * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS unit_cost,
  CAST(CAST(price AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS list_price,
  CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 50 = 3 THEN 'maybe'
       WHEN p_partkey % 7 = 0 THEN 'false' ELSE 'true' END AS is_active,
  CAST(DATE '2001-01-01' + delivery AS TIMESTAMP) AS _loaded_at
FROM (SELECT p.*, delivery, CASE WHEN p_partkey % 401 = 0 THEN 0
        ELSE CAST(round(p_retailprice * 100) AS BIGINT) + delivery * 100 END AS price
      FROM part p JOIN (VALUES (0), (1)) d(delivery) ON delivery = 0 OR p_partkey % 10 = 0)
"""
CTES["stg_products"] = """
SELECT product_id, product_name, category, brand, unit_cost AS unit_cost_usd,
  list_price AS list_price_usd, coalesce(TRY_CAST(is_active AS BOOLEAN), TRUE) AS is_active,
  _loaded_at AS _raw_loaded_at,
  CASE WHEN list_price > 0 THEN
    round(CAST(list_price - unit_cost AS DOUBLE) / CAST(list_price AS DOUBLE) * 100, 2) END AS margin_pct
FROM raw_products WHERE product_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY _loaded_at DESC NULLS LAST,
  list_price DESC NULLS LAST, unit_cost DESC NULLS LAST) = 1
"""
CTES["item_totals"] = f"""
SELECT order_id, count(*) AS line_item_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  sum(line_total_usd) AS items_total_usd,
  sum(CASE WHEN discount_pct > 0 THEN line_total_usd END) AS discounted_items_total_usd,
  {_average("sum(discount_pct)", "count(discount_pct)")} AS avg_discount_pct, max(unit_price_usd) AS max_unit_price_usd,
  count(DISTINCT product_id) AS distinct_product_count
FROM stg_order_items GROUP BY order_id
"""
CTES["enriched"] = """
SELECT o.order_id, o.customer_id, c.country_code, c.customer_segment, c.acquisition_channel,
  o.order_status, o.order_date, o.shipped_date, o.payment_method, o.billing_country_code,
  o.is_completed, CAST(date_trunc('month', o.order_date) AS DATE) AS order_month,
  CAST(date_trunc('year', o.order_date) AS DATE) AS order_year,
  dayofweek(o.order_date) AS order_day_of_week, quarter(o.order_date) AS order_quarter,
  o.order_amount_usd, i.items_total_usd, i.discounted_items_total_usd, i.avg_discount_pct,
  coalesce(i.items_total_usd, o.order_amount_usd) AS revenue_usd, i.line_item_count, i.total_quantity,
  i.distinct_product_count, i.max_unit_price_usd,
  datediff('day', o.order_date, o.shipped_date) AS days_to_ship,
  CASE WHEN CAST(c.customer_created_at AS DATE) = o.order_date THEN 'new' ELSE 'returning' END
    AS customer_type_at_order,
  o._raw_loaded_at, o._source_file
FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
LEFT JOIN item_totals i ON o.order_id = i.order_id
WHERE NOT o.is_date_anomaly
"""
_METRICS = """
SELECT customer_id, count(order_id) AS total_orders, count_if(is_completed) AS completed_orders,
  count_if(order_status = 'cancelled') AS cancelled_orders,
  sum(CASE WHEN is_completed THEN revenue_usd ELSE 0 END) AS lifetime_value_usd,
  {average} AS avg_order_value_usd,
  max(revenue_usd) AS max_order_value_usd, min(order_date) AS first_order_date,
  max(order_date) AS last_order_date,
  datediff('day', min(order_date), max(order_date)) AS customer_tenure_days,
  datediff('day', max(order_date), DATE '2001-09-01') AS days_since_last_order,
  avg(days_to_ship) AS avg_days_to_ship
FROM enriched WHERE order_date BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY customer_id
"""


def _metrics_between(start: str, end: str) -> str:
    average = _average("sum(CASE WHEN is_completed THEN revenue_usd END)", "count_if(is_completed)")
    return _METRICS.format(start=start, end=end, average=average)


CTES["metrics"] = _metrics_between("1900-01-01", "9999-12-31")
_SCORES = """
SELECT *, recency_score + frequency_score + monetary_score AS rfm_score,
  CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'champions'
       WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'loyal'
       WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'new_customer'
       WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'at_risk'
       WHEN recency_score <= 2 AND monetary_score >= 4 THEN 'cant_lose'
       WHEN recency_score <= 1 THEN 'lost' ELSE 'potential_loyalist' END AS rfm_segment,
  round(CAST(cancelled_orders AS DOUBLE) / nullif(total_orders, 0) * 100, 2) AS cancellation_rate_pct
FROM (SELECT *,
  ntile(5) OVER (ORDER BY days_since_last_order {r}, customer_id ASC NULLS FIRST) AS recency_score,
  ntile(5) OVER (ORDER BY total_orders {f}, customer_id ASC NULLS FIRST) AS frequency_score,
  ntile(5) OVER (ORDER BY lifetime_value_usd {f}, customer_id ASC NULLS FIRST) AS monetary_score
  FROM metrics)
"""
CTES["scores"] = _SCORES.format(r="ASC", f="DESC")
CTES["high_scores"] = _SCORES.format(r="DESC", f="ASC")
_PROFILE = """customer_id, email, first_name, last_name, country_code, customer_segment,
  acquisition_channel, is_email_verified, customer_created_at, customer_updated_at"""
CTES["remaining"] = f"""
SELECT {_PROFILE} FROM stg_customers
WHERE customer_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)
"""
_CHANGES = """
SELECT f.customer_id, r.customer_id IS NULL AS gone, r.customer_updated_at AS next_update,
  coalesce(r.customer_updated_at > coalesce(f.customer_updated_at, TIMESTAMP '2001-01-01'), FALSE) AS changed
FROM first_customers f LEFT JOIN {source} r ON f.customer_id = r.customer_id
"""
CTES["changes"] = _CHANGES.format(source="remaining")
CTES["changes_of_all"] = _CHANGES.format(source="stg_customers")


def _versions(deletes: bool, source: str = "remaining", changes: str = "changes") -> str:
    gone = "greatest(TIMESTAMP '2001-06-01', started)" if deletes else "NULL"
    return f"""
SELECT v.*, md5(v.customer_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS version_id
FROM (
  SELECT {_PROFILE}, started AS version_updated_at, started AS valid_from,
    CASE WHEN changed THEN next_update WHEN gone THEN {gone} END AS valid_to
  FROM (SELECT f.*, coalesce(f.customer_updated_at, TIMESTAMP '2001-01-01') AS started, x.gone, x.changed,
          x.next_update
        FROM first_customers f JOIN {changes} x ON f.customer_id = x.customer_id)
  UNION ALL
  SELECT {_PROFILE.replace("customer_id,", "r.customer_id,", 1)},
    coalesce(customer_updated_at, TIMESTAMP '2001-06-01'), coalesce(customer_updated_at, TIMESTAMP '2001-06-01'),
    CAST(NULL AS TIMESTAMP)
  FROM {source} r LEFT JOIN {changes} x ON r.customer_id = x.customer_id
  WHERE x.customer_id IS NULL OR x.changed
) v
"""


CTES["versions"] = _versions(True, "stg_customers", "changes_of_all")
CTES["versions_deleted"] = _versions(True)
CTES["versions_kept"] = _versions(False)
CTES["dim"] = """
SELECT md5(v.customer_id) AS customer_sk, v.customer_id, email, first_name, last_name, country_code,
  customer_segment, acquisition_channel, is_email_verified, customer_created_at, valid_from, valid_to,
  valid_to IS NULL AS is_current, coalesce(total_orders, 0) AS total_orders,
  coalesce(completed_orders, 0) AS completed_orders, coalesce(cancelled_orders, 0) AS cancelled_orders,
  coalesce(lifetime_value_usd, 0) AS lifetime_value_usd, avg_order_value_usd, max_order_value_usd,
  first_order_date, last_order_date, customer_tenure_days, days_since_last_order, avg_days_to_ship,
  cancellation_rate_pct, rfm_score, rfm_segment, recency_score, frequency_score, monetary_score,
  coalesce(total_orders > 0, FALSE) AS has_placed_order,
  coalesce(days_since_last_order <= 90, FALSE) AS is_active
FROM versions v LEFT JOIN scores s ON v.customer_id = s.customer_id WHERE valid_to IS NULL
"""
CTES["products"] = """
SELECT sha256(upper(trim(product_id))) AS product_sk, product_id, product_name, category, brand,
  coalesce(parent_category, 'Uncategorized') AS parent_category, unit_cost_usd, list_price_usd, margin_pct,
  CASE WHEN margin_pct >= 50 THEN 'high' WHEN margin_pct >= 25 THEN 'medium' ELSE 'low' END AS margin_tier,
  is_active
FROM stg_products LEFT JOIN product_categories ON upper(trim(category)) = upper(trim(category_name))
"""
CTES["facts"] = """
SELECT sha256(upper(trim(e.order_id))) AS order_sk, e.order_id, e.customer_id, v.customer_sk,
  e.order_date AS order_date_day, CAST(strftime(e.order_date, '%Y%m%d') AS BIGINT) AS order_date_key,
  order_month, order_year, order_quarter, order_day_of_week, order_status, payment_method,
  billing_country_code, e.country_code AS customer_country_code, e.customer_segment,
  e.acquisition_channel, customer_type_at_order, is_completed, order_amount_usd, revenue_usd,
  items_total_usd, discounted_items_total_usd, avg_discount_pct,
  coalesce(revenue_usd, 0) - coalesce(discounted_items_total_usd, 0) AS gross_margin_usd,
  line_item_count, total_quantity, distinct_product_count, max_unit_price_usd, days_to_ship, shipped_date,
  CASE WHEN order_status = 'cancelled' THEN 1 ELSE 0 END AS is_cancelled,
  CASE WHEN order_status = 'refunded' THEN 1 ELSE 0 END AS is_refunded, _raw_loaded_at
FROM enriched e LEFT JOIN (SELECT customer_id, md5(customer_id) AS customer_sk FROM versions
  WHERE valid_to IS NULL) v ON e.customer_id = v.customer_id
"""
CTES["file_log"] = """
SELECT event_id AS log_id, 'orders/file_' || CAST(user_id AS VARCHAR) || '.csv' AS file_path,
  'ECOMMERCE' AS source_schema, 'ORDERS' AS target_table,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'IN_PROGRESS' ELSE 'SUCCESS' END AS load_status,
  CASE WHEN event_type = 'purchase' THEN CAST(trunc(value * 10) AS BIGINT) END AS rows_loaded,
  CAST(0 AS BIGINT) AS rows_rejected,
  CASE WHEN event_type = 'error' THEN 'bad row ' || props END AS error_message, ts AS started_at,
  ts + INTERVAL 90 SECOND AS completed_at
FROM events
"""
_LATEST = """
SELECT file_path, source_schema, target_table, load_status, rows_loaded, rows_rejected, completed_at,
  error_message
FROM file_log {where}
QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY started_at DESC, log_id DESC) = 1
"""
_REGISTRY = """
SELECT 'RAW' AS target_database, 'ECOMMERCE' AS target_schema, upper(event_type) AS target_table,
  'C' || k AS column_name, CASE WHEN n % 2 = 0 THEN 'string' ELSE 'bigint' END AS column_data_type,
  n % 5 <> 0 AS is_active, first_seen_at, last_seen_at, 'f' || CAST(n AS VARCHAR) AS added_via_file
FROM (SELECT event_type, props ->> '$.k' AS k, min(ts) AS first_seen_at, max(ts) AS last_seen_at,
        min(event_id) AS n FROM events {where} GROUP BY ALL)
"""
CTES["registry"] = _REGISTRY.format(where="")
CTES["held"] = _REGISTRY.format(where="WHERE ts < TIMESTAMP '2024-01-03'")
CTES["seen"] = _REGISTRY.format(where="WHERE ts >= TIMESTAMP '2024-01-03'")
CTES["mark"] = """
SELECT max(_loaded_at) - INTERVAL 3 DAY AS start FROM raw_orders WHERE _loaded_at < TIMESTAMP '1999-01-01'
"""

# Columns per model that come out as double, so decimals compare in both engines.
_DOUBLES = {
    "stg_orders": ["order_amount_usd"],
    "stg_order_items": ["line_total_usd", "discount_pct", "unit_price_usd"],
    "stg_products": ["unit_cost_usd", "list_price_usd", "margin_pct"],
    "item_totals": ["items_total_usd", "discounted_items_total_usd", "max_unit_price_usd"],
    "metrics": ["lifetime_value_usd", "max_order_value_usd"],
    "enriched": [
        "order_amount_usd", "items_total_usd", "discounted_items_total_usd", "revenue_usd",
        "max_unit_price_usd",
    ],
}
_DOUBLES["dim"] = _DOUBLES["metrics"]
_DOUBLES["products"] = _DOUBLES["stg_products"]
_DOUBLES["facts"] = _DOUBLES["enriched"] + ["gross_margin_usd"]


def _show(model: str, source: str | None = None) -> str:
    changed = [f"CAST({c} AS DOUBLE) AS {c}" for c in _DOUBLES.get(model, [])]
    replace = f" REPLACE ({', '.join(changed)})" if changed else ""
    return f"SELECT *{replace} FROM {source or model}"


FINAL: dict[str, str] = {
    "stg_orders_dedup": _show("stg_orders"),
    "stg_order_items_dedup": _show("stg_order_items"),
    "stg_products_clean": _show("stg_products"),
    "stg_customers_flatten": "SELECT * FROM stg_customers",
    "events_variant_extract": """
        SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, props ->> '$.k' AS k_text,
          CAST(NULL AS VARCHAR) AS absent FROM events""",
    "orders_enriched": _show("enriched"),
    "order_item_totals": _show("item_totals"),
    "customer_metrics": _show("metrics"),
    "rfm_scored": """
        SELECT customer_id, recency_score, frequency_score, monetary_score, rfm_score FROM scores""",
    "rfm_segments": """
        SELECT rfm_segment, count(*) AS customers,
          CAST(sum(lifetime_value_usd) AS DOUBLE) AS lifetime_value_usd,
          max(cancellation_rate_pct) AS max_cancellation_rate_pct FROM scores GROUP BY 1""",
    "rfm_best_is_high": """
        SELECT customer_id, recency_score, frequency_score, monetary_score, rfm_segment
        FROM high_scores""",
    "metrics_backfill": _show(
        "metrics", f"({_metrics_between('1997-01-01', '1997-12-31')}) m"
    ),
    "dim_products": _show("products"),
    "dim_customers": _show("dim"),
    "fct_orders": _show("facts"),
    "surrogate_keys": """
        SELECT 'order' AS kind, sha256(upper(trim(coalesce(order_id, '_null_')))) AS sk,
          md5(customer_id) AS customer_sk FROM raw_orders
        UNION ALL
        SELECT 'line', sha256(upper(trim(coalesce(order_id, '_null_'))) || '||'
          || upper(trim(coalesce(product_id, '_null_')))), NULL FROM raw_order_items""",
    "date_keys": """
        SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
          CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
          CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start,
          dayofweek(o_orderdate) AS day_of_week, quarter(o_orderdate) AS quarter,
          strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp FROM orders""",
    "safe_cast_defaults": """
        SELECT event_id, CAST(coalesce(TRY_CAST(raw AS DECIMAL(18,2)), 0) AS DOUBLE) AS amount,
          CAST(TRY_CAST(raw AS DECIMAL(18,2)) AS DOUBLE) AS amount_or_null,
          CAST(NULL AS DATE) AS day, CASE WHEN event_id % 3 <> 0 THEN raw END AS text
        FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN event_type || '!'
                ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS raw FROM events)""",
    "union_pad_columns": """
        SELECT order_id, order_status, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd,
          CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS DOUBLE) AS margin_pct FROM stg_orders
        UNION ALL SELECT NULL, NULL, NULL, product_id, margin_pct FROM stg_products""",
    "column_names": """
        SELECT 'orders' AS relation,
          'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
          count(*) AS row_count FROM orders
        UNION ALL
        SELECT 'lineitem', 'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,'
          || 'l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate', count(*) FROM lineitem""",
    "incremental_lookback": _show(
        "stg_orders", f"({_orders_when('_loaded_at >= (SELECT start FROM mark)')}) s"
    ),
    "lookback_skipped": """
        SELECT _source_file, count(*) AS skipped FROM raw_orders
        WHERE _loaded_at < (SELECT start FROM mark) GROUP BY 1""",
    "upsert_orders": f"""
        WITH target AS ({_orders_when("_loaded_at < TIMESTAMP '1999-01-01'")}),
        delta AS ({_orders_when("_loaded_at >= (SELECT start FROM mark)")})
        {_show("stg_orders", "delta")} UNION ALL
        {_show("stg_orders", "target")} WHERE order_id NOT IN (SELECT order_id FROM delta)""",
    "stored_upsert_partitions": f"""
        WITH target AS ({_orders_when("_loaded_at < TIMESTAMP '1999-01-01'")}),
        delta AS ({_orders_when("_loaded_at >= (SELECT start FROM mark)")}),
        merged AS ({_show("stg_orders", "delta")} UNION ALL
          {_show("stg_orders", "target")} WHERE order_id NOT IN (SELECT order_id FROM delta))
        SELECT *, unnest(['buckets', 'months']) AS layout FROM merged""",
    "upsert_newer_wins": _show("stg_orders"),
    "upsert_new_columns": """
        SELECT product_id, CASE WHEN margin_pct >= 60 THEN upper(product_name) ELSE product_name END
          AS product_name, category, CASE WHEN margin_pct >= 60 THEN margin_pct END AS margin_pct
        FROM stg_products""",
    "fct_late_lines": """
        SELECT order_id, order_status, CAST(revenue_usd AS DOUBLE) AS revenue_usd, _raw_loaded_at
        FROM facts WHERE _raw_loaded_at >= TIMESTAMP '1998-12-29' OR order_id IN
          (SELECT order_id FROM stg_order_items WHERE _raw_loaded_at >= TIMESTAMP '1998-12-29')""",
    "scd2_snapshot": "SELECT * FROM versions_kept",
    "scd2_hard_delete": "SELECT * FROM versions_deleted",
    "scd2_check_strategy": """
        SELECT x.*, md5(customer_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS version_id
        FROM (
          SELECT f.customer_id, f.customer_updated_at, f.customer_segment, f.country_code,
            TIMESTAMP '2001-01-01' AS version_updated_at, TIMESTAMP '2001-01-01' AS valid_from,
            CASE WHEN f.customer_segment IS DISTINCT FROM s.customer_segment
              OR f.country_code IS DISTINCT FROM s.country_code THEN TIMESTAMP '2001-06-01' END AS valid_to
          FROM first_customers f JOIN stg_customers s ON f.customer_id = s.customer_id
          UNION ALL
          SELECT s.customer_id, s.customer_updated_at, s.customer_segment, s.country_code,
            TIMESTAMP '2001-06-01', TIMESTAMP '2001-06-01', NULL
          FROM first_customers f JOIN stg_customers s ON f.customer_id = s.customer_id
          WHERE f.customer_segment IS DISTINCT FROM s.customer_segment
            OR f.country_code IS DISTINCT FROM s.country_code) x""",
    "scd2_as_of_join": """
        SELECT o.order_id, o.customer_id, o.order_date, v.customer_segment AS segment_then, v.valid_from,
          v.valid_to
        FROM stg_orders o LEFT JOIN versions_deleted v ON o.customer_id = v.customer_id
          AND o.order_date >= v.valid_from AND (v.valid_to IS NULL OR o.order_date < v.valid_to)""",
    "revenue_by_region_month": """
        SELECT coalesce(region, 'Unknown') AS region, order_month, count(*) AS order_count,
          CAST(sum(revenue_usd) AS DOUBLE) AS revenue_usd
        FROM enriched LEFT JOIN country_codes c ON billing_country_code = c.country_code GROUP BY 1, 2""",
    "new_vs_returning": """
        SELECT customer_type_at_order, order_year, count(*) AS order_count,
          CAST(sum(revenue_usd) AS DOUBLE) AS revenue_usd FROM enriched GROUP BY 1, 2""",
    "rolling_spend_alert": """
        WITH daily AS (SELECT CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS spend
          FROM events GROUP BY 1)
        SELECT a.day, CAST(a.spend AS DOUBLE) AS spend, CAST(sum(b.spend) AS DOUBLE) AS earlier_spend,
          count(b.day) AS earlier_days,
          coalesce(a.spend * count(b.day) * 100 > sum(b.spend) * 101, FALSE) AS is_alert
        FROM daily a LEFT JOIN daily b ON b.day >= a.day - 7 AND b.day < a.day GROUP BY a.day, a.spend""",
    "dq_unique": """
        SELECT order_item_id, count(*) AS row_count FROM raw_order_items GROUP BY 1 HAVING count(*) > 1""",
    "dq_accepted_values": f"""
        SELECT customer_id, customer_segment FROM stg_customers
        WHERE customer_segment NOT IN {_in(measures.CUSTOMER_SEGMENTS)}""",
    "dq_between": """
        SELECT order_item_id, quantity FROM stg_order_items WHERE quantity NOT BETWEEN 5 AND 45""",
    "dq_relationships": """
        SELECT order_id, customer_id FROM stg_orders o WHERE customer_id IS NOT NULL AND NOT EXISTS
          (SELECT 1 FROM stg_customers c WHERE c.customer_id = o.customer_id)""",
    "dq_pair_ge": """
        SELECT product_id, CAST(list_price_usd AS DOUBLE) AS list_price_usd,
          CAST(unit_cost_usd AS DOUBLE) AS unit_cost_usd
        FROM stg_products WHERE list_price_usd < unit_cost_usd""",
    "dq_row_count": """
        SELECT count(*) AS row_count FROM stg_orders HAVING count(*) NOT BETWEEN 1 AND 10""",
    "dq_date_anomaly": """
        SELECT order_id, order_date, shipped_date FROM stg_orders WHERE shipped_date < order_date""",
    "dq_duplicate_keys": """
        SELECT sha256(upper(trim(coalesce(order_id, '_null_')))) AS order_sk, count(*) AS row_count
        FROM raw_orders GROUP BY order_id HAVING count(*) > 1""",
    "dq_orphan_orders": """
        SELECT order_id, customer_id, order_date_day, order_status FROM facts
        WHERE customer_sk IS NULL AND order_date_day < TIMESTAMP '2001-08-31 18:00:00'""",
    "dq_revenue_reconciliation": """
        SELECT order_id, CAST(header AS DOUBLE) AS header_revenue_usd,
          CAST(lines AS DOUBLE) AS computed_revenue_usd, CAST(gap AS DOUBLE) AS abs_diff,
          CASE WHEN header > 0 THEN CAST(gap AS DOUBLE) / CAST(header AS DOUBLE) * 100 ELSE 0 END AS pct_diff
        FROM (SELECT e.order_id, e.order_amount_usd AS header, t.lines,
                abs(e.order_amount_usd - coalesce(t.lines, 0)) AS gap
              FROM enriched e LEFT JOIN (SELECT order_id, sum(line_total_usd) AS lines
                FROM stg_order_items GROUP BY 1) t ON e.order_id = t.order_id WHERE e.is_completed)
        WHERE gap > 1 AND CASE WHEN header > 0 THEN gap * 100 > header * 5 ELSE FALSE END""",
    "dq_freshness": """
        SELECT source, newest AS max_loaded_at,
          CAST(floor(epoch(now - newest) / 3600) AS BIGINT) AS age_hours,
          CASE WHEN newest IS NULL OR newest < now - INTERVAL 24 HOUR THEN 'error'
               WHEN newest < now - INTERVAL 12 HOUR THEN 'warn' ELSE 'pass' END AS status
        FROM (
          SELECT 'purchase' AS source, max(ts) AS newest, TIMESTAMP '2024-01-20 12:30:00' AS now FROM events
          WHERE event_type = 'purchase' AND ts <= TIMESTAMP '2024-01-20 12:30:00'
          UNION ALL SELECT 'click', max(ts), TIMESTAMP '2024-01-31 15:00:00' FROM events
          WHERE event_type = 'click' AND ts <= TIMESTAMP '2024-01-31 15:00:00'
          UNION ALL SELECT 'view', max(ts), TIMESTAMP '2024-02-01 15:00:00' FROM events
          WHERE event_type = 'view' AND ts <= TIMESTAMP '2024-02-01 15:00:00'
          UNION ALL SELECT 'signup', max(ts), TIMESTAMP '2024-01-31 02:00:00' FROM events
          WHERE event_type = 'signup' AND ts <= TIMESTAMP '2024-01-31 02:00:00'
          UNION ALL SELECT 'error', max(ts), TIMESTAMP '2024-03-01 00:00:00' FROM events
          WHERE event_type = 'error' AND ts <= TIMESTAMP '2024-03-01 00:00:00')""",
    "mask_by_role": """
        SELECT customer_id, email AS email_transformer, phone AS phone_transformer,
          last_name AS last_name_transformer, CAST(year(date_of_birth) AS BIGINT) AS birth_transformer,
          '****@' || split_part(email, '@', 2) AS email_analyst,
          '***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone_analyst,
          '***MASKED***' AS last_name_analyst, CAST(-1 AS BIGINT) AS birth_analyst,
          '***MASKED***' AS email_loader, '***MASKED***' AS phone_loader,
          '***MASKED***' AS last_name_loader, CAST(-1 AS BIGINT) AS birth_loader,
          left(email, 1) || '****@' || split_part(email, '@', 2) AS email_first_letter
        FROM stg_customers""",
    "masked_customers": """
        SELECT customer_id, '****@' || split_part(email, '@', 2) AS email,
          '***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone, country_code
        FROM stg_customers""",
    "row_access": """
        SELECT c_custkey, 'tenant_' || CAST(c_nationkey AS VARCHAR) AS tenant_id FROM customer
        WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""",
    "safe_customer_view": """
        SELECT customer_sk, customer_id, '****@' || split_part(email, '@', 2) AS email, country_code,
          customer_segment, CAST(lifetime_value_usd AS DOUBLE) AS lifetime_value_usd, total_orders,
          first_order_date, last_order_date, is_active
        FROM dim WHERE is_active""",
    "latest_file_status": _LATEST.format(where=""),
    "files_pending_retry": f"""
        SELECT * FROM ({_LATEST.format(where="WHERE started_at <= TIMESTAMP '2024-01-20 12:30:00'")})
        WHERE load_status = 'FAILED'
          AND datediff('hour', completed_at, TIMESTAMP '2024-01-20 12:30:00') >= 1""",
    "new_files_anti_join": """
        SELECT DISTINCT 'orders/file_' || CAST(user_id * 2 AS VARCHAR) || '.csv' AS file_path FROM events
        WHERE user_id * 2 NOT IN
          (SELECT user_id FROM events WHERE event_type IN ('view', 'purchase', 'signup'))""",
    "schema_registry_merge": """
        SELECT h.target_database, h.target_schema, h.target_table, h.column_name, h.column_data_type,
          CASE WHEN s.column_name IS NOT NULL THEN TRUE ELSE h.is_active END AS is_active,
          h.first_seen_at, coalesce(s.last_seen_at, h.last_seen_at) AS last_seen_at, h.added_via_file
        FROM held h LEFT JOIN seen s ON h.target_table = s.target_table AND h.column_name = s.column_name
        UNION ALL
        SELECT s.* FROM seen s WHERE NOT EXISTS (SELECT 1 FROM held h
          WHERE h.target_table = s.target_table AND h.column_name = s.column_name)""",
    "schema_drift_report": """
        SELECT target_database, target_schema, target_table, column_name, column_data_type, first_seen_at,
          added_via_file FROM registry WHERE is_active
        ORDER BY target_table, first_seen_at, column_name""",
    "task_run_seconds": """
        SELECT log_id, started_at, completed_at,
          datediff('second', started_at, completed_at) AS execution_seconds FROM file_log""",
    "stream_dedup_upsert": _show("stg_order_items"),
    "stream_batches_upsert": _show("stg_order_items"),
    "ingest_csv_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN early THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
          CASE WHEN o_orderkey % {TWO_LINES} = 2 THEN o_orderpriority || ', " said' || chr(10) || o_orderstatus
            WHEN o_orderkey % 11 = 4 THEN o_orderstatus || ' 5" wide' ELSE o_orderpriority END AS note,
          CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS order_amount, CAST(o_orderdate AS DATE) AS order_date,
          CASE WHEN NOT early THEN o_custkey % 9 END AS coupon, CASE WHEN early THEN 'first' ELSE 'second' END AS _ingestion_run_id
        FROM (SELECT *, o_orderdate < TIMESTAMP '1998-01-01' AS early FROM orders)
        WHERE o_orderkey % {BROKEN} <> 3 AND o_orderkey % {NO_NUMBER} <> 5""",
    "ingest_csv_drift": f"""
        SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'early' ELSE 'late' END AS layout, o_orderkey % {FILES} AS part,
          count(*) FILTER (WHERE o_orderkey % {BROKEN} <> 3 AND o_orderkey % {NO_NUMBER} <> 5) AS rows_loaded,
          count(*) FILTER (WHERE o_orderkey % {BROKEN} = 3 OR o_orderkey % {NO_NUMBER} = 5) AS rows_rejected, 'SUCCESS' AS load_status
        FROM orders GROUP BY 1, 2""",
    "ingest_json_layouts": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment AS segment, '{{[ "' || c_mktsegment AS bracket,
          CAST(c_nationkey AS BIGINT) AS nation
        FROM customer WHERE c_custkey % 4 <> 3 OR (c_custkey % 53 <> 7 AND (c_custkey % 59 <> 31 OR (c_custkey - 4 * {FILES}) % 53 = 7))""",
    "ingest_json_log": f"""
        SELECT layout, part, count(*) FILTER (WHERE good) AS rows_loaded,
          count(*) FILTER (WHERE NOT good) + CASE WHEN layout = 'broken' THEN 1 ELSE 0 END AS rows_rejected, 'SUCCESS' AS load_status
        FROM (SELECT ['lines', 'array', 'joined', 'broken'][c_custkey % 4 + 1] AS layout, c_custkey // 4 % {FILES} AS part,
            c_custkey % 4 <> 3 OR (c_custkey % 53 <> 7 AND (c_custkey % 59 <> 31 OR (c_custkey - 4 * {FILES}) % 53 = 7)) AS good FROM customer)
        GROUP BY layout, part""",
}


# --- the declared checks, counted ---------------------------------------------------------------

_CHECKED = {"fct_orders": "facts", "dim_customers": "dim", "dim_products": "products"}


def _failures(check) -> str:
    table, column = _CHECKED.get(check.table, check.table), check.column
    if check.kind == "not_null":
        return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    if check.kind == "unique":
        keys = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        return f"SELECT count(*) FROM ({keys})"
    if check.kind == "accepted_values":
        return f"SELECT count(*) FROM {table} WHERE {column} NOT IN {_in(check.values)}"
    if check.kind == "between":
        above = "" if check.high is None else f" OR {column} > {check.high}"
        return f"SELECT count(*) FROM {table} WHERE {column} < {check.low}{above}"
    if check.kind == "relationships":
        parent = _CHECKED.get(check.to[0], check.to[0])
        known = f"SELECT 1 FROM {parent} p WHERE p.{check.to[1]} = c.{column}"
        return f"SELECT count(*) FROM {table} c WHERE {column} IS NOT NULL AND NOT EXISTS ({known})"
    return {
        "no_duplicate_order_keys":
            "SELECT count(*) FROM (SELECT order_sk FROM facts GROUP BY 1 HAVING count(*) > 1)",
        "orders_have_valid_customers": f"SELECT count(*) FROM ({FINAL['dq_orphan_orders']})",
        "revenue_matches_line_items": """
            SELECT count(*) FROM facts f LEFT JOIN item_totals t ON f.order_id = t.order_id
            WHERE f.is_completed AND f.revenue_usd > 0
              AND abs(f.revenue_usd - coalesce(t.items_total_usd, 0)) > 1
              AND abs(f.revenue_usd - coalesce(t.items_total_usd, 0)) * 100 > f.revenue_usd * 5""",
    }[check.kind]


def _suite(chosen: list) -> str:
    rows = [
        f"SELECT '{c.table}' AS model_name, '{c.kind}' AS test_name, "
        f"{repr(c.column) if c.column else 'CAST(NULL AS VARCHAR)'} AS test_column, "
        f"'{c.severity}' AS severity, ({_failures(c)}) AS failures"
        for c in chosen
    ]
    status = "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'error' END"
    return f"SELECT *, {status} AS status FROM ({' UNION ALL '.join(rows)})"


FINAL["dq_suite"] = _suite(checks.all_checks(AS_OF_TS))
FINAL["dq_not_null"] = _suite([c for c in checks.SOURCE_CHECKS if c.table == "raw_orders"])


def _with_ctes(final: str) -> str:
    needed: list[str] = []
    visiting: set[str] = set()

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in visiting and re.search(rf"\b{name}\b", text):
                visiting.add(name)
                visit(body)
                needed.append(name)

    visit(final)
    if not needed:
        return final.strip()
    head = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in needed)
    return f"WITH {head}\nSELECT * FROM ({final.strip()}) result"


def statements() -> dict[str, str]:
    return {name: _with_ctes(text) for name, text in FINAL.items()}
