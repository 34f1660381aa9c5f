"""The whole run over landed files: increments, late rows, checks."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tradewind.operators.governance import safe_customer_view
from tradewind.operators.quality import GateError
from tradewind.plans.run import RunConfig, Warehouse

T0 = datetime(2024, 3, 1, 6)
ORDER_COLUMNS = "ORDER_ID,CUSTOMER_ID,ORDER_STATUS,ORDER_AMOUNT,ORDER_DATE,SHIPPED_DATE,PAYMENT_METHOD,BILLING_COUNTRY"
ITEM_COLUMNS = "ORDER_ITEM_ID,ORDER_ID,PRODUCT_ID,QUANTITY,UNIT_PRICE,DISCOUNT_PCT"
PRODUCT_COLUMNS = "PRODUCT_ID,PRODUCT_NAME,CATEGORY,BRAND,UNIT_COST,LIST_PRICE,IS_ACTIVE"


def land(folder, entity, name, text):
    path = folder / entity / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def customer(i, segment="gold", updated="2024-01-10T00:00:00Z", **extra):
    return {
        "customer_id": f"C{i}", "email": f"u{i}@example.com", "phone": f"+1-555-010{i}", "country": "us",
        "first_name": f"F{i}", "last_name": f"L{i}", "date_of_birth": "1990-01-01",
        "customer_segment": segment, "acquisition_channel": "email", "is_email_verified": True,
        "created_at": "2024-02-01T10:00:00Z", "updated_at": updated, **extra,
    }


def first_delivery(folder):
    orders = [
        "O1,C1,Completed,100,2024-02-01,2024-02-03,card,US", "O2,C2,shipped,50,2024-02-02,2024-02-01,card,GB",
        "O3,C3,pending,70,2024-02-10,,card,FR", "O4,C1,cancelled,20,2024-02-20,,card,US",
    ]
    items = ["I1,O1,P1,2,10.00,0", "I2,O1,P2,1,5.50,10", "I3,O3,P1,1,10.00,0"]
    products = ["P1,Phone,Mobile Phones,Acme,5,10,TRUE", "P2,Thing,Unknown Things,Acme,4,5.5,", "P3,Free,Toys & Games,Acme,1,0,FALSE"]
    land(folder, "orders", "o1.csv", "\n".join([ORDER_COLUMNS, *orders]) + "\n")
    land(folder, "order_items", "i1.csv", "\n".join([ITEM_COLUMNS, *items]) + "\n")
    land(folder, "products", "p1.csv", "\n".join([PRODUCT_COLUMNS, *products]) + "\n")
    land(folder, "customers", "c1.json", json.dumps([customer(i) for i in (1, 2, 3)], indent=1))


def second_delivery(folder):
    land(folder, "orders", "o2.csv", f"{ORDER_COLUMNS}\nO3,C3,shipped,70,2024-02-10,2024-02-12,card,FR\nO5,C9,completed,33,2024-02-25,,card,US\n")
    land(folder, "order_items", "i2.csv", f"{ITEM_COLUMNS}\nI4,O1,P1,1,1000.00,0\nI3,O3,P1,3,10.00,0\n")
    changed = [customer(1, "vip", "2024-03-01T00:00:00Z"), customer(4)]
    land(folder, "customers", "c2.json", "\n".join(json.dumps(c) for c in changed) + "\n")


def config(n, **options):
    return RunConfig(f"run{n}", T0 + timedelta(hours=n), **options)


def facts(warehouse, *columns):
    return {r.order_id: r for r in warehouse.fct_orders().read().collect()}


def test_two_runs(spark, tmp_path):
    landing = tmp_path / "landing"
    first_delivery(landing)
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    done = warehouse.run(str(landing), config(0))
    assert [r["status"] for r in done["loads"]] == ["SUCCESS"] * 4
    assert len(done["checks"]) == 68 and {r.status for r in done["freshness"]} == {"pass"}
    rows = facts(warehouse)
    assert set(rows) == {"O1", "O3", "O4"}
    assert float(rows["O1"].revenue_usd) == 25.5 and float(rows["O4"].revenue_usd) == 20
    assert float(rows["O1"].gross_margin_usd) == 20 and rows["O1"].customer_type_at_order == "new"
    tiers = {r.product_id: (r.margin_tier, r.parent_category) for r in warehouse.dim_products().read().collect()}
    assert tiers == {"P1": ("high", "Electronics"), "P2": ("medium", "Uncategorized"), "P3": ("low", "General")}

    again = warehouse.run(str(landing), config(1))
    assert [r["status"] for r in again["loads"]] == ["NO_NEW_FILES"] * 4
    assert facts(warehouse).keys() == rows.keys()

    second_delivery(landing)
    with pytest.raises(GateError, match="orders_have_valid_customers"):
        warehouse.run(str(landing), config(2))
    rows = facts(warehouse)
    # A line that came later than its order's look-back window would be missed; here it is inside.
    assert float(rows["O1"].revenue_usd) == 1025.5 and float(rows["O3"].revenue_usd) == 30
    assert rows["O5"].customer_sk is None
    history = Counter(r.customer_id for r in warehouse.snapshot().read().collect())
    assert history == {"C1": 2, "C2": 1, "C3": 1, "C4": 1}
    failures = spark.read.parquet(f"{tmp_path}/wh/checks/failures/orders_have_valid_customers_fct_orders")
    assert [r.order_id for r in failures.collect()] == ["O5"]
    assert spark.read.parquet(f"{tmp_path}/wh/checks/results").count() == 68 * 3
    view = {r.customer_id: r.email for r in safe_customer_view(warehouse.dim_customers().read(), "ANALYST").collect()}
    assert view == {"C1": "****@example.com", "C3": "****@example.com"}

    # An increment inside the look-back equals a full refresh of the same raw rows.
    full = Warehouse(spark, f"{tmp_path}/wh")
    before = {k: r.asDict() for k, r in rows.items()}
    with pytest.raises(GateError):
        full.run(str(landing), config(2, full_refresh=True))
    assert {k: r.asDict() for k, r in facts(full).items()} == before


def test_late_lines_refresh_the_fact_only_when_asked(spark, tmp_path):
    landing = tmp_path / "landing"
    first_delivery(landing)
    warehouse = Warehouse(spark, f"{tmp_path}/wh")
    warehouse.run(str(landing), config(0))
    land(landing, "orders", "o3.csv", f"{ORDER_COLUMNS}\nO6,C2,completed,5,2024-03-08,,card,US\n")
    warehouse.run(str(landing), config(24 * 10, stop_on_error=False))
    land(landing, "order_items", "i9.csv", f"{ITEM_COLUMNS}\nI9,O1,P1,1,1000.00,0\n")
    warehouse.run(str(landing), config(24 * 10 + 1, stop_on_error=False))
    assert float(facts(warehouse)["O1"].revenue_usd) == 25.5
    done = warehouse.run(str(landing), config(24 * 10 + 2, touch_late_lines=True, stop_on_error=False))
    assert float(facts(warehouse)["O1"].revenue_usd) == 1025.5
    assert done["rows_too_old"]["orders"] == 4
