"""Landed files to raw tables: drift, rejects, logs, interrupted runs."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from tradewind.operators import control
from tradewind.sources import landing
from tradewind.sources.ingest import RawZone
from tradewind.sources.landing import EntitySource

T0 = datetime(2024, 1, 1, 8)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def zone(spark, tmp_path):
    return RawZone(spark, f"{tmp_path}/zone")


@pytest.fixture
def orders(tmp_path):
    return EntitySource("orders", f"{tmp_path}/landing/orders", "csv")


HEADER = "ORDER_ID,CUSTOMER_ID,ORDER_STATUS,ORDER_AMOUNT,ORDER_DATE,SHIPPED_DATE,PAYMENT_METHOD,BILLING_COUNTRY"


def rows(zone, entity):
    return {r[0]: r for r in zone.read(entity).collect()}


def load(zone, source, run, at=T0):
    inferred = zone.infer_and_evolve(source, run, at)
    assert inferred["status"] == "SUCCESS", inferred
    return inferred, zone.load_new_files(source, run, at)


def test_csv_load_rejects_and_is_not_repeated(zone, orders, tmp_path):
    write(
        tmp_path / "landing/orders/a.csv",
        f"{HEADER}\n"
        'O1, C1 ,completed,10.50,2024-01-01,2024-01-02,"card, new",US\n'
        "O2,C2,pending,abc,2024-01-01,,card,US\n"
        "O3,C3,pending,NA,2024-01-01,NULL,N/A,null\n"
        "O4,C4,shipped,5\n"
        "O5,C5,shipped,6,2024-01-05,,card,US,extra,extra\n",
    )
    inferred, loaded = load(zone, orders, "r1")
    assert inferred["table_created"] and inferred["columns_added"] == []
    assert (loaded["rows_loaded"], loaded["rows_rejected"], loaded["status"]) == (4, 1, "SUCCESS")
    found = rows(zone, "orders")
    assert set(found) == {"O1", "O3", "O4", "O5"}
    assert found["O1"]["customer_id"] == "C1" and found["O1"]["payment_method"] == "card, new"
    assert found["O3"]["order_amount"] is None and found["O3"]["billing_country"] is None
    assert found["O4"]["order_date"] is None
    assert found["O1"]["_source_file"].endswith("a.csv") and found["O1"]["_ingestion_run_id"] == "r1"
    assert zone.load_new_files(orders, "r2", T0)["status"] == "NO_NEW_FILES"
    latest = control.latest_file_status(zone.file_log()).collect()
    assert [(r["load_status"], r["rows_loaded"], r["rows_rejected"]) for r in latest] == [("SUCCESS", 4, 1)]


def test_new_columns_other_order_and_type_change(zone, orders, tmp_path):
    write(tmp_path / "landing/orders/a.csv", f"{HEADER}\nO1,C1,completed,10,2024-01-01,,card,US\n")
    load(zone, orders, "r1")
    write(tmp_path / "landing/orders/b.csv", "order_amount,Order_Id,coupon\n7.25,O2,12\n8,O3,\n")
    write(tmp_path / "landing/orders/c.csv", "order_id,order_date\nO4,yesterday\n")
    inferred, loaded = load(zone, orders, "r2", T0 + timedelta(hours=1))
    assert inferred["columns_added"] == [{"column": "coupon", "type": "bigint"}]
    assert inferred["type_changes"] == [{"column": "order_date", "type": "date"}]
    assert (loaded["rows_loaded"], loaded["rows_rejected"], loaded["files_processed"]) == (2, 1, 2)
    found = rows(zone, "orders")
    assert float(found["O2"]["order_amount"]) == 7.25 and found["O2"]["coupon"] == 12
    assert found["O1"]["coupon"] is None
    registry = {r["column_name"]: r for r in zone.registry().collect()}
    assert registry["coupon"]["first_seen_at"] == T0 + timedelta(hours=1)
    assert registry["order_id"]["first_seen_at"] == T0
    failed = [r["error_message"] for r in zone.task_log().filter("status = 'FAILED'").collect()]
    assert failed == ["type change, order_date: no value fits date"]


def test_json_lines_arrays_and_pretty_files(zone, tmp_path):
    source = EntitySource("customers", f"{tmp_path}/landing/customers", "json")
    one = {"customer_id": "C1", "email": "a@b.c", "created_at": "2024-01-01T00:00:00Z", "vip": True}
    two = {"customer_id": "C2", "email": None, "note": "x, ] y"}
    write(tmp_path / "landing/customers/lines.json", json.dumps(one) + "\n" + json.dumps(two) + "\n")
    array = "[\n  " + ",\n  ".join(json.dumps({"customer_id": f"A{i}"}) for i in range(3)) + "\n]\n"
    write(tmp_path / "landing/customers/array.json", array)
    write(tmp_path / "landing/customers/pretty.json", json.dumps([{"customer_id": "P1"}], indent=2))
    _, loaded = load(zone, source, "r1")
    assert (loaded["rows_loaded"], loaded["files_processed"]) == (6, 3)
    found = rows(zone, "customers")
    assert set(found) == {"C1", "C2", "A0", "A1", "A2", "P1"}
    assert found["C1"]["created_at"] == datetime(2024, 1, 1) and found["C1"]["vip"] is True
    assert json.loads(found["C2"]["raw_payload"].toJson()) == two


def test_one_bad_file_does_not_stop_the_rest(zone, tmp_path):
    source = EntitySource("customers", f"{tmp_path}/landing/customers", "json")
    for i in range(4):
        write(tmp_path / f"landing/customers/{i}.json", json.dumps({"customer_id": f"C{i}"}) + "\n")
    write(tmp_path / "landing/customers/bad.json", "{broken\n")
    _, loaded = load(zone, source, "r1")
    assert loaded["status"] == "PARTIAL_FAILURE" and loaded["rows_loaded"] == 4
    assert [e["file"] for e in loaded["errors"]] == ["bad.json"]
    log = zone.file_log()
    soon = control.files_pending_retry(log, datetime.now())
    later = control.files_pending_retry(log, datetime.now() + timedelta(hours=3))
    assert soon.count() == 0 and [r["load_status"] for r in later.collect()] == ["FAILED"]
    # The failed file is offered again, the loaded ones are not.
    assert [r["file_name"] for r in zone.pending(source).collect()] == ["bad.json"]


def test_parquet_and_undeclared_entity(zone, spark, tmp_path):
    source = EntitySource("visits", f"{tmp_path}/landing/visits", "parquet")
    spark.sql("select 1 as Id, 'x' as Page, float(2.5) as secs").write.parquet(f"{source.path}/d1")
    load(zone, source, "r1")
    spark.sql("select 2 as Id, array(1, 2) as tags").write.parquet(f"{source.path}/d2")
    inferred, _ = load(zone, source, "r2")
    assert inferred["columns_added"] == [{"column": "tags", "type": "variant"}]
    found = rows(zone, "visits")
    assert found[1]["page"] == "x" and found[1]["secs"] == 2.5 and found[2]["page"] is None
    assert found[2]["tags"].toPython() == [1, 2]


def test_no_files_is_an_error(zone, orders, tmp_path):
    (tmp_path / "landing/orders").mkdir(parents=True)
    result = zone.infer_and_evolve(orders, "r1", T0)
    assert result["status"] == "FAILED" and "no columns inferred" in result["error"]
    assert zone.task_log().count() == 1


def test_interrupted_run_is_finished_not_repeated(zone, orders, tmp_path, monkeypatch):
    write(tmp_path / "landing/orders/a.csv", f"{HEADER}\nO1,C1,completed,10,2024-01-01,,card,US\n")
    zone.infer_and_evolve(orders, "r1", T0)
    with monkeypatch.context() as patch:
        patch.setattr(RawZone, "_log_loaded", lambda *a, **k: None)
        zone.load_new_files(orders, "r1", T0)
    assert control.latest_file_status(zone.file_log()).first()["load_status"] == "IN_PROGRESS"
    assert zone.load_new_files(orders, "r2", T0)["status"] == "NO_NEW_FILES"
    assert zone.read("orders").count() == 1
    assert control.latest_file_status(zone.file_log()).first()["load_status"] == "SUCCESS"


def test_text_types(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "1e3", "2024-01-01", "2024-01-01T10:00:00Z", "true", "007", None, "x")],
        "a string, b string, c string, d string, e string, f string, g string, h string, i string",
    )
    types = {f.name: f.dataType.simpleString() for f in landing.compare_columns(df, []).added}
    assert types == {
        "a": "bigint", "b": "decimal(38,10)", "c": "double", "d": "date", "e": "timestamp_ntz",
        "f": "boolean", "g": "string", "h": "string", "i": "string",
    }


def test_latest_run_gate(spark):
    log = spark.createDataFrame(
        [("t", T0, T0, "FAILED"), ("t", T0 + timedelta(minutes=5), T0, "SUCCEEDED")],
        "task_name string, scheduled_at timestamp_ntz, started_at timestamp_ntz, status string",
    )
    control.require_latest_success(log, "t", T0 + timedelta(minutes=10))
    with pytest.raises(control.RunNotReady):
        control.require_latest_success(log, "t", T0 + timedelta(minutes=40))
    with pytest.raises(control.RunNotReady):
        control.require_latest_success(log.filter("status = 'FAILED'"), "t", T0 + timedelta(minutes=10))

def scanned(spark, tmp_path, kind, text, split):
    """What is read from a file of such a text, in splits of a few bytes."""
    path = tmp_path / f"file.{kind}"
    path.write_text(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = landing.scan(spark, kind, {f"file:{path}": str(path)}).drop(landing.FILE).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    good = [r.asDict() for r in found if not r[landing.UNREADABLE]]
    return good, len(found) - len(good)


@pytest.mark.parametrize("split", ["128m", "40b"])
def test_csv_records_over_lines_and_quotes_that_never_end(spark, tmp_path, split):
    text = (
        '\n\t\nid,name\n1,"a\nb ""x"" c\nd"\n2,"e, f"\n3,5" pipe\n4,"open\n5,"x, y"\n6,"p","q\n7,""\n8,"r\ns"\n9,"t""'
    )
    good, bad = scanned(spark, tmp_path, "csv", text, split)
    assert sorted((r["id"], r["name"]) for r in good) == [
        ("1", 'a\nb "x" c\nd'), ("2", "e, f"), ("3", '5" pipe'), ("5", "x, y"), ("7", None), ("8", "r\ns"),
    ]
    assert bad == 3  # records 4, 6 and 9


def test_csv_open_quote_costs_one_record(spark, tmp_path):
    good, bad = scanned(spark, tmp_path, "csv", 'id,name\n1,"abc\n2,def\n3,ghi\n4,jkl\n', "128m")
    assert (sorted(r["id"] for r in good), bad) == (["2", "3", "4"], 1)


def test_csv_header_without_names_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no column has a name"):
        scanned(spark, tmp_path, "csv", "\n,,\n1,2,3\n", "128m")


@pytest.mark.parametrize("split", ["128m", "40b"])
def test_json_records_in_any_layout(spark, tmp_path, split):
    nested = [{"id": f"P{i}", "n": [{"q": 1}, {"q": [2, {"z": "}{"}]}]} for i in range(4)]
    good, bad = scanned(spark, tmp_path, "json", json.dumps(nested, indent=2), split)
    assert (sorted(r["id"] for r in good), bad) == ([f"P{i}" for i in range(4)], 0)
    assert json.loads(good[0]["n"]) == nested[0]["n"]
    text = '{"id":1}{"id":2}\n{"id":3} {"id":\n4}\n}\n{"id":5}\nnonsense\n[{"id":6},{"id":7}]\n{"id":8,\n{"id":9}\n'
    good, bad = scanned(spark, tmp_path, "json", text, split)
    assert (sorted(r["id"] for r in good), bad) == (["1", "2", "3", "4", "5", "6", "7", "9"], 3)
    lines = '{"a":\n' + "".join(json.dumps({"id": i, "it's": i, "a.b": [i], "c[0]`x": "é}"}) + "\n" for i in range(4))
    good, bad = scanned(spark, tmp_path, "json", lines, split)
    assert bad == 1 and sorted((r["id"], r["it's"], r["a.b"], r["c[0]`x"]) for r in good) == [
        (str(i), str(i), f"[{i}]", "é}") for i in range(4)
    ]
