from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from plumbline.operators import checks, cleaning, kpi, recon
from plumbline.sources.contracts import Policy

AT = dt.datetime(2026, 9, 5, 6, 3)
CUSTOMER = "customer_id string, customer_name string, segment string, status string, created_date string"
ORDER = "order_id string, customer_id string, order_date string, order_amount string, currency string, category string"
CONTROL = "control_date string, source_system string, order_count string, order_amount string, currency string"


def suite(spark, customers, orders, controls, policy=Policy(), mode="quarantine", **more):
    raw = {
        "customers": spark.createDataFrame(customers, CUSTOMER),
        "sales_orders": spark.createDataFrame(orders, ORDER),
        "gl_controls": spark.createDataFrame(controls, CONTROL),
    }
    clean = {name: cleaning.clean(cleaning.parse(df, name), mode) for name, df in raw.items()}
    return checks.check_suite(clean, raw, AT, policy, **more)


def by_id(df):
    return {r.check_id: (r.status, r.observed, r.expected) for r in df.collect()}


GOOD_CUSTOMERS = [("c-1", "A", "smb", "active", "2024-01-01"), ("c-2", "B", "mid-market", "inactive", "2024-01-01")]
GOOD_ORDERS = [("so-1", "c1", "2026-08-30", "10.00", "usd", "online"), ("so-2", "c2", "2026-08-30", "5.50", "usd", "retail")]
GOOD_CONTROLS = [("2026-08-30", "erp", "2", "15.50", "usd")]


def test_all_controls_pass_on_good_data(spark):
    found = by_id(suite(spark, GOOD_CUSTOMERS, GOOD_ORDERS, GOOD_CONTROLS))
    assert len(found) == 14 and {s for s, _, _ in found.values()} == {"PASS"}
    assert found["RECON_ORDER_VALUE"] == ("PASS", "15.50", "15.50")
    assert found["NULL_CUSTOMERS"] == ("PASS", "0", "<= 0")


def test_each_control_fails_on_its_fault(spark):
    customers = [*GOOD_CUSTOMERS, ("C2", " ", "crypto", "active", "2024-01-01"), (None, "D", None, "gone", "2024-01-01")]
    orders = [
        *GOOD_ORDERS,
        ("SO1", "c-999", "2026-08-30", "0", "usd", "online"),
        ("so-3", None, "2026-08-30", "1000000.01", "eur", "crypto"),
        ("so-4", "c1", "2026-08-30", "1000000", "usd", None),
        ("so-5", "c1", "not a day", "1", "usd", "online"),
    ]
    found = by_id(suite(spark, customers, orders, GOOD_CONTROLS))
    assert found["NULL_CUSTOMERS"][:2] == ("FAIL", "3")  # a name, an id, a segment
    assert found["NULL_SALES_ORDERS"][:2] == ("FAIL", "2")  # a customer, a category
    assert found["DUP_CUSTOMERS"][:2] == ("FAIL", "1")
    assert found["DUP_SALES_ORDERS"][:2] == ("FAIL", "1")
    assert found["RANGE_ORDER_AMOUNT"][:2] == ("FAIL", "2")
    assert found["VALID_ENUMS"][:2] == ("FAIL", "4")  # two customers, two orders: rows, not cells
    assert found["FK_ORDER_CUSTOMER"][:2] == ("FAIL", "2")  # an unknown and a NULL customer
    assert found["RECON_ROW_COUNT"] == ("FAIL", "5", "6")
    assert found["RECON_ORDER_COUNT"] == ("FAIL", "5", "2")
    assert found["RECON_ORDER_VALUE"][0] == "FAIL"


def test_null_keys_count_as_one_key(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,)], "k int")
    assert df.agg(checks.duplicate_rows("k")).first()[0] == 2


def test_thresholds_and_warnings(spark):
    customers = [("c-1", "A", "smb", "active", "2024-01-01"), ("c-2", None, "smb", "active", "2024-01-01")]
    relaxed = Policy(null_threshold={"customers": Decimal("0.1")}, warn_limit={"RECON_ORDER_COUNT": 1, "DUP_SALES_ORDERS": 5})
    orders = [*GOOD_ORDERS, ("so-2", "c2", "2026-08-30", "0.01", "usd", "retail")]
    df = suite(spark, customers, orders, GOOD_CONTROLS, relaxed)
    found = by_id(df)
    assert found["NULL_CUSTOMERS"] == ("PASS", "1", "<= 1")
    assert found["DUP_SALES_ORDERS"][0] == "WARN"
    assert found["RECON_ORDER_COUNT"][0] == "WARN"
    assert found["RECON_ORDER_VALUE"][0] == "FAIL"
    listed = {r.check_id: r.evaluated_at_utc for r in kpi.quality_exceptions(df).collect()}
    assert set(listed) == {"DUP_SALES_ORDERS", "RECON_ORDER_COUNT", "RECON_ORDER_VALUE"}
    assert [r.check_id for r in recon.check_exceptions(df).collect()] == ["RECON_ORDER_VALUE"]
    assert df.agg(kpi.pass_rate(df["status"])).first()[0] == Decimal("78.57")


def test_fractional_null_limit_is_shown_plainly(spark):
    relaxed = Policy(null_threshold={"gl_controls": Decimal("0.25")})
    assert by_id(suite(spark, GOOD_CUSTOMERS, GOOD_ORDERS, GOOD_CONTROLS, relaxed))["NULL_GL_CONTROLS"][2] == "<= 1.25"


def test_missing_columns_fail_their_control(spark):
    columns = {"customers": ["customer_id"], "sales_orders": ORDER.replace(" string", "").split(", "), "gl_controls": ["x"]}
    found = by_id(suite(spark, GOOD_CUSTOMERS, GOOD_ORDERS, GOOD_CONTROLS, raw_columns=columns))
    assert found["REQ_CUSTOMERS"][:2] == ("FAIL", "missing: created_date, customer_name, segment, status")
    assert found["REQ_SALES_ORDERS"][0] == "PASS"


def test_empty_datasets_are_measured_as_zero(spark):
    found = by_id(suite(spark, [], [], []))
    assert {s for s, _, _ in found.values()} == {"PASS"}
    assert found["RECON_ORDER_VALUE"] == ("PASS", "0.00", "0.00")


def test_freshness_of_files(spark):
    ages = lambda *rows: spark.createDataFrame(list(rows), "file_name string, age_days int")
    fresh = checks.freshness(ages(("b.csv", 7), ("a.csv", 2)), Policy()).first()
    assert (fresh.status, fresh.observed, fresh.expected) == ("PASS", "7 days", "<= 7 days")
    assert fresh.detail == '[["a.csv", 2], ["b.csv", 7]]'
    assert checks.freshness(ages(("b.csv", 8)), Policy()).first().status == "FAIL"
    parts = checks.freshness(ages(("b.csv/1.csv", 3), ("b.csv/2.csv", 9), ("a.csv", 2)), Policy()).first()
    assert (parts.status, parts.detail) == ("FAIL", '[["a.csv", 2], ["b.csv", 9]]')
    assert checks.freshness(ages(), Policy()).first().status == "FAIL"


def test_gate_names_what_failed(spark):
    good = suite(spark, GOOD_CUSTOMERS, GOOD_ORDERS, GOOD_CONTROLS)
    checks.gate(good)
    with pytest.raises(checks.GateFailed, match="RECON_ORDER_COUNT, RECON_ORDER_VALUE"):
        checks.gate(suite(spark, GOOD_CUSTOMERS, GOOD_ORDERS, [("2026-08-30", "erp", "3", "15.00", "usd")]))
