from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from plumbline.operators import kpi, recon, star
from conftest import rows

d = dt.date


def orders(spark, *data):
    return spark.createDataFrame(
        list(data), "order_id string, customer_id string, order_date date, order_amount decimal(18,2), currency string, category string"
    )


def customers(spark, *data):
    return spark.createDataFrame(
        list(data), "customer_id string, customer_name string, segment string, status string, created_date date"
    )


def controls(spark, *data):
    return spark.createDataFrame(
        list(data), "control_date date, source_system string, order_count bigint, order_amount decimal(18,2), currency string"
    )


@pytest.fixture()
def model(spark):
    people = customers(
        spark,
        ("C2", "B", "SMB", "ACTIVE", d(2024, 2, 10)),
        ("C1", "A", "SMB", "ACTIVE", d(2024, 1, 10)),
        ("C3", "C", "ENTERPRISE", "ACTIVE", d(2024, 1, 20)),
        ("C4", "D", "MID_MARKET", "ACTIVE", d(2024, 1, 20)),
    )
    sales = orders(
        spark,
        ("O1", "C1", d(2026, 1, 5), D("10.00"), "USD", "RETAIL"),
        ("O2", "C1", d(2026, 1, 5), D("0.01"), "USD", "ONLINE"),
        ("O3", "C2", d(2026, 1, 6), D("5.00"), "USD", "RETAIL"),
        ("O4", "C1", d(2026, 3, 1), D("30.00"), "USD", "RETAIL"),
        ("O5", "C3", d(2026, 3, 1), D("0.03"), "EUR", "ONLINE"),
    )
    booked = controls(
        spark,
        (d(2026, 1, 5), "ERP", 1, D("10.00"), "USD"),
        (d(2026, 1, 5), "CRM", 1, D("0.01"), "USD"),
        (d(2026, 1, 7), "ERP", 1, D("7.00"), "USD"),
        (d(2026, 3, 1), "ERP", 1, D("30.00"), "USD"),
    )
    dim_c, dim_g = star.dim_customer(people), star.dim_category(sales)
    return {
        "fact": star.fact_sales_order(sales, dim_c, dim_g),
        "dates": star.dim_date(sales, booked),
        "customers": dim_c,
        "categories": dim_g,
        "controls": star.fact_reconciliation_control(booked),
    }


def test_dimensions(model):
    assert rows(model["dates"]) == [
        (20260105, d(2026, 1, 5), 2026, 1, 5), (20260106, d(2026, 1, 6), 2026, 1, 6),
        (20260107, d(2026, 1, 7), 2026, 1, 7), (20260301, d(2026, 3, 1), 2026, 3, 1),
    ]
    assert [r[:2] for r in rows(model["customers"])] == [(1, "C1"), (2, "C2"), (3, "C3"), (4, "C4")]
    assert rows(model["categories"]) == [(1, "ONLINE"), (2, "RETAIL")]


def test_facts(model):
    assert rows(model["fact"])[0] == (1, "O1", 1, 20260105, 2, D("10.00"), "USD")
    assert [r[0] for r in rows(model["fact"])] == [1, 2, 3, 4, 5]
    assert rows(model["controls"])[0] == (1, 20260105, "CRM", 1, D("0.01"), "USD")
    assert model["controls"].columns == [
        "control_key", "control_date_key", "source_system", "order_count", "order_amount", "currency_code",
    ]


def test_star_orders(model):
    joined = star.star_orders(model["fact"], model["dates"], model["customers"], model["categories"])
    assert rows(joined)[4] == ("O5", d(2026, 3, 1), "ENTERPRISE", "ONLINE", D("0.03"), "EUR")
    assert joined.count() == 5


def test_daily_kpi_rounds_half_up(model):
    assert rows(kpi.daily_sales(model["fact"], model["dates"])) == [
        (d(2026, 1, 5), 2, D("10.01"), D("5.01"), 1),  # 5.005
        (d(2026, 1, 6), 1, D("5.00"), D("5.00"), 1),
        (d(2026, 3, 1), 2, D("30.03"), D("15.02"), 2),  # 15.015
    ]


def test_monthly_trend_compares_with_the_last_month_that_has_data(model):
    daily = kpi.daily_sales(model["fact"], model["dates"])
    assert rows(kpi.monthly_trend(daily)) == [
        (d(2026, 1, 1), D("15.01"), 3, 2, None, None, None),
        (d(2026, 3, 1), D("30.03"), 2, 2, D("15.01"), D("100.07"), D("-33.33")),
    ]


def test_change_against_a_zero_month_is_null(spark):
    daily = spark.createDataFrame(
        [(d(2026, 1, 1), 1, D("0.00"), 1), (d(2026, 2, 1), 1, D("5.00"), 1)],
        "calendar_date date, order_count bigint, revenue_usd decimal(28,2), active_customers bigint",
    )
    assert rows(kpi.monthly_trend(daily))[1][5:] == (None, D("0.00"))


def test_segment_kpi_counts_customers_with_orders(model):
    assert rows(kpi.segment_kpi(model["fact"], model["customers"])) == [
        ("ENTERPRISE", 1, 1, D("0.03"), D("0.03"), D("0.07")),
        ("SMB", 2, 4, D("45.01"), D("11.25"), D("99.93")),
    ]


def test_cohorts(model):
    assert rows(kpi.cohort_month(model["fact"], model["customers"], model["dates"])) == [
        (d(2024, 1, 1), d(2026, 1, 1), 1, 2, D("10.01")),
        (d(2024, 1, 1), d(2026, 3, 1), 2, 2, D("30.03")),
        (d(2024, 2, 1), d(2026, 1, 1), 1, 1, D("5.00")),
    ]


def test_daily_reconciliation(model):
    daily = recon.daily(model["fact"], model["controls"], model["dates"])
    short = daily.select(
        "calendar_date", "currency_code", "source_order_count", "curated_order_count", "order_count_variance",
        "amount_variance_usd", "reconciliation_status",
    )
    assert rows(short) == [
        (d(2026, 1, 5), "USD", 2, 2, 0, D("0.00"), "PASS"),
        (d(2026, 1, 6), "USD", 0, 1, -1, D("-5.00"), "FAIL"),
        (d(2026, 1, 7), "USD", 1, 0, 1, D("7.00"), "FAIL"),
        (d(2026, 3, 1), "EUR", 0, 1, -1, D("-0.03"), "FAIL"),
        (d(2026, 3, 1), "USD", 1, 1, 0, D("0.00"), "PASS"),
    ]
    assert recon.exceptions(daily).count() == 3
    assert [r[0] for r in recon.daily_proof(daily).collect()] == sorted(r[0] for r in daily.collect())
    assert recon.close(daily).first()[:] == (4, 5, -1, D("47.01"), D("45.04"), D("1.97"), "FAIL")


def test_tolerance_and_offsetting_days(spark):
    sales = orders(
        spark,
        ("O1", "C1", d(2026, 1, 1), D("10.00"), "USD", "X"),
        ("O2", "C1", d(2026, 1, 2), D("10.00"), "USD", "X"),
    )
    booked = controls(spark, (d(2026, 1, 1), "E", 1, D("15.00"), "USD"), (d(2026, 1, 2), "E", 1, D("5.00"), "USD"))
    fact = sales.selectExpr("int(date_format(order_date, 'yyyyMMdd')) order_date_key", "order_amount", "currency currency_code")
    dates, booked = star.dim_date(sales, booked), star.control_facts(booked)
    daily = recon.daily(fact, booked, dates)
    assert {r.reconciliation_status for r in daily.collect()} == {"FAIL"}
    assert recon.close(daily).first().close_status == "PASS"
    relaxed = recon.daily(fact, booked, dates, D("5.00"))
    assert {(r.reconciliation_status, r.documented_amount_tolerance_usd) for r in relaxed.collect()} == {("PASS", D("5.00"))}


def test_enterprise_summary(model, spark):
    found = spark.createDataFrame([("A", "PASS"), ("B", "WARN"), ("C", "FAIL")], "check_id string, status string")
    daily = recon.daily(model["fact"], model["controls"], model["dates"])
    assert kpi.enterprise_summary(model["fact"], found, daily).first()[:] == (5, D("45.04"), D("33.33"), 2, 3)


def test_enterprise_summary_without_checks(model, spark):
    none = spark.createDataFrame([], "check_id string, status string")
    daily = recon.daily(model["fact"], model["controls"], model["dates"])
    assert kpi.enterprise_summary(model["fact"], none, daily).first()[2:4] == (None, 0)
