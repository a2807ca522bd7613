from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.functions.parsing import utc_stamp
from plumbline.operators import cleaning
from plumbline.sources import files
from plumbline.sources.contracts import ContractError
from conftest import rows

ORDER = "order_id string, customer_id string, order_date string, order_amount string, currency string, category string"


def orders(spark, *raw):
    return spark.createDataFrame(list(raw), ORDER)


def test_pilot_cleans_to_the_expected_rows(spark, pilot_dir):
    d, m = dt.date, Decimal
    read = lambda name: files.read_extract(spark, f"{pilot_dir}/{name}.csv", name)
    assert rows(cleaning.clean_customers(read("customers"))) == [
        ("C001", "Acme Retail", "ENTERPRISE", "ACTIVE", d(2024, 1, 15)),
        ("C002", "Beacon Stores", "SMB", "ACTIVE", d(2024, 2, 15)),
        ("C003", "Cedar Health", "ENTERPRISE", "ACTIVE", d(2024, 3, 1)),
        ("C004", "Delta Foods", "MID_MARKET", "ACTIVE", d(2024, 4, 20)),
    ]
    assert rows(cleaning.clean_orders(read("sales_orders"))) == [
        ("SO1001", "C001", d(2026, 8, 30), m("1000.00"), "USD", "ONLINE"),
        ("SO1002", "C002", d(2026, 8, 31), m("250.50"), "USD", "WHOLESALE"),
        ("SO1003", "C003", d(2026, 9, 1), m("99.99"), "USD", "RETAIL"),
        ("SO1004", "C004", d(2026, 9, 1), m("1200.00"), "USD", "ONLINE"),
    ]
    assert rows(cleaning.clean_controls(read("gl_controls"))) == [
        (d(2026, 8, 30), "ERP", 1, m("1000.00"), "USD"),
        (d(2026, 8, 31), "ERP", 1, m("250.50"), "USD"),
        (d(2026, 9, 1), "ERP", 2, m("1299.99"), "USD"),
    ]


def test_rows_that_do_not_parse_are_set_aside_with_their_reason(spark):
    raw = orders(
        spark,
        ("so-1", "c1", "2026-02-30", "1", "usd", "online"),
        ("so-2", "c1", "2026-01-01", "abc", "usd", "online"),
        ("so-3", "c1", None, "", "usd", "online"),
        ("so-4", "c1", "2026-01-01", "1", None, ""),
    )
    bad = cleaning.rejects(cleaning.parse(raw, "sales_orders"))
    assert [(r.order_id, r.reject_reason) for r in bad.orderBy("order_id").collect()] == [
        ("so-1", "order_date"), ("so-2", "order_amount"), ("so-3", "order_date, order_amount"),
    ]
    assert rows(cleaning.accepted(cleaning.parse(raw, "sales_orders")).select("order_id", "currency", "category")) == [("SO4", None, "")]
    assert cleaning.clean_orders(raw, "quarantine").count() == 1
    with pytest.raises(cleaning.RejectedRows, match="order_date"):
        cleaning.clean_orders(raw)


def test_fractional_counts_are_rejected(spark):
    raw = spark.createDataFrame(
        [("2026-01-01", "erp", "1.5", "1", "usd"), ("2026-01-01", "erp", " 2 ", "1", "usd")],
        "control_date string, source_system string, order_count string, order_amount string, currency string",
    )
    assert [r.reject_reason for r in cleaning.rejects(cleaning.parse(raw, "gl_controls")).collect()] == ["order_count"]
    assert rows(cleaning.clean_controls(raw, "quarantine"))[0][1:3] == ("ERP", 2)


def test_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "sales_orders.csv"
    path.write_text('note,category,currency,order_amount,order_date,customer_id,order_id\n"a ""b"", c",x,usd,"1,000.5",2026-01-01,c1,o1\n')
    raw = files.read_extract(spark, str(path), "sales_orders")
    assert raw.first()["note"] == 'a "b", c'
    assert rows(cleaning.clean_orders(raw)) == [("O1", "C1", dt.date(2026, 1, 1), Decimal("1000.50"), "USD", "X")]


def test_missing_columns_stop_the_read_or_are_filled(spark, tmp_path):
    path = tmp_path / "sales_orders.csv"
    path.write_text("order_id,order_date,customer_id,order_amount\no1,2026-01-01,c1,1\n")
    with pytest.raises(ContractError, match=r"\['category', 'currency'\]"):
        files.read_extract(spark, str(path), "sales_orders")
    filled = files.fill_missing(files.read_raw(spark, str(path)), "sales_orders")
    assert rows(cleaning.clean_orders(filled).select("currency", "category")) == [(None, None)]


def test_staged_extract_round_trip(spark, pilot_dir, tmp_path):
    raw = files.read_extract(spark, f"{pilot_dir}/sales_orders.csv", "sales_orders")
    clean = cleaning.clean_orders(raw)
    files.write_extract(clean, str(tmp_path / "staged.csv"))
    staged = files.read_extract(spark, str(tmp_path / "staged.csv"), "sales_orders")
    assert ("SO1004", "C004", "2026-09-01", "1200.00", "USD", "ONLINE") in rows(staged)
    assert rows(cleaning.clean_orders(staged)) == rows(clean)
    files.write_governed(clean, str(tmp_path / "staged"))
    assert rows(files.read_staged(spark, str(tmp_path / "staged"), "sales_orders")) == rows(clean)


def test_empty_extract_can_be_written(spark, pilot_dir, tmp_path):
    raw = files.read_extract(spark, f"{pilot_dir}/sales_orders.csv", "sales_orders").where("false")
    files.write_extract(cleaning.clean_orders(raw), str(tmp_path / "staged.csv"))
    files.write_governed(cleaning.clean_orders(raw), str(tmp_path / "staged"))
    assert files.read_staged(spark, str(tmp_path / "staged"), "sales_orders").count() == 0


def test_file_ages_include_empty_files(spark, tmp_path):
    import os

    stamp = dt.datetime(2026, 9, 1, 12, tzinfo=dt.timezone.utc).timestamp()
    for name, content in (("a.csv", "x\n"), ("b.csv", ""), ("c.txt", "x")):
        (tmp_path / name).write_text(content)
        os.utime(tmp_path / name, (stamp, stamp))
    assert rows(files.raw_file_ages(spark, str(tmp_path), "2026-09-05")) == [("a.csv", 4), ("b.csv", 4)]


def test_line_breaks_and_quotes_survive_an_extract(spark, tmp_path):
    values = ["Acme\nRetail", 'says "hi", twice', "a,b", "plain", "two\r\nlines", "back\\slash"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, name string")
    files.write_extract(df, str(tmp_path / "x.csv"))
    got = {r.id: r.name for r in files.read_raw(spark, str(tmp_path / "x.csv")).select("id", F.col("name").alias("name")).toLocalIterator()}
    assert {k: v.replace("\r\n", "\n") for k, v in got.items()} == {str(i): v.replace("\r\n", "\n") for i, v in enumerate(values)}


def test_one_record_per_line_is_split(spark, tmp_path):
    path = tmp_path / "x.csv"
    lines = [f'{i},"says ""{i}"", twice",5" pipe' for i in range(3000)] + [',"",', '1, "x,y']
    path.write_text("\n".join(["id,name,size", *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        whole, split = files.read_raw(spark, str(path)), files.read_raw(spark, str(path), one_line=True)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
        assert rows(split) == rows(whole) and split.count() == len(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("record", ['1,"open', '1,"two\nlines"', '1,"odd""', '5" pipe,"open'])
def test_an_unbalanced_quote_fails_where_records_are_lines(spark, tmp_path, record):
    (tmp_path / "x.csv").write_text(f"id,name\n0,fine\n{record}\n2,fine\n")
    with pytest.raises(ContractError, match="unbalanced quote"):
        files.read_raw(spark, str(tmp_path / "x.csv"), one_line=True)


def test_stamps_do_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.range(1).select(F.unix_timestamp(utc_stamp(dt.datetime(2026, 9, 5, 6))).alias("s")).first().s
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == int(dt.datetime(2026, 9, 5, 6, tzinfo=dt.timezone.utc).timestamp())
