from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from pathlib import Path

import pytest

from plumbline.operators import checks, rules
from plumbline.plans import exploration, governance, publication
from plumbline.sources import files
from conftest import rows

DAY, AT = dt.date(2026, 9, 5), dt.datetime(2026, 9, 5, 6, 3)
RULES = rules.load_rules(Path(__file__).resolve().parents[1] / "config" / "sales_rules.json")


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    from conftest import PILOT

    base = tmp_path_factory.mktemp("published")
    (base / "raw").mkdir()
    for name, text in PILOT.items():
        (base / "raw" / f"{name}.csv").write_text(text, encoding="utf-8")
    return base, publication.run(spark, str(base / "raw"), str(base / "out"), dt.date.today(), AT)


def test_publication(spark, published):
    base, out = published
    assert {(r.status) for r in out["dq_check_result"].collect()} == {"PASS"} and out["dq_check_result"].count() == 15
    assert spark.sql("SELECT * FROM vw_enterprise_kpi_summary").first()[:] == (4, D("2550.49"), D("100.00"), 0, 0)
    assert spark.sql("SELECT * FROM vw_reconciliation_exceptions").count() == 0
    trend = rows(spark.sql("SELECT * FROM vw_monthly_sales_trend"))
    assert trend[1][1:] == (D("1299.99"), 2, 2, D("1250.50"), D("3.96"), D("0.00"))
    history = spark.read.parquet(str(base / "out" / "checks" / "dq_check_result"))
    assert [r.run_id for r in history.select("run_id").distinct().collect()] == ["20260905T060300"]
    staged = files.read_extract(spark, str(base / "out" / "staging" / "gl_controls_clean.csv"), "gl_controls")
    assert ("2026-09-01", "ERP", "2", "1299.99", "USD") in rows(staged)


def test_the_model_of_the_last_finished_run_is_current(spark, published, tmp_path):
    base, out = published
    current = publication.current_model(spark, str(base / "out"))
    assert set(current) == set(publication.MODEL)
    for name, df in current.items():
        assert rows(df) == rows(out[name])
    with pytest.raises(LookupError):
        publication.current_model(spark, str(tmp_path))
    # Another run's tables without its switch are not seen.
    files.write_governed(spark.range(1), str(base / "out" / "model" / "run_id=later" / "dim_date"))
    assert rows(publication.current_model(spark, str(base / "out"))["dim_date"]) == rows(out["dim_date"])


def test_exploration(published):
    _, out = published
    found = exploration.run(out, out["dq_check_result"])
    assert found["headline"].first()[:] == (4, D("2550.49"), 15, 15)
    assert found["distribution"].first()[2:5] == (D("212.872500"), D("625.250000"), D("1050.000000"))
    assert [tuple(r) for r in found["revenue_by_segment"].collect()] == [
        ("MID_MARKET", D("1200.00"), 1), ("ENTERPRISE", D("1099.99"), 2), ("SMB", D("250.50"), 1),
    ]
    assert {r.missing for r in found["missing_values"].collect()} == {0}


def test_failed_gate_leaves_evidence_and_publishes_nothing(spark, pilot_dir, tmp_path):
    with (pilot_dir / "sales_orders.csv").open("a") as f:
        f.write("so-9,c-999,2026/09/01,not money,usd,online\nso-10,c-999,2026/09/01,1.00,usd,online\n")
    args = spark, str(pilot_dir), str(tmp_path / "out"), dt.date.today(), AT
    with pytest.raises(checks.GateFailed, match="FK_ORDER_CUSTOMER, RECON_ORDER_COUNT, RECON_ORDER_VALUE, RECON_ROW_COUNT"):
        publication.run(*args, mode="quarantine")
    out = tmp_path / "out"
    assert not (out / "model").exists() and not (out / "staging").exists()
    assert spark.read.parquet(str(out / "checks" / "dq_check_result")).where("status = 'FAIL'").count() == 4
    assert spark.read.parquet(str(out / "checks" / "dq_reconciliation_exception")).count() == 3
    assert spark.read.parquet(str(out / "rejects" / "sales_orders")).first().reject_reason == "order_amount"


def test_governance_opens_incidents_once(spark, published, tmp_path):
    base, out = published
    frames = {
        name: files.read_extract(spark, str(base / "out" / "staging" / f"{name}_clean.csv"), name)
        for name in publication.DATASETS
    }
    good = governance.run(spark, frames, RULES, str(tmp_path / "good"), DAY, AT)
    assert good["governed_column_profile"].count() == 16 and good["governed_rule_result"].count() == 6
    assert {r.status for r in good["governed_rule_result"].collect()} == {"PASS"}
    assert good["governed_incident"].count() == 0 and good["governed_incident"].columns[0] == "incident_id"
    profiles = {(r.dataset, r.column_name): (r.distinct_count, r.min_value, r.max_value) for r in good["governed_column_profile"].collect()}
    assert profiles[("sales_orders", "order_amount")] == (4, "1000.00", "99.99")  # lexical
    assert profiles[("customers", "segment")] == (3, "ENTERPRISE", "SMB")

    stale = dt.date(2026, 9, 9)
    for _ in range(2):
        bad = governance.run(spark, frames, RULES, str(tmp_path / "bad"), stale, AT)
    assert rows(spark.sql("SELECT incident_id, failed_rows FROM vw_open_data_incidents")) == [("INC-SO_FRESHNESS-20260909", 4)]
    assert ("HIGH", "Commerce Data Engineering", "FAIL", 1, 4) in rows(spark.sql("SELECT * FROM vw_governed_rule_status"))
    governance.run(spark, frames, RULES, str(tmp_path / "bad"), dt.date(2026, 9, 10), AT, run_id="next day")
    for table, n in (("rule_result", 6), ("column_profile", 16)):
        kept = spark.read.parquet(str(tmp_path / "bad" / table)).groupBy("run_id").count()
        assert rows(kept) == [("20260905T060300", n), ("next day", n)]
    assert spark.read.parquet(str(tmp_path / "bad" / "incident")).count() == 2
    assert rules.open_incidents(bad["governed_incident"]).count() >= 1


def test_managed_tables_are_rebuilt(spark):
    files.save_tables({"dim_small": spark.range(3)})
    files.save_tables({"dim_small": spark.range(2)})
    assert spark.table("dim_small").count() == 2


def test_ages_of_files_in_folders(spark, tmp_path):
    (tmp_path / "customers.csv" / "deep").mkdir(parents=True)
    (tmp_path / "customers.csv" / "part-0.csv").write_text("a\n1\n")
    (tmp_path / "customers.csv" / "deep" / "part-1.csv").write_text("")
    (tmp_path / "orders.csv").write_text("a\n")
    (tmp_path / "notes.txt").write_text("a\n")
    ages = files.raw_file_ages(spark, str(tmp_path), dt.date.today().isoformat())
    assert [r[0] for r in rows(ages)] == ["customers.csv/deep/part-1.csv", "customers.csv/part-0.csv", "orders.csv"]


def test_text_survives_an_extract(spark, tmp_path):
    texts = [(1, "a\nb"), (2, 'say "hi", then\r\ngo'), (3, "  kept  "), (4, None), (5, ""), (6, "back\\slash\\"), (7, '"'), (8, "\u00e9\t")]
    files.write_extract(spark.createDataFrame(texts, "n int, t string"), str(tmp_path / "x.csv"))
    assert rows(files.read_raw(spark, str(tmp_path / "x.csv"))) == [(str(n), t or None) for n, t in texts]  # empty is missing
