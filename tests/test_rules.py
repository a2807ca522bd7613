from __future__ import annotations

import copy
import datetime as dt
import json

import pytest

from plumbline.operators import rules
from plumbline.sources.contracts import INCIDENT_SCHEMA, ContractError
from conftest import rows

AT = dt.datetime(2026, 9, 5, 6, 3)
DAY = dt.date(2026, 9, 5)


def rule(rule_id, kind="expression", severity="HIGH", dataset="orders", **more):
    return {
        "rule_id": rule_id, "dataset": dataset, "kind": kind, "severity": severity, "owner": "Owner",
        "description": "text", **more,
    }


CONFIG = {
    "version": "1.0",
    "incident_policy": {"open_on_status": ["FAIL"]},
    "rules": [
        rule("REQUIRED", condition="customer_id IS NOT NULL AND trim(customer_id) <> ''", severity="CRITICAL"),
        rule("RANGE", condition="CAST(amount AS DOUBLE) > 0 AND CAST(amount AS DOUBLE) <= 1000000"),
        rule("CATEGORY", condition="category IN ('ONLINE', 'RETAIL')", severity="MEDIUM"),
        rule("REFERENCE", "foreign_key", column="customer_id", reference_dataset="customers", reference_column="id"),
        rule("FRESH", "freshness", column="day", max_age_days=7),
        rule("CUSTOMER_NAMED", dataset="customers", condition="id <> 'C9'"),
    ],
}


@pytest.fixture()
def frames(spark):
    orders = [
        ("C1", "10", "ONLINE", "2026-08-30"),
        ("C1", "0", "crypto", "2026-08-29"),
        (None, "1000000.01", None, "2026-08-30"),
        ("C999", "1000000", "RETAIL", None),
        (" ", "5", "RETAIL", "2026-08-01"),
    ]
    return {
        "orders": spark.createDataFrame(orders, "customer_id string, amount string, category string, day string"),
        "customers": spark.createDataFrame([("C1",), ("C1",), ("C2",), (None,)], "id string"),
    }


def outcome(df):
    return {r.rule_id: (r.status, r.evaluated_rows, r.failed_rows, r.failed_rate_pct) for r in df.collect()}


def test_rules_are_evaluated_together(frames):
    got = outcome(rules.evaluate_rules(frames, CONFIG, DAY, AT))
    assert got == {
        "REQUIRED": ("FAIL", 5, 2, 40.0),
        "RANGE": ("FAIL", 5, 2, 40.0),
        "CATEGORY": ("FAIL", 5, 1, 20.0),  # a NULL category is not a failure
        "REFERENCE": ("FAIL", 5, 3, 60.0),  # an unknown, a blank and a NULL customer
        "FRESH": ("PASS", 5, 0, 0.0),
        "CUSTOMER_NAMED": ("PASS", 4, 0, 0.0),
    }


def test_stale_dataset_fails_every_row(frames):
    on = lambda day: outcome(rules.evaluate_rules(frames, CONFIG, day, AT))["FRESH"]
    assert on(dt.date(2026, 9, 6))[:3] == ("PASS", 5, 0)
    assert on(dt.date(2026, 9, 7)) == ("FAIL", 5, 5, 100.0)
    assert on(dt.date(2026, 1, 1))[0] == "PASS"  # dates in the future pass


def test_dataset_without_any_date_is_stale(frames):
    undated = {**frames, "orders": frames["orders"].selectExpr("customer_id", "amount", "category", "cast(null as string) day")}
    assert outcome(rules.evaluate_rules(undated, CONFIG, DAY, AT))["FRESH"][:3] == ("FAIL", 5, 5)


def test_empty_dataset_passes_unless_told_otherwise(frames):
    empty = {**frames, "orders": frames["orders"].where("false")}
    got = outcome(rules.evaluate_rules(empty, CONFIG, DAY, AT))
    assert {got[r] for r in ("REQUIRED", "REFERENCE", "FRESH")} == {("PASS", 0, 0, 100.0)}
    strict = outcome(rules.evaluate_rules(empty, CONFIG, DAY, AT, empty_is_failure=True))
    assert strict["FRESH"][0] == "FAIL" and strict["CUSTOMER_NAMED"][0] == "PASS"


def test_incidents_open_once(spark, frames):
    results = rules.evaluate_rules(frames, CONFIG, DAY, AT)
    opened = rules.incidents(results, CONFIG, DAY)
    assert opened.columns == [c.split()[0] for c in INCIDENT_SCHEMA.split(", ")]
    first = {r.rule_id: r for r in opened.collect()}["RANGE"]
    assert (first.incident_id, first.status, first.deduplication_key, first.opened_at_utc) == (
        "INC-RANGE-20260905", "OPEN", "RANGE|orders|2026-09-05", AT,
    )
    assert opened.count() == 4
    assert rules.new_incidents(opened, spark.createDataFrame([], INCIDENT_SCHEMA)).count() == 4
    assert rules.new_incidents(opened.union(opened), opened.where("rule_id = 'RANGE'")).count() == 3
    assert rules.new_incidents(opened, opened).count() == 0
    later = rules.incidents(results, CONFIG, dt.date(2026, 9, 6))
    assert rules.new_incidents(later, opened).count() == 4
    closed = opened.selectExpr("* except (status)", "if(rule_id = 'RANGE', 'CLOSED', status) status")
    assert rules.open_incidents(closed).count() == 3


def test_rule_status(frames):
    got = rows(rules.rule_status(rules.evaluate_rules(frames, CONFIG, DAY, AT)))
    assert got == [
        ("CRITICAL", "Owner", "FAIL", 1, 2), ("HIGH", "Owner", "FAIL", 2, 5), ("HIGH", "Owner", "PASS", 2, 0),
        ("MEDIUM", "Owner", "FAIL", 1, 1),
    ]


def test_configuration_is_validated(tmp_path, spark):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(CONFIG))
    assert rules.load_rules(path) == CONFIG
    catalog = rules.rule_catalog(spark, CONFIG)
    assert catalog.count() == 6 and catalog.columns == list(rules.RULE_FIELDS)

    def broken(message, change):
        config = copy.deepcopy(CONFIG)
        change(config["rules"])
        with pytest.raises(ContractError, match=message):
            rules.validate_rules(config)

    broken("lacks .*owner", lambda r: r[0].pop("owner"))
    broken("twice", lambda r: r.append(r[0]))
    broken("severity", lambda r: r[0].update(severity="URGENT"))
    broken("unsupported kind", lambda r: r[0].update(kind="regex"))
    broken("lacks .*condition", lambda r: r[0].pop("condition"))


def test_rules_are_resolved_before_a_run(spark, frames):
    assert rules.validate_rules(CONFIG, frames) == CONFIG
    wrong = [
        rule("COLUMN", condition="amuont > 0"),
        rule("SYNTAX", condition="amount > > 0"),
        rule("TYPE", condition="trim(customer_id)"),
        rule("AGGREGATE", condition="max(amount) > 0"),
        rule("WINDOW", condition="row_number() OVER (ORDER BY amount) > 1"),
        rule("RANDOM", condition="rand() > 0.5"),
        rule("DATASET", dataset="ordres", condition="true"),
        rule("REFERENCE_DATASET", "foreign_key", column="customer_id", reference_dataset="clients", reference_column="id"),
        rule("REFERENCE_COLUMN", "foreign_key", column="customer_id", reference_dataset="customers", reference_column="no"),
        rule("DAY", "freshness", column="days", max_age_days=7),
        rule("KIND", "regex", condition="true"),
    ]
    config = {**CONFIG, "rules": [*CONFIG["rules"], *wrong]}
    # No job may start: every frame here would fail in one.
    failing = {name: df.where("raise_error('read') IS NULL") for name, df in frames.items()}
    with pytest.raises(ContractError) as raised:
        rules.validate_rules(config, failing)
    found = str(raised.value).split("; ")
    assert len(found) == len(wrong)
    for name in (r["rule_id"] for r in wrong):
        assert len([f for f in found if f"({name})" in f]) == 1
