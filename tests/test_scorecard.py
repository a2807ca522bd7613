from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal as D

from pyspark.sql import functions as F

from plumbline.operators import scorecard
from plumbline.sources.contracts import INCIDENT_SCHEMA
from conftest import rows

d, ts = dt.date, dt.datetime
EXCEPTION = (
    "exception_id int, rule_id string, root_cause string, domain string, severity string, owner string, "
    "opened_at timestamp_ntz, assigned_at timestamp_ntz, resolved_at timestamp_ntz, disposition string"
)


def exceptions(spark, *data):
    """Rows of EXCEPTION without their number; the disposition may be left out."""
    return spark.createDataFrame([(i, *row, *[None] * (9 - len(row))) for i, row in enumerate(data)], EXCEPTION)


def test_dimension_scores_and_their_weighted_mean(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, " ", 7), (2, None, None), (3, "b", 90)], "k int, t string, n int")
    scores = (
        scorecard.completeness(df, "p", ["t", "n"])
        .unionByName(scorecard.validity(df, "p", {"n": F.col("n") < 10}))
        .unionByName(scorecard.uniqueness(df, "p", ["k"]))
    )
    assert rows(scores) == [
        ("p", "completeness", "n", 3, 4, D("75.00")), ("p", "completeness", "t", 2, 4, D("50.00")),
        ("p", "uniqueness", "k", 3, 4, D("75.00")), ("p", "validity", "n", 2, 4, D("50.00")),
    ]
    # 62.5 * 2 + 50 * 1 over 3; uniqueness has no weight.
    assert rows(scorecard.overall_score(scores, {"completeness": 2, "validity": 1})) == [("p", D("58.33"))]
    assert rows(scorecard.scorecard(scores, ["product", "dimension"], totals=True))[0] == (None, None, 10, 16, D("62.50"))
    assert scorecard.scorecard(scores, ["dimension"]).count() == 3
    none = scorecard.uniqueness(df.where("false"), "p", ["t"])
    assert rows(none) == [("p", "uniqueness", "t", 0, 0, None)]


def test_refreshes(spark):
    schedule = spark.createDataFrame(
        [("p", d(2026, 1, day), ts(2026, 1, day, 8)) for day in (1, 2, 3)], "product string, due_date date, due_at timestamp_ntz"
    )
    loads = spark.createDataFrame(
        [("p", d(2026, 1, 1), ts(2026, 1, 1, 9)), ("p", d(2026, 1, 1), ts(2026, 1, 1, 8)), ("p", d(2026, 1, 2), ts(2026, 1, 2, 8, 0, 1))],
        "product string, due_date date, received_at timestamp_ntz",
    )
    status = scorecard.refresh_status(schedule, loads)
    assert [r.refresh_status for r in status.orderBy("due_date").collect()] == ["ON_TIME", "LATE", "MISSING"]
    assert rows(scorecard.timeliness(status)) == [("p", d(2026, 1, 1), 1, 3, D("33.33"))]


def test_variance_and_coverage(spark):
    daily = spark.createDataFrame(
        [(d(2026, 1, 1), "USD", D("200.00"), D("150.00")), (d(2026, 1, 2), "USD", D("0.00"), D("0.25"))],
        "calendar_date date, currency_code string, source_order_amount decimal(38,2), curated_order_amount decimal(38,2)",
    )
    assert [r[2] for r in rows(scorecard.variance_percent(daily))] == [D("25.0000"), D("25.0000")]
    source = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    target = spark.createDataFrame([(1,), (2,), (2,), (9,)], "k int")
    assert scorecard.coverage(source, target, "k").first()[:] == (2, 3, D("66.67"))


def test_assignment_within_one_business_day(spark):
    friday, saturday, sunday, monday = (ts(2026, 1, day, 10) for day in (2, 3, 4, 5))
    raised = lambda opened, assigned: ("r", "c", "dom", "CRITICAL", "o", opened, assigned, None)
    df = exceptions(
        spark,
        raised(friday, ts(2026, 1, 5, 10)),
        raised(friday, ts(2026, 1, 5, 10, 0, 1)),
        raised(saturday, ts(2026, 1, 5, 10)),
        raised(sunday, ts(2026, 1, 5, 9)),
        raised(monday, ts(2026, 1, 6, 11)),
        raised(monday, None),
        ("r", "c", "dom", "HIGH", "o", monday, monday, None),
    )
    assert rows(scorecard.assignment_sla(df)) == [("dom", d(2026, 1, 1), 3, 6, D("50.00"))]
    # Monday off: what came from Friday to Sunday is due on Tuesday, and Monday's too.
    off = spark.createDataFrame([(d(2026, 1, 5),)], "day date")
    assert rows(scorecard.assignment_sla(df, off)) == [("dom", d(2026, 1, 1), 4, 6, D("66.67"))]
    assert rows(scorecard.assignment_sla(df, off.where("false"))) == rows(scorecard.assignment_sla(df))
    assert rows(scorecard.assignment_sla(df.where("false"), off)) == []


def test_time_to_resolve(spark):
    at = ts(2026, 1, 31, 23)
    df = exceptions(
        spark,
        ("r", "c", "x", "LOW", "o", at, None, ts(2026, 2, 1, 0)),
        ("r", "c", "x", "LOW", "o", at, None, ts(2026, 2, 1, 1, 1)),
        ("r", "c", "x", "LOW", "o", at, None, None),
    )
    assert rows(scorecard.time_to_resolve(df)) == [("LOW", d(2026, 2, 1), 2, D("1.51"))]


def test_recurrence(spark):
    one = lambda cause, day, closed=None: ("r", cause, "x", "LOW", "o", day, None, closed)
    df = exceptions(
        spark,
        one("a", ts(2026, 1, 1), ts(2026, 1, 2)),
        one("a", ts(2026, 1, 1, 5), ts(2026, 1, 2)),  # same day
        one("a", ts(2026, 1, 31)),  # 30 days on
        one("a", ts(2026, 3, 3)),  # 31 days on
        one("b", ts(2026, 1, 2), ts(2026, 4, 1)),  # another cause
    )
    assert rows(scorecard.recurrence(df)) == [
        ("r", d(2026, 1, 1), 2, 2, D("100.00")), ("r", d(2026, 3, 1), 0, 0, None), ("r", d(2026, 4, 1), 0, 1, D("0.00")),
    ]


def test_unknown_causes_do_not_recur(spark):
    day = lambda n: ("r", None, "x", "LOW", "o", ts(2026, 1, n), None, ts(2026, 1, n + 1))
    assert rows(scorecard.recurrence(exceptions(spark, day(1), day(2)))) == [("r", d(2026, 1, 1), 0, 2, D("0.00"))]


def test_exception_register(spark):
    incident = ("I1", "R", "d", "HIGH", "o", "OPEN", 3, ts(2026, 1, 1, 5), "k1")
    incidents = spark.createDataFrame([incident, ("I2", *incident[1:8], "k2")], INCIDENT_SCHEMA)
    updates = spark.createDataFrame(
        [
            ("k1", ts(2026, 1, 2), "IN_PROGRESS", None, "cause", None),
            ("k1", ts(2026, 1, 3), "RESOLVED", "FIXED", "cause", ts(2026, 1, 3)),
        ],
        "deduplication_key string, updated_at timestamp, status string, disposition string, root_cause string, resolved_at timestamp",
    )
    got = rows(scorecard.exception_register(incidents, updates, d(2026, 1, 11)).drop("rule_id", "dataset", "severity", "owner"))
    assert got == [("I1", "RESOLVED", "FIXED", "cause", ts(2026, 1, 3), 2), ("I2", "OPEN", None, None, None, 10)]


def test_status_colours(spark):
    df = spark.createDataFrame([(D("98.00"), D("4.00")), (D("96.00"), D("5.00")), (D("95.99"), D("5.01"))], "rate decimal(9,2), gap decimal(9,2)")
    rag = df.select(scorecard.rate_rag(F.col("rate"), F.lit(98)), scorecard.variance_rag(F.col("gap"), F.lit(D("4.00"))))
    assert [tuple(r) for r in rag.collect()] == [("GREEN", "GREEN"), ("AMBER", "AMBER"), ("RED", "RED")]
    rated = spark.createDataFrame([("a", "GREEN"), ("b", "GREEN"), ("c", "RED")], "product string, rag string")
    now = ts(2026, 1, 1)
    open_ones = exceptions(
        spark,
        ("r", "x", "a", "CRITICAL", "o", now, None, None),
        ("r", "x", "a", "CRITICAL", "o", now, None, None),
        ("r", "x", "b", "CRITICAL", "o", now, None, now),
        ("r", "x", "c", "CRITICAL", "o", now, None, None),
    )
    assert rows(scorecard.product_status(rated, open_ones)) == [("a", "AMBER"), ("b", "GREEN"), ("c", "RED")]
    decided = exceptions(spark, ("r", "x", "a", "CRITICAL", "o", now, None, None, "ACCEPTED"))
    assert rows(scorecard.product_status(rated, decided)) == [("a", "GREEN"), ("b", "GREEN"), ("c", "RED")]


def test_rule_versions(spark):
    versions = spark.createDataFrame(
        [("r", 1, d(2026, 1, 1), d(2026, 2, 1)), ("r", 2, d(2026, 2, 1), None)],
        "rule_id string, version int, effective_from date, effective_to date",
    )
    days = spark.createDataFrame([("r", d(2025, 12, 31)), ("r", d(2026, 1, 31)), ("r", d(2026, 2, 1))], "rule_id string, evaluation_day date")
    assert [r[2] for r in rows(scorecard.rule_version_at(days, versions))] == [None, 1, 2]


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "a int, b string, e double")
    contract = {"a": ("bigint", True), "b": ("string", False), "c": ("date", True), "e": ("double", False)}
    got = {r.column_name: (r.finding, r.null_count) for r in scorecard.schema_contract(df, contract).collect()}
    assert got == {"a": ("TYPE_CHANGED", 0), "b": ("NULLS_FOUND", 1), "c": ("MISSING", 0), "e": ("OK", 0)}
    assert rows(scorecard.schema_contract(df, {}))[0] == ("a", None, "int", 0, "EXTRA")


def test_masked_samples(spark):
    df = spark.range(50).selectExpr("id", "if(id = 7, null, id) v")
    got = rows(scorecard.masked_samples(df, {"SMALL": "v < 10", "ANY": "v >= 0"}, "id", 3, "key"))
    keyed = lambda text: hashlib.sha256(b"key" + text.encode()).hexdigest()
    digests = sorted(keyed(keyed(str(i))) for i in range(10, 50))[:3]
    assert got == [("SMALL", h, i + 1) for i, h in enumerate(digests)]
    assert len(rows(scorecard.masked_samples(df, {"SMALL": "v < 10"}, "id", 5000, "key"))) == 39 + 1
