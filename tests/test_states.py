"""Profiles merged from stored days, and rules judged by the version in effect."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from plumbline.operators import profile_state, rules
from plumbline.sources.contracts import ContractError
from conftest import rows

D = dt.date
SCHEMA = "day date, name string, amount decimal(10,2), n long"


def frame(spark, n, seed, days=20):
    rng = random.Random(seed)
    some = [(D(2026, 1, 1) + dt.timedelta(days=rng.randrange(days)), rng.choice(["a", "b", " ", None, f"x{rng.randrange(400)}"]), None, rng.randrange(1000)) for _ in range(n)]
    return some, spark.createDataFrame(some, SCHEMA)


def told(some, first, last):
    within = [r for r in some if first <= r[0] <= last]
    names, numbers = [r[1] for r in within], [str(r[3]) for r in within]
    return {
        "name": (len(within), sum(not (v or "").strip() for v in names), min(v for v in names if v is not None), max(v for v in names if v is not None)),
        "amount": (len(within), len(within), "", ""),
        "n": (len(within), 0, min(numbers), max(numbers)),
    }


def test_merged_days_are_the_profile_of_the_range(spark, tmp_path):
    some, df = frame(spark, 3000, 1)
    path = str(tmp_path / "p")
    profile_state.keep_state(df, "d", "day", D(2026, 1, 1), D(2026, 12, 31), dt.datetime(2026, 2, 1), path)
    state = profile_state.current_state(spark, path)
    for first, last in ((D(2026, 1, 1), D(2026, 1, 31)), (D(2026, 1, 3), D(2026, 1, 9)), (D(2026, 1, 5), D(2026, 1, 5))):
        out = {r.column_name: r for r in profile_state.merged(state, first, last).collect()}
        assert {c: (r.row_count, r.null_count, r.min_value, r.max_value) for c, r in out.items()} == told(some, first, last)
        within = sorted(r[3] for r in some if first <= r[0] <= last)
        assert abs(out["n"].distinct_count - len(set(within))) <= 0.05 * len(set(within)) + 1
        for share, value in zip((0.25, 0.5, 0.75), out["n"].quartiles):
            assert abs(sum(v <= value for v in within) / len(within) - share) < 0.03
        assert out["name"].quartiles is None and out["amount"].quartiles is None and out["amount"].distinct_count == 0
    assert profile_state.merged(state, D(2027, 1, 1), D(2027, 1, 2)).collect() == []


def test_days_stated_again_replace_the_old(spark, tmp_path):
    path = str(tmp_path / "p")
    old, df = frame(spark, 500, 2)
    profile_state.keep_state(df, "d", "day", D(2026, 1, 1), D(2026, 1, 31), dt.datetime(2026, 2, 1), path)
    new, again = frame(spark, 200, 3, days=10)
    profile_state.keep_state(again, "d", "day", D(2026, 1, 4), D(2026, 1, 12), dt.datetime(2026, 2, 2), path)
    # A run that broke off before it was noted.
    later = profile_state.daily_state(df, "d", "day").selectExpr("*", "timestamp '2026-03-01' AS stated_at")
    later.write.mode("append").parquet(f"{path}/state")
    now = [r for r in old if not D(2026, 1, 4) <= r[0] <= D(2026, 1, 12)] + [r for r in new if r[0] >= D(2026, 1, 4)]
    out = profile_state.merged(profile_state.current_state(spark, path), D(2026, 1, 1), D(2026, 1, 31)).collect()
    assert {r.column_name: (r.row_count, r.null_count, r.min_value, r.max_value) for r in out} == told(now, D(2026, 1, 1), D(2026, 1, 31))


def rule(version, condition, **fields):
    return {
        "rule_id": "LIMIT", "dataset": "d", "kind": "expression", "severity": "HIGH", "owner": "o", "description": f"v{version}",
        "condition": condition, "version": version, **fields,
    }


def versions(spark, *starts):
    return spark.createDataFrame([("LIMIT", v, d) for v, d in starts], "rule_id string, version int, effective_from date")


def test_each_row_is_judged_by_the_version_of_its_day(spark):
    rows_ = [(D(2026, 1, day), None, None, n) for day in range(1, 11) for n in (1, 5, 9)]
    df = spark.createDataFrame(rows_ + [(None, None, None, 1)], SCHEMA)
    held = versions(spark, (1, D(2026, 1, 3)), (2, D(2026, 1, 6)), (3, D(2026, 1, 20)))
    rules_ = [rule(1, "n < 9"), rule(2, "n < 2"), rule(3, "false")]
    out = rules.evaluate_versions({"d": df}, {"d": "day"}, rules_, held, dt.datetime(2026, 2, 1))
    assert [(r.version, r.description, r.status, r.evaluated_rows, r.failed_rows) for r in out.orderBy("version").collect()] == [
        (1, "v1", "FAIL", 9, 3),
        (2, "v2", "FAIL", 15, 10),
    ]


def test_days_before_the_first_version_and_unknown_rules(spark):
    days = spark.createDataFrame([("LIMIT", D(2026, 1, d)) for d in (1, 3, 3, 4)] + [("OTHER", D(2026, 1, 3))], "rule_id string, day date")
    out = rules.versions_in_effect(days, versions(spark, (7, D(2026, 1, 3))))
    assert rows(out) == [("LIMIT", D(2026, 1, 3), 7), ("LIMIT", D(2026, 1, 4), 7)]


@pytest.mark.parametrize("wrong", [[rule(1, "true"), rule(1, "false")], [rule(1, "true", kind="freshness")], [{"rule_id": "x", "version": 1}]])
def test_faulty_versions_are_refused(spark, wrong):
    with pytest.raises(ContractError):
        rules.evaluate_versions({"d": frame(spark, 1, 1)[1]}, {"d": "day"}, wrong, versions(spark, (1, D(2026, 1, 1))), dt.datetime(2026, 2, 1))
