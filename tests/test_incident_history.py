"""Incident histories and runs of business days."""

from __future__ import annotations

import datetime as dt
import random

from plumbline.operators import incident_history, streaks
from conftest import rows

INCIDENTS = "deduplication_key string, rule_id string, dataset string, opened_at_utc timestamp_ntz"
UPDATES = "deduplication_key string, updated_at timestamp_ntz, status string, disposition string"
EVALUATIONS = "rule_id string, dataset string, status string, evaluated_at timestamp_ntz"
REFRESHES = "product string, due_date date, refresh_status string"


def at(day, hour=0, minute=0):
    return dt.datetime(2026, 1, day, hour, minute)


def history(spark, incidents, updates=(), evaluations=()):
    return incident_history.history(
        spark.createDataFrame(list(incidents), INCIDENTS), spark.createDataFrame(list(updates), UPDATES), spark.createDataFrame(list(evaluations), EVALUATIONS)
    )


def test_three_days_of_one_history(spark):
    incident = ("k", "R", "d", at(1, 8))
    updates = [("k", at(2, 9), "IN_PROGRESS", None), ("k", at(2, 9, 30), "IN_PROGRESS", None), ("k", at(2, 11), "IN_PROGRESS", None)]
    evaluations = [("R", "d", "FAIL", at(2)), ("R", "d", "PASS", at(1, 8)), ("R", "d", "PASS", at(3, 6)), ("R", "d", "PASS", at(4, 6)), ("S", "d", "PASS", at(1, 9))]
    got = history(spark, [incident], updates, evaluations)
    assert rows(got) == [
        ("k", at(1, 8), at(2, 9), "OPEN", None),
        ("k", at(2, 9), at(3, 6), "IN_PROGRESS", None),
        ("k", at(3, 6), None, "RESOLVED", "PASSED"),
    ]
    states = [[r.status for r in incident_history.states_at(got, moment).collect()] for moment in (at(1), at(1, 8), at(2), at(3), at(3, 6), at(9))]
    assert states == [[], ["OPEN"], ["OPEN"], ["IN_PROGRESS"], ["RESOLVED"], ["RESOLVED"]]


def test_late_updates_take_effect_at_their_own_time(spark):
    incident = ("k", "R", "d", at(1))
    on_time = [("k", at(4), "RESOLVED", "FIXED")]
    late = [("k", at(3), "IN_PROGRESS", None), ("k", at(5), "IN_PROGRESS", "REOPENED")]
    states = [(r.status, r.valid_from, r.valid_to) for r in history(spark, [incident], [*late, *on_time]).orderBy("valid_from").collect()]
    assert states == [("OPEN", at(1), at(3)), ("IN_PROGRESS", at(3), at(4)), ("RESOLVED", at(4), at(5)), ("IN_PROGRESS", at(5), None)]


def test_updates_without_a_place(spark):
    incident = ("k", "R", "d", at(2))
    updates = [("k", None, "RESOLVED", None), ("k", at(1), "RESOLVED", None), ("other", at(3), "RESOLVED", None), (None, at(3), "RESOLVED", None)]
    assert rows(history(spark, [incident, incident], updates)) == [("k", at(2), None, "OPEN", None)]
    assert rows(history(spark, [], updates, [("R", "d", "PASS", at(1))])) == []


def test_histories_by_brute_force(spark):
    """Many updates of one incident, within hours and over them, with equal neighbours and ties."""
    draw = random.Random(3)
    keys = ["a"] * 6 + ["b", "c"]
    incidents = [(k, k.upper(), "d", at(1)) for k in "abc"]
    updates = [(draw.choice(keys), at(1 + draw.randrange(3), draw.randrange(24), draw.randrange(4) * 15), draw.choice("XY"), draw.choice([None, "p"])) for _ in range(400)]
    evaluations = [("A", "d", draw.choice(["PASS", "FAIL"]), at(2, h)) for h in range(24)]
    expected = []
    for key, rule, _, opened in incidents:
        moments = {opened: (0, "OPEN", None)}
        said = [(t, (1, s, d)) for k, t, s, d in updates if k == key]
        passes = [t for r, _, s, t in evaluations if r == rule and s == "PASS" and t > opened]
        said += [(min(passes), (2, "RESOLVED", "PASSED"))] if passes else []
        for t, state in said:
            moments[t] = max(moments.get(t, state), state, key=lambda s: (s[0], s[1], s[2] or ""))
        line = []
        for t in sorted(moments):
            if not line or line[-1][1] != moments[t][1:]:
                line.append((t, moments[t][1:]))
        ends = [t for t, _ in line[1:]] + [None]
        expected += [(key, t, end, *state) for (t, state), end in zip(line, ends)]
    assert rows(history(spark, incidents, updates, evaluations)) == sorted(expected, key=lambda r: tuple(map(str, r)))


def day(n):
    return dt.date(2026, 1, n)


def test_streaks_over_weekends_and_holidays(spark):
    # 1 January 2026 is a Thursday; the 6th is a holiday.
    late = {8, 9, 14}
    refreshes = [("p", day(n), "LATE" if n in late else "ON_TIME") for n in range(1, 17)]
    refreshes += [("p", day(3), "MISSING"), ("p", day(13), "MISSING"), ("q", day(1), "ON_TIME"), ("q", day(5), "ON_TIME"), ("q", None, "LATE"), ("r", day(2), None)]
    holidays = spark.createDataFrame([(day(6),), (day(6),)], "holiday date")
    runs = streaks.refresh_runs(spark.createDataFrame(refreshes, REFRESHES), holidays)
    assert rows(runs) == [
        ("p", False, day(8), day(9), 2),
        ("p", False, day(13), day(14), 2),
        ("p", True, day(1), day(7), 4),
        ("p", True, day(12), day(12), 1),
        ("p", True, day(15), day(16), 2),
        ("q", True, day(1), day(1), 1),
        ("q", True, day(5), day(5), 1),
        ("r", False, day(2), day(2), 1),
    ]
    assert rows(streaks.refresh_streaks(runs, 4)) == [
        ("p", 4, day(1), day(7), 2, 2, True),
        ("q", 1, day(1), day(1), 0, 0, False),
        ("r", 0, None, None, 1, 1, False),
    ]
    none = streaks.refresh_runs(spark.createDataFrame([], REFRESHES), holidays)
    assert rows(streaks.refresh_streaks(none)) == []
