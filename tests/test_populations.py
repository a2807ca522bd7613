"""Key populations against a comparison of all rows, and keys that stay."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from plumbline.operators import keys, populations, star
from plumbline.sources import files
from conftest import rows

SCHEMA = "k string, part long, value string, amount long"


def brute(source, target):
    held = defaultdict(lambda: (Counter(), Counter()))
    for side, table in enumerate((source, target)):
        for r in table:
            held[r[:2]][side][r[2:]] += 1
    out = []
    for key, (a, b) in held.items():
        if a != b:
            out.append((*key, "MISSING" if not b else "EXTRA" if not a else "CHANGED", a.total(), b.total()))
    return Counter(out)


def compared(spark, source, target, **named):
    frames = [spark.createDataFrame(t, SCHEMA).repartition(3) for t in (source, target)]
    return Counter(map(tuple, populations.compare_keys(*frames, ["k", "part"], ["value", "amount"], **named).collect()))


@pytest.mark.parametrize("levels", [(12, 24), (1, 2), (3,)])
def test_against_all_rows(spark, levels):
    rng = random.Random(len(levels))
    some = lambda: (rng.choice(["a", "b", None, "", "ab"]), rng.choice([1, 2, None]), rng.choice(["x", None, ""]), rng.choice([1, None, 2]))
    source = [some() for _ in range(60)]
    target = [r for r in source if rng.random() < 0.8] + [some() for _ in range(6)]
    assert compared(spark, source, target, levels=levels) == brute(source, target)


def test_nulls_have_their_place(spark):
    source, target = [("a", 1, None, 1), (None, 1, "x", 1)], [("a", 1, "1", None), (None, 1, "x", 1)]
    assert compared(spark, source, target) == Counter([("a", 1, "CHANGED", 1, 1)])


def test_multiplicities_and_empty_sides(spark):
    r = ("a", 1, "x", 1)
    assert compared(spark, [r, r], [r]) == Counter([("a", 1, "CHANGED", 2, 1)])
    assert compared(spark, [r, r], []) == Counter([("a", 1, "MISSING", 2, 0)])
    assert compared(spark, [], [r]) == Counter([("a", 1, "EXTRA", 0, 1)])
    assert compared(spark, [], []) == Counter()


def test_only_buckets_that_differ_are_looked_into(spark):
    source = spark.range(60_000).selectExpr("id AS k", "id % 7 AS value")
    target = source.where("k NOT IN (5, 50000)").unionByName(spark.range(1).selectExpr("-1L AS k", "0L AS value"))
    for other, differences in ((source, 0), (target, 3)):
        left = populations.suspects(source, other, ["k"], ["value"])
        # In one of 2 ** 24 buckets a key hardly has company.
        assert left.count() <= 2 * differences
        assert populations.compare_keys(source, other, ["k"], ["value"]).count() == differences


def test_keys_stay_over_three_runs(spark, tmp_path):
    path = str(tmp_path / "keys")
    runs = [["C3", "C1", "C3"], ["C2", "C1", None, "C9"], ["C0", "C1"]]
    expected = [{"C1": 1, "C3": 2}, {"C1": 1, "C3": 2, None: 3, "C2": 4, "C9": 5}, {"C1": 1, "C3": 2, None: 3, "C2": 4, "C9": 5, "C0": 6}]
    for names, told in zip(runs, expected):
        out = keys.keep_keys(spark.createDataFrame([(n,) for n in names], "id string"), path, "id_key", "id")
        assert {r.id: r.id_key for r in out.collect()} == told and out.count() == len(told)
    before = sorted(p.name for p in (tmp_path / "keys").glob("*.parquet"))
    keys.keep_keys(spark.createDataFrame([("C1",)], "id string"), path, "id_key", "id")
    assert sorted(p.name for p in (tmp_path / "keys").glob("*.parquet")) == before
    dim = star.with_kept_key(spark.createDataFrame([(None, "x"), ("C9", "y")], "id string, name string"), files.read_governed(spark, path, "id string, id_key bigint"), "id", "id_key")
    assert rows(dim) == [(3, None, "x"), (5, "C9", "y")]


def test_an_ordered_key_ascends_and_is_unique(spark):
    out = keys.add_ordered_key(spark.range(5000).selectExpr("hash(id) AS v", "id").repartition(7), "key", ["v", "id"]).collect()
    assert len({r.key for r in out}) == 5000 and min(r.key for r in out) == 1
    assert [(r.v, r.id) for r in sorted(out, key=lambda r: r.key)] == sorted((r.v, r.id) for r in out)
