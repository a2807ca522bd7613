from __future__ import annotations

from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal
from fractions import Fraction

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import numeric, parsing, text


def apply(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_keys_keep_letters_and_digits_only(spark):
    values = [" so-1001 ", "SO1002", "c_003/x", "é-1", "№ 5", "", None, "--"]
    assert apply(spark, values, text.normalize_key) == ["SO1001", "SO1002", "C003X", "É1", "5", "", None, ""]


def test_key_normalisation_is_idempotent_and_agrees_with_python(spark):
    rng = random.Random(3)
    alphabet = "aZ09 -_/.éß中٣\t ²Ⅷ"
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(300)]
    once = apply(spark, values, text.normalize_key)
    assert apply(spark, once, text.normalize_key) == once
    assert once == ["".join(c for c in v.strip().upper() if c.isalnum()) for v in values]


def test_enums_and_codes(spark):
    assert apply(spark, [" mid-market ", "a b", "a--b", " x "], text.normalize_enum) == [
        "MID_MARKET", "A_B", "A__B", "X",
    ]
    assert apply(spark, [" usd\t"], text.normalize_code) == ["USD"]
    assert apply(spark, ["\n Acme  Retail \x1f"], text.strip) == ["Acme  Retail"]


def test_blank_is_never_null(spark):
    assert apply(spark, [None, "", "  ", "x", "\t"], text.is_blank) == [True, True, True, False, False]


def test_identity_keeps_short_values_and_tells_long_ones_apart(spark):
    long = "x" * 65
    short, a, b, c = apply(spark, ["x" * 64, long, long + "y", long], text.identity)
    assert short == "x" * 64
    assert a == c != b and len(a) > 64
    # A value that looks like a digest is long itself, so it is digested again.
    assert apply(spark, [a], text.identity) != [a]


def test_dates(spark):
    values = [
        "31-08-2026", "2026/09/01", "2026-09-01", " 2026-9-1 ", "1-2-2024", "2026-02-30", "", "08/31/2026", "26-09-01",
        "20261-01-01", None, "2024-02-29",
    ]
    d = dt.date
    assert apply(spark, values, parsing.parse_date) == [
        d(2026, 8, 31), d(2026, 9, 1), d(2026, 9, 1), d(2026, 9, 1), d(2024, 2, 1), None, None, None, None, None, None,
        d(2024, 2, 29),
    ]


@pytest.mark.parametrize("layout", ["%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y"])
def test_date_round_trip(spark, layout):
    rng = random.Random(5)
    days = [dt.date(1900, 1, 1) + dt.timedelta(days=rng.randrange(80000)) for _ in range(200)]
    assert apply(spark, [x.strftime(layout) for x in days], parsing.parse_date) == days


def test_amounts_round_half_even(spark):
    values = ["1,200.00", " 2.5 ", "2.345", "2.335", "-0.125", "1e3", "abc", "", "n/a", "1,2,3", "99999999999999999", None]
    assert apply(spark, values, parsing.parse_amount) == [
        Decimal("1200.00"), Decimal("2.50"), Decimal("2.34"), Decimal("2.34"), Decimal("-0.12"), Decimal("1000.00"),
        None, None, None, Decimal("123.00"), None, None,
    ]


def test_integers(spark):
    assert apply(spark, [" 12 ", "1.5", "x", "-3", None], parsing.parse_integer) == [12, None, None, -3, None]


def test_date_keys(spark):
    assert apply(spark, [dt.date(2026, 8, 1)], parsing.date_key, "date") == [20260801]
    assert apply(spark, [dt.date(2026, 8, 31)], parsing.month_start, "date") == [dt.date(2026, 8, 1)]


def exact(num, den, digits, times, rounding):
    if num is None or den is None or den == 0:
        return None
    value = Fraction(num) * times / Fraction(den) * 10**digits
    floor = abs(value).numerator // abs(value).denominator
    rest = abs(value) - floor
    half = Fraction(1, 2)
    up = rest > half or (rest == half and (rounding == ROUND_HALF_UP or floor % 2 == 1))
    units = (floor + up) * (-1 if value < 0 else 1)
    return Decimal(units) / 10**digits


@pytest.mark.parametrize(
    "fn,rounding,digits,times",
    [(numeric.ratio, ROUND_HALF_UP, 2, 1), (numeric.percent, ROUND_HALF_UP, 2, 100), (numeric.ratio_half_even, ROUND_HALF_EVEN, 4, 100)],
)
def test_ratios_are_exact(spark, fn, rounding, digits, times):
    rng = random.Random(11)
    pairs = [(Decimal(rng.randrange(-(10**9), 10**9)) / 100, Decimal(rng.choice([rng.randrange(1, 5000), 2**rng.randrange(12)])) / 1) for _ in range(300)]
    pairs += [(Decimal("1299.99"), Decimal(2)), (Decimal(1), Decimal(0)), (None, Decimal(1)), (Decimal("-0.01"), Decimal(3)), (Decimal(5), Decimal(-8))]
    rows = [(i, n, d) for i, (n, d) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, n decimal(18,2), d decimal(18,2)")
    got = [r[0] for r in df.orderBy("i").select(fn(F.col("n"), F.col("d"))).collect()]
    assert got == [exact(n, d, digits, times, rounding) for n, d in pairs]


def test_change_against_nothing_is_null(spark):
    df = spark.createDataFrame([(5, None), (5, 0), (5, 4), (3, 4)], "a bigint, b bigint")
    got = [r[0] for r in df.select(numeric.change_percent(F.col("a"), F.col("b"))).collect()]
    assert got == [None, None, Decimal("25.00"), Decimal("-25.00")]
