from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D
from fractions import Fraction

import pytest

from plumbline.operators import eda, profile, quantiles
from conftest import rows

AT = dt.datetime(2026, 9, 5, 6, 3)


def amounts(spark, *values):
    return spark.createDataFrame([(D(v) if v is not None else None,) for v in values], "x decimal(18,2)")


def interpolated(values, p):
    values = sorted(values)
    at = Fraction(p) * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * D((at - low).numerator) / D((at - low).denominator)


def test_pilot_quartiles(spark):
    df = amounts(spark, "1000.00", "250.50", "99.99", "1200.00")
    found = eda.quartiles(df, "x")
    assert [found[k] for k in ("q1", "median", "q3")] == [D("212.8725"), D("625.25"), D("1050")]
    assert (found["lower_fence"], found["upper_fence"]) == (D("-1042.81875"), D("2305.69125"))
    assert eda.distribution(df, "x").first()[-1] == 0


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_match_sorting(spark, seed):
    rng = random.Random(seed)
    # A wide range with an extreme, negative values, and one value that holds a third of the rows.
    values = [D(rng.randrange(-(10**12), 10**13)) / 100 for _ in range(200)] + [D("7.77")] * 110 + [D("9999999999999999.99")]
    df = amounts(spark, *map(str, values), None)
    ps = ["0", "0.1", "0.25", "0.5", "0.75", "0.99", "1"]
    assert quantiles.exact_percentiles(df, "x", ps) == [interpolated(values, p) for p in ps]


def test_percentiles_of_integers_constants_and_nothing(spark):
    ids = spark.range(1, 100_001)
    assert quantiles.exact_percentiles(ids, "id", ["0.5", "0.25"]) == [D("50000.5"), D("25000.75")]
    assert quantiles.exact_percentiles(amounts(spark, "5", "5"), "x", ["0.3"]) == [D(5)]
    assert quantiles.exact_percentiles(amounts(spark, None), "x", ["0.3"]) == [None]
    with pytest.raises(TypeError, match="string"):
        quantiles.exact_percentiles(ids.selectExpr("string(id) x"), "x", ["0.5"])


def test_percentiles_of_floating_columns(spark):
    rng = random.Random(5)
    values = [rng.lognormvariate(0, 9) * rng.choice((1, -1)) for _ in range(300)] + [0.1] * 150 + [1.7e308, -1.7e308, 5e-324]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    ordered, ps = sorted(values), ["0", "0.25", "0.5", "0.75", "1"]
    at = [D(p) * (len(values) - 1) for p in ps]
    want = [ordered[int(i)] + float(i - int(i)) * (ordered[min(int(i) + 1, len(values) - 1)] - ordered[int(i)]) for i in at]
    assert quantiles.exact_percentiles(df, "x", ps) == want
    assert quantiles.exact_percentiles(df.where("x IS NULL"), "x", ["0.5"]) == [None]
    with pytest.raises(ValueError, match="infinite"):
        quantiles.exact_percentiles(spark.createDataFrame([(float("inf"),)], "x double"), "x", ["0.5"])


def test_fences_and_bins_keep_the_columns_scale(spark):
    df = spark.createDataFrame([(D(v).scaleb(-7),) for v in (0, 1, 2, 3, 8)], "x decimal(18,7)")
    assert rows(eda.outliers(df, "x")) == [(D("8E-7"),)]
    assert eda.distribution(df, "x").first()[-1] == 1
    assert [r.orders for r in eda.histogram(df, "x").orderBy("bin").collect()] == [2, 2, 0, 0, 1]  # five rows, five bins


def test_not_a_number_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (nan, 1.0), (9.0, nan), (None, None)], "a double, b double")
    assert rows(eda.missing_values(df)) == [("(total)", 4), ("a", 2), ("b", 2)]
    assert {r.correlation for r in eda.correlation(df).collect()} == {1.0}
    # Quartiles 1.75 and 4.5, upper fence 8.625.
    assert [r.a for r in eda.outliers(df, "a").collect()] == [9.0]
    assert eda.distribution(df, "a").first().total == 15.0
    assert sum(r.orders for r in eda.histogram(df, "b").collect()) == 4


def test_outliers(spark):
    df = amounts(spark, *[str(i) for i in range(1, 21)], "500", "-400")
    assert rows(eda.outliers(df, "x")) == [(D("-400.00"),), (D("500.00"),)]
    row = eda.distribution(df, "x").first()
    assert (row.orders, row.total, row.outliers) == (22, D("310.00"), 2)


def test_histogram(spark):
    df = amounts(spark, "1000.00", "250.50", "99.99", "1200.00", None)
    got = rows(eda.histogram(df, "x"))
    assert [r[3] for r in got] == [2, 0, 0, 2]
    assert got[0][1:3] == (D("99.9900"), D("374.9925")) and got[3][2] == D("1200.0000")
    assert [r[3] for r in rows(eda.histogram(amounts(spark, *["3"] * 9), "x"))] == [0, 0, 0, 9, 0, 0]
    assert rows(eda.histogram(amounts(spark, *["3"] * 9), "x"))[0][1] == D("2.5000")
    assert eda.histogram(amounts(spark, None), "x").count() == 0


def test_correlation(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 5, "a"), (2, 4.0, 5, "b"), (3, 6.0, 5, "c"), (None, 100.0, 5, "d"), (4, None, 5, "e")],
        "a int, b double, c int, t string",
    )
    got = {(r.column_x, r.column_y): r.correlation for r in eda.correlation(df).collect()}
    assert got == {
        ("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): 1.0, ("b", "a"): 1.0, ("c", "c"): None, ("a", "c"): None,
        ("c", "a"): None, ("b", "c"): None, ("c", "b"): None,
    }


def test_revenue_by_leaves_out_missing_groups(spark):
    df = spark.createDataFrame(
        [("1", "A", D("1.00")), ("2", "B", D("5.00")), ("3", None, D("9.00")), ("4", "A", D("4.00"))],
        "order_id string, category string, order_amount decimal(18,2)",
    )
    assert [tuple(r) for r in eda.revenue_by(df, "category").collect()] == [("A", D("5.00"), 2), ("B", D("5.00"), 1)]


def test_missing_values_are_nulls_only(spark):
    df = spark.createDataFrame([(None, ""), (None, "x"), (1, None)], "a int, b string")
    assert rows(eda.missing_values(df)) == [("(total)", 3), ("a", 2), ("b", 1)]


def test_volumes_tell_raw_from_clean(spark):
    got = eda.volumes({"a": spark.range(5), "b": spark.range(0)}, {"a": spark.range(3), "b": spark.range(0)})
    assert rows(got) == [("a", 5, 3), ("b", 0, 0)]


def test_profile(spark):
    df = spark.createDataFrame(
        [("b", D("10.00"), None), ("", D("9.00"), None), (" ", D("10.00"), None), (None, None, None), ("b", D("1.00"), None)],
        "t string, m decimal(18,2), n int",
    )
    want = [
        ("x", "m", 5, 1, 20.0, 3, "1.00", "9.00", AT),
        ("x", "n", 5, 5, 100.0, 0, "", "", AT),
        ("x", "t", 5, 3, 60.0, 3, "", "b", AT),
    ]
    assert rows(profile.profile(df, "x", AT)) == want
    assert rows(profile.profile(df, "x", AT, "approx")) == want


def test_profile_of_long_text_and_of_no_rows(spark):
    long = "y" * 1000
    df = spark.createDataFrame([(long + "1",), (long + "2",), (long + "1",), ("z",)], "t string")
    assert rows(profile.profile(df, "x", AT))[0][5:8] == (3, long + "1", "z")
    assert rows(profile.profile(df.where("false"), "x", AT)) == [("x", "t", 0, 0, 0.0, 0, "", "", AT)]
    with pytest.raises(ValueError):
        profile.profile(df, "x", AT, "some")
