"""Exact quantiles of a column of any size.

The built-in exact percentile keeps every distinct value of the column in one task. Here the range of
values is cut into equal buckets, rows are counted per bucket, and only the buckets that hold a wanted
rank are cut again, until a bucket is one value. A pass shuffles bucket counts, never rows, and brings
back one row per wanted rank, so neither the data nor a hot value can overload a task or the driver.
After the pass that finds the range, two passes are enough for amounts in cents up to 42 million, and
four for any decimal(18,2).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 16


def _scale(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    if isinstance(kind, T.IntegralType):
        return 0
    raise TypeError(f"{column} is {kind.simpleString()}, not a number")


def _value_at_ranks(
    values: DataFrame, to_literal: Callable[[int], Column], lowest: int, highest: int, ranks: list[int]
) -> dict[int, int]:
    """Value at each rank (0 is the smallest) of column `u`, the whole-number form of column `v`."""
    # rank -> (first value of the bucket that holds it, last value, rank within the bucket)
    place = {rank: (lowest, highest, rank) for rank in ranks}
    while any(first < last for first, last, _ in place.values()):
        buckets = sorted({(first, last) for first, last, _ in place.values() if first < last})
        steps = [-(-(last - first + 1) // BUCKETS) for first, last in buckets]
        # Compared in the column's own type, so the scan can skip row groups.
        inside = [F.col("v").between(to_literal(first), to_literal(last)) for first, last in buckets]
        number, start = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for i, (first, _) in enumerate(buckets):
            cut = F.call_function("div", F.col("u") - F.lit(first), F.lit(steps[i])) * F.lit(steps[i])
            number = F.when(inside[i], i).otherwise(number)
            start = F.when(inside[i], cut + F.lit(first)).otherwise(start)
        counts = (
            values.where(reduce(Column.__or__, inside))
            .groupBy(number.alias("bucket"), start.alias("start"))
            .agg(F.count("*").alias("n"))
        )
        below = counts.withColumn(
            "below", F.sum("n").over(W.partitionBy("bucket").orderBy("start")) - F.col("n")
        )
        wanted = {r: (buckets.index((a, z)), rest) for r, (a, z, rest) in place.items() if a < z}
        holds = [
            (F.col("bucket") == b) & (F.col("below") <= rest) & (F.col("below") + F.col("n") > rest)
            for b, rest in wanted.values()
        ]
        found = below.where(reduce(Column.__or__, holds)).collect()  # at most one row per wanted rank
        for rank, (b, rest) in wanted.items():
            row = next(f for f in found if f["bucket"] == b and f["below"] <= rest < f["below"] + f["n"])
            last = min(row["start"] + steps[b] - 1, buckets[b][1])
            place[rank] = (row["start"], last, rest - row["below"])
    return {rank: first for rank, (first, _, _) in place.items()}


def _float_at_ranks(values: DataFrame, lowest: float, highest: float, ranks: list[int]) -> dict[int, float]:
    """Value at each rank of double column `v`.

    As above, but a bucket shrinks to the least and greatest value found in it, and is done when they are equal.
    """
    place = {rank: (lowest, highest, rank) for rank in ranks}
    while any(first < last for first, last, _ in place.values()):
        buckets = sorted({(first, last) for first, last, _ in place.values() if first < last})
        inside = [F.col("v").between(first, last) for first, last in buckets]
        number, cut = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for i, (first, last) in enumerate(buckets):
            half = 0.5 if math.isinf(last - first) else 1.0  # a range beyond the largest double is halved
            width = max((last * half - first * half) / BUCKETS, math.ulp(0.0))
            at = F.floor((F.col("v") * half - first * half) / width)
            number = F.when(inside[i], i).otherwise(number)
            cut = F.when(inside[i], F.least(at, F.lit(BUCKETS - 1))).otherwise(cut)
        counts = (
            values.where(reduce(Column.__or__, inside))
            .groupBy(number.alias("bucket"), cut.alias("cut"))
            .agg(F.count("*").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
        )
        below = counts.withColumn("below", F.sum("n").over(W.partitionBy("bucket").orderBy("cut")) - F.col("n"))
        wanted = {r: (buckets.index((a, z)), rest) for r, (a, z, rest) in place.items() if a < z}
        holds = [
            (F.col("bucket") == b) & (F.col("below") <= rest) & (F.col("below") + F.col("n") > rest)
            for b, rest in wanted.values()
        ]
        found = below.where(reduce(Column.__or__, holds)).collect()  # at most one row per wanted rank
        for rank, (b, rest) in wanted.items():
            row = next(f for f in found if f["bucket"] == b and f["below"] <= rest < f["below"] + f["n"])
            place[rank] = (row["first"], row["last"], rest - row["below"])
    return {rank: first for rank, (first, _, _) in place.items()}


def _float_percentiles(df: DataFrame, column: str, probabilities: list[str]) -> list[float | None]:
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    lowest, highest, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not n:
        return [None] * len(probabilities)
    if math.isinf(lowest) or math.isinf(highest):
        raise ValueError(f"{column} holds an infinite value")
    positions = [Decimal(p) * (n - 1) for p in probabilities]
    ranks = sorted({r for p in positions for r in (int(p), min(int(p) + 1, n - 1))})
    at = _float_at_ranks(values, lowest, highest, ranks)
    pairs = [(at[int(p)], at[min(int(p) + 1, n - 1)], float(p - int(p))) for p in positions]
    return [left + part * (right - left) for left, right, part in pairs]


def exact_percentiles(df: DataFrame, column: str, probabilities: list[str]) -> list[Decimal | float | None]:
    """Percentiles with linear interpolation, exact, of a numeric column; NULL and NaN do not count.

    Decimal and integer columns give decimals, floating ones floats.

    Probabilities are decimal text such as "0.25". Without any value the result is None throughout. Each
    pass reads the column again, so give it a table and not an expensive plan.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return _float_percentiles(df, column, probabilities)
    scale = _scale(df, column)
    values = df.select(
        F.col(column).alias("v"), (F.col(column) * F.lit(10**scale)).cast("bigint").alias("u")
    )
    lowest, highest, n = values.agg(F.min("u"), F.max("u"), F.count("u")).first()
    if not n:
        return [None] * len(probabilities)

    def to_literal(unit: int) -> Column:
        return F.lit(str(Decimal(unit).scaleb(-scale))).cast(kind)

    positions = [Decimal(p) * (n - 1) for p in probabilities]
    ranks = sorted({r for p in positions for r in (int(p), min(int(p) + 1, n - 1))})
    at = _value_at_ranks(values, to_literal, lowest, highest, ranks)
    result = []
    for position in positions:
        left, right = at[int(position)], at[min(int(position) + 1, n - 1)]
        exact = left + (position - int(position)) * (right - left)
        result.append(exact / (10**scale))
    return result
