"""Exact ratios. Rates and averages are rounded on whole numbers, never on doubles, so a value on a
rounding boundary gives the same result on every run, partitioning and engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WHOLE = "decimal(38,0)"


def _units(c: Column, scale: int) -> Column:
    """Whole number of units of 10**-scale; a value with more decimals is an error, not rounded."""
    kept = c.cast(f"decimal(30,{scale})")
    exact = F.when(c.isNull() | (kept == c), kept).otherwise(F.raise_error(F.lit(f"more than {scale} decimals in a ratio")))
    return (exact * F.lit(10**scale)).cast(_WHOLE)


def _whole_division(num: Column, den: Column, factor: int, scale: int) -> tuple[Column, Column, Column]:
    """|num| * factor and |den| as whole numbers (den NULL when zero), and their whole quotient."""
    top = F.abs(_units(num, scale)) * F.lit(factor)
    bottom = F.nullif(F.abs(_units(den, scale)), F.lit(0).cast(_WHOLE))
    return top, bottom, F.call_function("div", top, bottom)


def _signed(magnitude: Column, num: Column, den: Column, digits: int) -> Column:
    step = F.lit(10 ** -digits if digits == 0 else f"0.{'0' * (digits - 1)}1").cast(f"decimal({digits + 1},{digits})")
    value = magnitude.cast("decimal(20,0)") * step
    return F.when((num < 0) != (den < 0), -value).otherwise(value)


def ratio(num: Column, den: Column, digits: int = 2, times: int = 1, scale: int = 4) -> Column:
    """times * num / den rounded half away from zero; NULL when den is 0 or either side is NULL.

    `scale` is the most decimals either side has: four do for counts, cents and four-digit scores.
    """
    factor = times * 10**digits
    top, bottom, _ = _whole_division(num, den, factor, scale)
    nearest = F.call_function("div", top * F.lit(2) + bottom, bottom * F.lit(2))
    return _signed(nearest, num, den, digits)


def ratio_half_even(num: Column, den: Column, digits: int = 4, times: int = 100, scale: int = 4) -> Column:
    """As `ratio`, but a tie goes to the even neighbour."""
    factor = times * 10**digits
    top, bottom, below = _whole_division(num, den, factor, scale)
    twice_rest = (top - below.cast(_WHOLE) * bottom) * F.lit(2)
    up = (twice_rest > bottom) | ((twice_rest == bottom) & (below % 2 == 1))
    return _signed(below + F.when(up, 1).otherwise(0), num, den, digits)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """100 * num / den, half away from zero."""
    return ratio(num, den, digits, times=100)


def change_percent(now: Column, before: Column, digits: int = 2) -> Column:
    """Signed change against an earlier value; NULL when there is none or it is zero."""
    return percent(now - before, before, digits)
