"""Reconciliation of two populations of keyed rows: which keys are missing, extra or changed.

Rows are dealt to buckets by their key, and each bucket is summed up in numbers that do not depend on the order of its
rows: how many there are, the sum of one hash of them and the exclusive or of another, the second side counted off from
the first. Only buckets that don't come out as zero are looked into, first by finer buckets, then key by key. So equal
populations shuffle a row per bucket and task, and what is shuffled beyond that follows the differences.

Two sides of a bucket that differ pass as equal only if count, sum and exclusive or all agree by chance (128 hash bits).
A NULL equals a NULL. A key may have many rows; it has changed where their multisets differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.sources.files import materialize

#: Leading bits of a key's hash that make up its bucket, level by level.
LEVELS = (12, 24)


def _hash(names: list[str], prefix: str = "") -> Column:
    """Hash of values in which a NULL has its own place; `prefix` makes it another one."""
    cells = [part for name in names for part in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(F.lit(prefix), *cells)


def _both(source: DataFrame, target: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    columns = [F.col(f"`{name}`") for name in (*keys, *values)]
    sides = [df.select(F.lit(sign).alias("_sign"), *[c.alias(f"_c{i}") for i, c in enumerate(columns)]) for sign, df in ((1, source), (-1, target))]
    names = [f"_c{i}" for i in range(len(columns))]
    return sides[0].unionByName(sides[1]).select(
        "_sign", *names[: len(keys)], _hash(names[: len(keys)]).alias("_spread"), _hash(names).alias("_sum"), _hash(names, "other").alias("_xor")
    )


def _bucket(bits: int) -> Column:
    return F.shiftrightunsigned("_spread", 64 - bits)


def _differences() -> list[Column]:
    """Zero each, where both sides have the same rows."""
    return [
        F.sum("_sign").alias("_rows"),
        F.sum(F.col("_sign") * F.col("_sum").cast("decimal(20,0)")).alias("_sums"),
        F.bit_xor("_xor").alias("_xors"),
    ]


DIFFERENT = "_rows <> 0 OR _sums <> 0 OR _xors <> 0"


def suspects(source: DataFrame, target: DataFrame, keys: list[str], values: list[str], levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Rows of both sides in buckets that differ, at the finest level."""
    both = _both(source, target, keys, values)
    for bits in levels:
        found = both.groupBy(_bucket(bits).alias("_bucket")).agg(*_differences()).where(DIFFERENT).select("_bucket")
        # Written, so that the join knows how few they are; at most 2 ** bits.
        found = materialize(found, f"differing-{bits}")
        both = both.withColumn("_bucket", _bucket(bits)).join(found, "_bucket", "left_semi").drop("_bucket")
    return both


def compare_keys(source: DataFrame, target: DataFrame, keys: list[str], values: list[str], levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Keys whose rows differ: `keys`, status (MISSING or EXTRA in the target, or CHANGED), source_rows, target_rows."""
    rows = suspects(source, target, keys, values, levels)
    names = [F.col(f"_c{i}").alias(name) for i, name in enumerate(keys)]
    counted = [F.count_if(F.col("_sign") == sign).alias(side) for side, sign in (("source_rows", 1), ("target_rows", -1))]
    status = F.when(F.col("target_rows") == 0, "MISSING").when(F.col("source_rows") == 0, "EXTRA").otherwise("CHANGED")
    found = rows.groupBy(*[f"_c{i}" for i in range(len(keys))]).agg(*counted, *_differences()).where(DIFFERENT)
    return found.select(*names, status.alias("status"), "source_rows", "target_rows")
