"""Column profiles of a dataset in one action."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from plumbline.functions.parsing import utc_stamp
from plumbline.functions.numeric import ratio_half_even
from plumbline.functions.text import identity, is_blank


def _finish(measured: DataFrame, dataset: str, evaluated_at: datetime) -> DataFrame:
    rate = ratio_half_even(F.col("null_count"), F.col("row_count"))
    return measured.select(
        F.lit(dataset).alias("dataset"),
        "column_name",
        "row_count",
        "null_count",
        F.coalesce(rate.cast("double"), F.lit(0.0)).alias("null_rate_pct"),
        "distinct_count",
        F.coalesce("min_value", F.lit("")).alias("min_value"),
        F.coalesce("max_value", F.lit("")).alias("max_value"),
        utc_stamp(evaluated_at).alias("evaluated_at_utc"),
    )


def profile(df: DataFrame, dataset: str, evaluated_at: datetime, distinct: str = "exact") -> DataFrame:
    """Rows, blanks, distinct values and lexical bounds of every column, all as text.

    Rows, blanks and bounds of all columns are one aggregation that shuffles a row per task. Distinct
    values are counted by how `distinct` says:

    `exact`: distinct (column, value) pairs, which drops repeated values before the shuffle, spreads each
    column's values over all tasks, and carries long text as its digest. This reads the table a second time.
    `approx`: sketches within the one aggregation, for tables whose columns are mostly unique.
    """
    if distinct not in ("exact", "approx"):
        raise ValueError(f"unknown distinct mode: {distinct}")
    columns = df.columns
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count("*").alias("row_count"),
            F.count_if(is_blank(F.col(c))).alias("null_count"),
            F.min(c).alias("min_value"),
            F.max(c).alias("max_value"),
            *([F.approx_count_distinct(c, 0.02).alias("distinct_count")] if distinct == "approx" else []),
        ).alias(c)
        for c in columns
    ]
    measured = text.agg(*per_column).select(F.inline(F.array(*columns)))
    if distinct == "exact":
        values = text.select(*[identity(F.col(c)).alias(c) for c in columns])
        counts = (
            values.unpivot([], columns, "column_name", "value")
            .where("value IS NOT NULL")
            .distinct()
            .groupBy("column_name")
            .agg(F.count("*").alias("distinct_count"))
        )
        # A column of NULLs only has no distinct values. One row per column on either side.
        measured = measured.join(counts, "column_name", "left").na.fill(0, ["distinct_count"])
    return _finish(measured, dataset, evaluated_at)


def profile_all(frames: dict[str, DataFrame], evaluated_at: datetime, distinct: str = "exact") -> DataFrame:
    """Profiles of several datasets (U4)."""
    profiles = [profile(df, name, evaluated_at, distinct) for name, df in frames.items()]
    result = profiles[0]
    for each in profiles[1:]:
        result = result.unionByName(each)
    return result
