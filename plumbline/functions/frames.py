"""Small literal DataFrames, such as a rule catalogue, made inside the plan."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F


def literal_rows(spark: SparkSession, rows: list[tuple[Any, ...]], columns: dict[str, str]) -> DataFrame:
    """Rows given in the program as a DataFrame. The planner knows it is small, so joins broadcast it."""
    structs = [
        F.struct(*[F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(row, columns.items())])
        for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], ", ".join(f"{name} {kind}" for name, kind in columns.items()))
    return spark.range(1).select(F.inline(F.array(*structs)))
