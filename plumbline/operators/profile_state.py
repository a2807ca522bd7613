"""Column profiles kept as a state per day, and merged for any range of days without a second scan.

A day's state holds counters and bounds, which merge exactly, and two sketches: one of the distinct values, one of the
quantiles of a number. States are appended, a run's under its time and with the range of days it stated. A day counts as
stated by the last run whose range holds it, so a day can be stated again, and one without rows left is stated as none.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from plumbline.functions.numeric import ratio_half_even
from plumbline.functions.parsing import utc_stamp
from plumbline.functions.text import is_blank
from plumbline.sources.files import append_governed, read_governed

#: Buckets of the distinct sketch are 2 to this power: a standard error of 0.8 %.
DISTINCT_BITS = 14
#: Size of the quantile sketch: ranks are within 0.7 % or so.
QUANTILE_SIZE = 400

STATE_SCHEMA = (
    "dataset string, day date, column_name string, row_count bigint, null_count bigint, min_value string, max_value string, "
    "distinct_sketch binary, quantile_sketch binary, stated_at timestamp"
)
RUN_SCHEMA = "dataset string, first_day date, last_day date, stated_at timestamp"


def daily_state(df: DataFrame, dataset: str, day: str) -> DataFrame:
    """State of every column but `day`, for each day: one aggregation, of which a row per day and task is shuffled."""
    columns = [f for f in df.schema if f.name != day]
    text = {f.name: F.col(f"`{f.name}`").cast("string") for f in columns}
    per_column = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.count("*").alias("row_count"),
            F.count_if(is_blank(text[f.name])).alias("null_count"),
            F.min(text[f.name]).alias("min_value"),
            F.max(text[f.name]).alias("max_value"),
            F.hll_sketch_agg(text[f.name], DISTINCT_BITS).alias("distinct_sketch"),
            (
                F.kll_sketch_agg_double(F.col(f"`{f.name}`").cast("double"), QUANTILE_SIZE)
                if isinstance(f.dataType, T.NumericType)
                else F.lit(None).cast("binary")
            ).alias("quantile_sketch"),
        ).alias(f"_{i}")
        for i, f in enumerate(columns)
    ]
    names = [f"_{i}" for i in range(len(columns))]
    days = df.where(F.col(f"`{day}`").isNotNull()).groupBy(F.col(f"`{day}`").cast("date").alias("day")).agg(*per_column)
    return days.select(F.lit(dataset).alias("dataset"), "day", F.inline(F.array(*names)))


def keep_state(df: DataFrame, dataset: str, day: str, first: date, last: date, stated_at: datetime, path: str) -> None:
    """State the days from `first` to `last` (inclusive) from `df`, and append them below `path`.

    The run is noted last, so that one which broke off is not seen.
    """
    spark, at = df.sparkSession, utc_stamp(stated_at)
    within = F.col(f"`{day}`").cast("date").between(F.lit(first), F.lit(last))
    append_governed(daily_state(df.where(within), dataset, day).withColumn("stated_at", at), f"{path}/state")
    run = spark.range(1).select(F.lit(dataset).alias("dataset"), F.lit(first).alias("first_day"), F.lit(last).alias("last_day"), at.alias("stated_at"))
    append_governed(run.coalesce(1), f"{path}/runs")


def current_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of each day by the last finished run that stated it. Runs are few; days are looked up in them."""
    runs = read_governed(spark, f"{path}/runs", RUN_SCHEMA)
    state = read_governed(spark, f"{path}/state", STATE_SCHEMA)
    days = state.select("dataset", "day").distinct()
    covers = (F.col("r.dataset") == F.col("d.dataset")) & F.col("d.day").between(F.col("r.first_day"), F.col("r.last_day"))
    last = days.alias("d").join(runs.alias("r"), covers).groupBy("d.dataset", "d.day").agg(F.max("r.stated_at").alias("stated_at"))
    return state.join(last, ["dataset", "day", "stated_at"])


def merged(state: DataFrame, first: date, last: date) -> DataFrame:
    """One row per dataset and column for a range of days: counts and bounds exact, distinct_count and quartiles (of a
    number) estimated."""
    range_ = state.where(F.col("day").between(F.lit(first), F.lit(last)))
    one = range_.groupBy("dataset", "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.hll_union_agg("distinct_sketch").alias("_distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"),
        F.count("quantile_sketch").alias("_numbers"),
    )
    quartiles = F.kll_sketch_get_quantile_double("_quantiles", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    filled = (F.col("_numbers") > 0) & (F.kll_sketch_get_n_double("_quantiles") > 0)
    rate = ratio_half_even(F.col("null_count"), F.col("row_count"))
    return one.select(
        "dataset",
        "column_name",
        "row_count",
        "null_count",
        F.coalesce(rate.cast("double"), F.lit(0.0)).alias("null_rate_pct"),
        F.hll_sketch_estimate("_distinct").alias("distinct_count"),
        F.coalesce("min_value", F.lit("")).alias("min_value"),
        F.coalesce("max_value", F.lit("")).alias("max_value"),
        F.when(filled, quartiles).alias("quartiles"),
    )
