"""Runs of business days: for how long refreshes came on time in a row, and where they didn't."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def business_days(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """(day, number): the days from Monday to Friday between the first and last `day`, but for `holidays`, from 1 on.

    `holidays` is a frame of one date column. The window is over calendar days only.
    """
    span = days.agg(F.min("day").alias("low"), F.max("day").alias("high")).where("low IS NOT NULL")
    dates = span.select(F.explode(F.sequence("low", "high")).alias("day")).where(F.weekday("day") < 5)
    return dates.join(holidays.toDF("day").distinct(), "day", "left_anti").withColumn("number", F.row_number().over(W.orderBy("day")))


def refresh_runs(refreshes: DataFrame, holidays: DataFrame) -> DataFrame:
    """Longest stretches of consecutive business days on which a product's refreshes all were on time, or weren't.

    `refreshes`: product, due_date, refresh_status. A product with several refreshes a day is on time if each is. Days
    that are no business days don't count and don't part a run; a business day without a scheduled refresh parts it.
    Rows without a day are in no run. A product's window holds a row a day, so the calendar bounds it.
    """
    daily = refreshes.groupBy("product", F.col("due_date").alias("day")).agg(
        F.min(F.coalesce(F.col("refresh_status") == "ON_TIME", F.lit(False))).alias("on_time")
    )
    numbered = daily.join(business_days(refreshes.select(F.col("due_date").alias("day")), holidays), "day")
    by_day = W.partitionBy("product").orderBy("number")
    goes_on = (F.lag("number").over(by_day) == F.col("number") - 1) & (F.lag("on_time").over(by_day) == F.col("on_time"))
    begins = numbered.withColumn("_begins", F.when(goes_on, 0).otherwise(1))
    runs = begins.withColumn("_run", F.sum("_begins").over(by_day.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy("product", "_run").agg(
        F.first("on_time").alias("on_time"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count("*").alias("business_days"),
    ).drop("_run")


def refresh_streaks(runs: DataFrame, wanted: int = 20) -> DataFrame:
    """Longest on-time streak, gaps and longest gap per product, and whether `wanted` days in a row were reached.

    Of equal streaks the earliest is named; a product that was never on time has a streak of 0 days.
    """
    rank = F.struct("business_days", (-F.unix_date("first_day")).alias("early"), "first_day", "last_day")
    longest = runs.groupBy("product").agg(
        F.max(F.when(F.col("on_time"), rank)).alias("best"),
        F.count_if(~F.col("on_time")).alias("gaps"),
        F.coalesce(F.max(F.when(~F.col("on_time"), F.col("business_days"))), F.lit(0).cast("bigint")).alias("longest_gap"),
    )
    days = F.coalesce("best.business_days", F.lit(0).cast("bigint"))
    return longest.select(
        "product",
        days.alias("longest_on_time"),
        F.col("best.first_day").alias("streak_from"),
        F.col("best.last_day").alias("streak_to"),
        "gaps",
        "longest_gap",
        (days >= wanted).alias("reached"),
    )
