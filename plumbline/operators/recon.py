"""Reconciliation of curated facts against source controls."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

ZERO_TOLERANCE = Decimal("0.00")


def curated_totals(fact: DataFrame) -> DataFrame:
    """Orders and amount per date and currency (A5)."""
    return fact.groupBy(F.col("order_date_key").alias("date_key"), "currency_code").agg(
        F.count("*").alias("curated_order_count"), F.sum("order_amount").alias("curated_order_amount")
    )


def source_totals(controls: DataFrame) -> DataFrame:
    """Control totals per date and currency, across source systems."""
    return controls.groupBy(F.col("control_date_key").alias("date_key"), "currency_code").agg(
        F.sum("order_count").alias("source_order_count"), F.sum("order_amount").alias("source_order_amount")
    )


def daily(fact: DataFrame, controls: DataFrame, dates: DataFrame, tolerance: Decimal = ZERO_TOLERANCE) -> DataFrame:
    """Source against curated per date and currency.

    Both sides are summed to unique keys before the full outer join, so what it shuffles grows with the
    number of keys and no key can be hot. A side that lacks a key counts as zero.
    """
    money = "decimal(38,2)"
    zero = {
        "source_order_count": F.lit(0).cast("bigint"),
        "curated_order_count": F.lit(0).cast("bigint"),
        "source_order_amount": F.lit(0).cast(money),
        "curated_order_amount": F.lit(0).cast(money),
    }
    both = source_totals(controls).join(curated_totals(fact), ["date_key", "currency_code"], "full_outer")
    filled = both.select(
        "date_key", "currency_code", *[F.coalesce(F.col(c), z).alias(c) for c, z in zero.items()]
    )
    count_variance = F.col("source_order_count") - F.col("curated_order_count")
    amount_variance = F.col("source_order_amount") - F.col("curated_order_amount")
    agrees = (count_variance == 0) & (F.abs(amount_variance) <= F.lit(tolerance))
    day = dates.select("date_key", "calendar_date")
    return filled.join(day, "date_key").select(
        "calendar_date",
        "currency_code",
        "source_order_count",
        "curated_order_count",
        count_variance.alias("order_count_variance"),
        "source_order_amount",
        "curated_order_amount",
        amount_variance.cast(money).alias("amount_variance_usd"),
        F.lit(tolerance).cast("decimal(18,2)").alias("documented_amount_tolerance_usd"),
        F.when(agrees, "PASS").otherwise("FAIL").alias("reconciliation_status"),
    )


def daily_proof(recon_daily: DataFrame) -> DataFrame:
    """Daily reconciliation in reading order (O1)."""
    return recon_daily.orderBy("calendar_date", "currency_code")


def exceptions(recon_daily: DataFrame) -> DataFrame:
    """Days and currencies that do not agree: empty before publication (F2, O2)."""
    return recon_daily.where(F.col("reconciliation_status") == "FAIL")


def close(recon_daily: DataFrame, tolerance: Decimal = ZERO_TOLERANCE) -> DataFrame:
    """Totals over the whole period and their status (A7, N4). Opposite daily variances cancel out."""
    totals = recon_daily.agg(
        F.sum("source_order_count").alias("source_order_count"),
        F.sum("curated_order_count").alias("curated_order_count"),
        F.sum("order_count_variance").alias("count_variance"),
        F.sum("source_order_amount").alias("source_order_amount"),
        F.sum("curated_order_amount").alias("curated_order_amount"),
        F.sum("amount_variance_usd").alias("amount_variance_usd"),
    )
    closed = (F.col("count_variance") == 0) & (F.abs("amount_variance_usd") <= F.lit(tolerance))
    return totals.withColumn("close_status", F.when(closed, "PASS").otherwise("FAIL"))


def check_exceptions(checks: DataFrame) -> DataFrame:
    """Failed reconciliation controls of the check suite."""
    return checks.where(F.col("check_id").ilike("RECON_%") & (F.col("status") == "FAIL")).select(
        "check_id", "observed", "expected", "detail", "evaluated_at_utc"
    )
