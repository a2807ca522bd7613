"""Reporting layer over the star schema.

Facts are summed to the grain of their foreign key before they meet a dimension: a customer holding a
third of all orders is one row by then, and a distinct count of customers becomes a plain count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from plumbline.functions.numeric import change_percent, percent, ratio
from plumbline.functions.parsing import month_start


def daily_sales(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders, revenue, average order value and distinct customers per day."""
    per_day = fact.groupBy("order_date_key").agg(
        F.count("*").alias("order_count"),
        F.sum("order_amount").alias("revenue_usd"),
        F.count("order_amount").alias("_amounts"),
        F.count_distinct("customer_key").alias("active_customers"),
    )
    day = dates.select("date_key", "calendar_date")
    return per_day.join(day, F.col("order_date_key") == F.col("date_key")).select(
        "calendar_date",
        "order_count",
        "revenue_usd",
        ratio(F.col("revenue_usd"), F.col("_amounts")).alias("average_order_value"),
        "active_customers",
    )


def monthly_trend(daily: DataFrame) -> DataFrame:
    """Daily KPIs rolled up to months, each against the month before it that has data.

    `active_customer_days` adds the days' distinct customers: it counts customer-days.
    """
    monthly = daily.groupBy(month_start(F.col("calendar_date")).alias("month_start")).agg(
        F.sum("revenue_usd").alias("revenue_usd"),
        F.sum("order_count").alias("order_count"),
        F.sum("active_customers").alias("active_customer_days"),
    )
    # One row per month: the single window partition is bounded by the calendar.
    by_month = W.orderBy("month_start")
    before = monthly.withColumns(
        {
            "prior_period_revenue_usd": F.lag("revenue_usd").over(by_month),
            "_prior_orders": F.lag("order_count").over(by_month),
        }
    )
    return before.select(
        "month_start",
        "revenue_usd",
        "order_count",
        "active_customer_days",
        "prior_period_revenue_usd",
        change_percent(F.col("revenue_usd"), F.col("prior_period_revenue_usd")).alias("revenue_period_over_period_pct"),
        change_percent(F.col("order_count"), F.col("_prior_orders")).alias("order_period_over_period_pct"),
    )


def _per_customer(fact: DataFrame, *also: Column) -> DataFrame:
    return fact.groupBy("customer_key", *also).agg(
        F.count("*").alias("_orders"),
        F.sum("order_amount").alias("_revenue"),
        F.count("order_amount").alias("_amounts"),
    )


def segment_kpi(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with orders, orders, revenue, average and share of revenue per segment."""
    per_segment = (
        _per_customer(fact)
        .join(customers.select("customer_key", "segment"), "customer_key")
        .groupBy("segment")
        .agg(
            F.count("*").alias("customers_with_orders"),
            F.sum("_orders").alias("order_count"),
            F.sum("_revenue").alias("revenue_usd"),
            F.sum("_amounts").alias("_n"),
        )
    )
    total = F.sum("revenue_usd").over(W.partitionBy())  # over one row per segment
    return per_segment.select(
        "segment",
        "customers_with_orders",
        "order_count",
        "revenue_usd",
        ratio(F.col("revenue_usd"), F.col("_n")).alias("average_order_value"),
        percent(F.col("revenue_usd"), total).alias("revenue_share_pct"),
    )


def cohort_month(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Customers, orders and revenue per month of customer creation and month of order.

    The fact's date key already holds year and month, so facts are first summed per customer and day-key
    month; the date dimension then only supplies which months exist.
    """
    order_month = F.floor(F.col("order_date_key") / 100).cast("int").alias("_yyyymm")
    months = dates.select(
        F.floor(F.col("date_key") / 100).cast("int").alias("_yyyymm"),
        month_start(F.col("calendar_date")).alias("order_month"),
    ).distinct()
    return (
        _per_customer(fact, order_month)
        .join(
            customers.select("customer_key", month_start(F.col("created_date")).alias("cohort_month")),
            "customer_key",
        )
        .groupBy("cohort_month", "_yyyymm")
        .agg(
            F.count("*").alias("active_customers"),
            F.sum("_orders").alias("order_count"),
            F.sum("_revenue").alias("revenue_usd"),
        )
        .join(months, "_yyyymm")
        .select("cohort_month", "order_month", "active_customers", "order_count", "revenue_usd")
    )


def quality_exceptions(checks: DataFrame) -> DataFrame:
    """Failed and warned checks (F1)."""
    return checks.where(F.col("status").isin("FAIL", "WARN")).select(
        "check_id", "status", "observed", "expected", "detail", "evaluated_at_utc"
    )


def pass_rate(status: Column) -> Column:
    """Share of checks that passed (A8); NULL without checks."""
    return percent(F.count_if(status == "PASS"), F.count("*"))


def enterprise_summary(fact: DataFrame, checks: DataFrame, recon_daily: DataFrame) -> DataFrame:
    """One row: volume, revenue, pass rate and the two open exception counts."""
    sales = fact.agg(F.count("*").alias("sales_order_count"), F.sum("order_amount").alias("sales_revenue_usd"))
    # One-row aggregates, fetched as scalar subqueries.
    quality = checks.agg(
        F.struct(
            pass_rate(F.col("status")).alias("rate"),
            F.count_if(F.col("status").isin("FAIL", "WARN")).alias("open"),
        )
    ).scalar()
    recon = recon_daily.agg(F.count_if(F.col("reconciliation_status") == "FAIL")).scalar()
    return sales.withColumn("_quality", quality).select(
        "sales_order_count",
        "sales_revenue_usd",
        F.col("_quality.rate").alias("data_quality_pass_rate_pct"),
        F.col("_quality.open").alias("open_quality_exceptions"),
        recon.alias("reconciliation_exceptions"),
    )
