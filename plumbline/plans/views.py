"""The reporting layer as temp views, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.operators import kpi, recon, rules


def model_views(model: dict[str, DataFrame], checks: DataFrame) -> dict[str, DataFrame]:
    """Reporting views over the star tables and the check results."""
    fact, controls = model["fact_sales_order"], model["fact_reconciliation_control"]
    dates, customers = model["dim_date"], model["dim_customer"]
    daily = kpi.daily_sales(fact, dates)
    reconciled = recon.daily(fact, controls, dates)
    return {
        "vw_daily_sales_kpi": daily,
        "vw_monthly_sales_trend": kpi.monthly_trend(daily),
        "vw_customer_segment_kpi": kpi.segment_kpi(fact, customers),
        "vw_customer_cohort_month": kpi.cohort_month(fact, customers, dates),
        "vw_quality_exceptions": kpi.quality_exceptions(checks),
        "vw_reconciliation_daily": reconciled,
        "vw_reconciliation_exceptions": recon.exceptions(reconciled),
        "vw_enterprise_kpi_summary": kpi.enterprise_summary(fact, checks, reconciled),
    }


def governance_views(results: DataFrame, incidents: DataFrame) -> dict[str, DataFrame]:
    return {
        "vw_governed_rule_status": rules.rule_status(results),
        "vw_open_data_incidents": rules.open_incidents(incidents),
    }


def install(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Create or replace a temp view per frame."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
