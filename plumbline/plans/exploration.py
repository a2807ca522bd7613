"""Descriptive statistics over the published model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.operators import eda, star


def run(model: dict[str, DataFrame], checks: DataFrame) -> dict[str, DataFrame]:
    """Result tables by name. Only the distribution runs ahead, to find its quartiles."""
    fact = model["fact_sales_order"]
    orders = star.star_orders(fact, model["dim_date"], model["dim_customer"], model["dim_category"])
    return {
        "headline": eda.headline(fact, checks),
        "missing_values": eda.missing_values(orders),
        "distribution": eda.distribution(fact, "order_amount"),
        "histogram": eda.histogram(fact, "order_amount"),
        "correlation": eda.correlation(fact.select("order_amount")),
        "revenue_by_category": eda.revenue_by_dimension(fact, model["dim_category"], "category_key", "category_code"),
        "revenue_by_segment": eda.revenue_by_dimension(fact, model["dim_customer"], "customer_key", "segment"),
    }
