"""Star schema over the clean datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from plumbline.functions.parsing import date_key
from plumbline.operators.keys import add_dense_key, add_ordered_key


def calendar(dates: DataFrame) -> DataFrame:
    """Date dimension of the distinct days in a one-column frame, with their parts."""
    d = F.col("calendar_date")
    return dates.toDF("calendar_date").distinct().select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
    )


def dim_date(orders: DataFrame, controls: DataFrame) -> DataFrame:
    """One row per date that an order or a control has."""
    return calendar(orders.select("order_date").union(controls.select("control_date")))


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per customer, numbered by business key."""
    rows = customer_rows(customers)
    return add_dense_key(rows, "customer_key", rows.columns)


def with_kept_key(rows: DataFrame, keys: DataFrame, by: str, key: str) -> DataFrame:
    """Dimension rows with the numbers of a stored key map (`keys.keep_keys`)."""
    held = keys.select(F.col(by).alias("_by"), key)
    return rows.join(held, F.col(by).eqNullSafe(F.col("_by"))).select(key, *rows.columns)


def customer_rows(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_name", "segment", "status", "created_date")


def category_rows(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("category").alias("category_code")).distinct()


def dim_category(orders: DataFrame) -> DataFrame:
    """Distinct categories, numbered in sorted order (O4). The codes of a conformed domain fit one window."""
    codes = category_rows(orders)
    number = F.row_number().over(W.orderBy("category_code")).cast("bigint")
    return codes.select(number.alias("category_key"), "category_code")


def order_facts(orders: DataFrame, customers: DataFrame, categories: DataFrame) -> DataFrame:
    """Orders with their dimension keys (J6, J7), one row per order.

    `customers` and `categories` are the dimensions. No join strategy is forced: a dimension read from a
    table is broadcast by its size, and beyond that the join sorts and adaptive execution splits hot keys.
    """
    return (
        orders.join(categories, orders["category"] == categories["category_code"])
        .join(customers.select("customer_id", "customer_key"), "customer_id")
        .select(
            "order_id",
            "customer_key",
            date_key(F.col("order_date")).alias("order_date_key"),
            "category_key",
            "order_amount",
            F.col("currency").alias("currency_code"),
        )
    )


def fact_sales_order(orders: DataFrame, customers: DataFrame, categories: DataFrame) -> DataFrame:
    """`order_facts` numbered by order id without gaps."""
    return add_dense_key(order_facts(orders, customers, categories), "order_key", ["order_id"])


def published_orders(orders: DataFrame, customers: DataFrame, categories: DataFrame) -> DataFrame:
    """`order_facts` with an order key that ascends with the order id, as the published table is: written only once."""
    return add_ordered_key(order_facts(orders, customers, categories), "order_key", ["order_id"])


def control_facts(controls: DataFrame) -> DataFrame:
    """Controls with their date key, which is computed and not looked up."""
    return controls.select(
        date_key(F.col("control_date")).alias("control_date_key"),
        "source_system",
        "order_count",
        "order_amount",
        F.col("currency").alias("currency_code"),
    )


def fact_reconciliation_control(controls: DataFrame) -> DataFrame:
    columns = ["control_date_key", "source_system", "currency_code", "order_count", "order_amount"]
    return add_dense_key(control_facts(controls), "control_key", columns)


def star_orders(fact: DataFrame, dates: DataFrame, customers: DataFrame, categories: DataFrame) -> DataFrame:
    """Orders with their descriptive attributes.

    The join strategies are left to the dimensions' measured sizes.
    """
    return (
        fact.join(dates.select("date_key", "calendar_date"), fact["order_date_key"] == F.col("date_key"))
        .join(categories.select("category_key", "category_code"), "category_key")
        .join(customers.select("customer_key", "segment"), "customer_key")
        .select(
            "order_id",
            F.col("calendar_date").alias("order_date"),
            "segment",
            F.col("category_code").alias("category"),
            "order_amount",
            "currency_code",
        )
    )
