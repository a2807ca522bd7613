"""The given tables as the datasets the library works on.

Orders stand for sales orders (order status in place of the currency, order priority as the category),
customers for the customer master, and orders summed per day, priority and status for the source controls.
The two sides drift on purpose: the source did not book the largest orders, and the curated side lost the
smallest. Raw text is rendered from the typed columns, so cleaning can be checked against them. Events stand
for governance exceptions and for refreshes.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.functions.parsing import MONEY, date_key
from plumbline.functions.text import normalize_enum
from plumbline.sources.contracts import Policy

EVALUATED_AT = datetime(2024, 2, 5, 6, 0)
DAY = date(2024, 2, 5)
STATE_DAYS = [date(2024, 1, 8), date(2024, 1, 15), date(2024, 1, 25)]

SOURCE_CEILING = 499000  # the source did not book orders from here on
CURATED_FLOOR = 2000  # the curated side lost orders below this
SAMPLE_SECRET = "not for production"  # a deployment takes it from its own store
FIRST_DAY = "1995-01-01"  # creation date of a customer without orders

POLICY = Policy(
    segments=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
    statuses=("ACTIVE",),
    categories=("1_URGENT", "2_HIGH", "3_MEDIUM", "4_NOT_SPECIFIED"),
    currencies=("F", "O"),
    max_amount=450000,
)

#: Customers that come twice are a warning.
WARN_POLICY = replace(POLICY, warn_limit={"DUP_CUSTOMERS": 1_000_000_000})


def _rule(rule_id: str, dataset: str, kind: str, severity: str, owner: str, description: str, **fields) -> dict:
    return {
        "rule_id": rule_id, "dataset": dataset, "kind": kind, "severity": severity, "owner": owner,
        "description": description, **fields,
    }


#: All that occurs is approved, so that a publication passes its gate.
OPEN_POLICY = Policy(
    segments=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    statuses=("ACTIVE", "INACTIVE"),
    categories=("1_URGENT", "2_HIGH", "3_MEDIUM", "4_NOT_SPECIFIED", "5_LOW"),
    currencies=("F", "O", "P"),
    max_amount=10_000_000,
)

RULES = {
    "version": "1.0",
    "incident_policy": {"open_on_status": ["FAIL"]},
    "rules": [
        _rule(
            "ORDER_BIG_TICKET", "sales_orders", "expression", "HIGH", "Credit", "Large orders are not low priority",
            condition="order_amount < 300000.00 OR category <> '5_LOW'",
        ),
        _rule(
            "ORDER_SETTLED", "sales_orders", "expression", "LOW", "Fulfilment", "No order is half shipped",
            condition="currency <> 'P'",
        ),
        _rule(
            "ORDER_BUYER", "sales_orders", "foreign_key", "CRITICAL", "Accounts", "The buyer is a known account",
            column="customer_id", reference_dataset="customers", reference_column="customer_id",
        ),
        _rule(
            "ORDER_LINES", "sales_orders", "foreign_key", "MEDIUM", "Fulfilment", "Each order has at least one line",
            column="order_id", reference_dataset="order_lines", reference_column="order_id",
        ),
        _rule(
            "LINE_DISCOUNT", "order_lines", "expression", "HIGH", "Pricing", "Small lines get at most eight percent off",
            condition="quantity >= 5.00 OR discount <= 0.08",
        ),
        _rule(
            "LINE_ORDER", "order_lines", "foreign_key", "CRITICAL", "Fulfilment", "A line belongs to an order",
            column="order_id", reference_dataset="sales_orders", reference_column="order_id",
        ),
        _rule(
            "LINE_SHIPPED", "order_lines", "freshness", "MEDIUM", "Logistics", "Something was shipped this month",
            column="ship_date", max_age_days=30,
        ),
        _rule(
            "EVENT_PURCHASE_VALUE", "events", "expression", "MEDIUM", "Product", "A purchase is worth something",
            condition="event_type <> 'purchase' OR value >= 1",
        ),
        _rule(
            "EVENT_RECENT", "events", "freshness", "HIGH", "Product", "Events came in within the week",
            column="ts", max_age_days=7,
        ),
    ],
}


#: A rule whose limit was raised once and tightened later, and one that came in between; and since when each version holds.
VERSIONED = [
    _rule("ORDER_LIMIT", "sales_orders", "expression", "HIGH", "Credit", "First limit", condition="order_amount < 300000.00", version=1),
    _rule("ORDER_LIMIT", "sales_orders", "expression", "HIGH", "Credit", "Raised limit", condition="order_amount < 400000.00", version=2),
    _rule("ORDER_LIMIT", "sales_orders", "expression", "CRITICAL", "Risk", "Tight limit", condition="order_amount < 250000.00 OR category = '1_URGENT'", version=3),
    _rule("ORDER_SETTLED", "sales_orders", "expression", "LOW", "Fulfilment", "No order is half shipped", condition="currency <> 'P'", version=1),
]
IN_EFFECT = [
    ("ORDER_LIMIT", 1, date(1992, 1, 1)), ("ORDER_LIMIT", 2, date(1995, 6, 17)), ("ORDER_LIMIT", 3, date(1997, 3, 1)),
    ("ORDER_SETTLED", 1, date(1996, 2, 10)),
]
#: The days a profile is merged for.
RANGE = (date(1994, 3, 5), date(1996, 11, 20))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- typed datasets -------------------------------------------------------------------------------


def sales_orders(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    """`where` is over the stored columns, so that it reaches the scan."""
    return table(spark, sf, "orders").where(where).select(
        F.concat(F.lit("SO"), "o_orderkey").alias("order_id"),
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"),
        F.col("o_orderstatus").alias("currency"),
        normalize_enum(F.col("o_orderpriority")).alias("category"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    first_order = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_day")
    )
    return table(spark, sf, "customer").join(first_order, "c_custkey", "left").select(
        F.concat(F.lit("C"), "c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        F.coalesce("first_day", F.lit(FIRST_DAY).cast("date")).alias("created_date"),
        F.col("c_custkey").alias("customer_key"),
    )


def gl_controls(spark: SparkSession, sf: str, drift: bool = False) -> DataFrame:
    """Controls over all orders; with `drift` the source has not booked the largest, for reconciliations to find."""
    return sales_orders(spark, sf, f"o_totalprice < {SOURCE_CEILING}" if drift else "true").groupBy(
        F.col("order_date").alias("control_date"), F.col("category").alias("source_system"), "currency"
    ).agg(F.count("*").alias("order_count"), F.sum("order_amount").cast(MONEY).alias("order_amount"))


# --- star -----------------------------------------------------------------------------------------


def fact(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    """Orders as a fact; the customer number is an integer key already."""
    return table(spark, sf, "orders").where(where).select(
        F.concat(F.lit("SO"), "o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_key"),
        date_key(F.col("o_orderdate").cast("date")).alias("order_date_key"),
        normalize_enum(F.col("o_orderpriority")).alias("category_key"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"),
        F.col("o_orderstatus").alias("currency_code"),
    )


def curated_fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf, f"o_totalprice >= {CURATED_FLOOR}")


def drifted_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A copy of the orders that lost the smallest, changed the largest and has urgent half-shipped ones twice, once under another key."""
    orders = sales_orders(spark, sf, f"o_totalprice >= {CURATED_FLOOR}")
    amount = F.col("order_amount")
    changed = orders.withColumn("order_amount", F.when(amount >= SOURCE_CEILING, amount + 1).otherwise(amount).cast(MONEY))
    again = sales_orders(spark, sf, "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    return changed.unionByName(again.withColumn("order_id", F.concat(F.lit("X"), "order_id")))


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_key"), F.col("c_mktsegment").alias("segment")
    )


# --- raw text -------------------------------------------------------------------------------------


def raw_orders(spark: SparkSession, sf: str, faulty: bool = False) -> DataFrame:
    """Orders as an extract would carry them: three date layouts, separators, mixed case, blanks.

    `faulty` spoils the date of the largest and the amount of the smallest orders.
    """
    amount, day = F.col("o_totalprice"), F.col("o_orderdate").cast("date")
    day_text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy/M/d"))
        .otherwise(F.date_format(day, "dd-MM-yyyy"))
    )
    amount_text = F.format_number(amount, 2)
    if faulty:
        day_text = F.when(amount >= SOURCE_CEILING, "2026-02-30").otherwise(day_text)
        amount_text = F.when(amount < CURATED_FLOOR, "n/a").otherwise(amount_text)
    return table(spark, sf, "orders").select(
        F.concat(F.lit(" so-"), "o_orderkey", F.lit(" ")).alias("order_id"),
        F.concat(F.lit("c-"), "o_custkey").alias("customer_id"),
        day_text.alias("order_date"),
        amount_text.alias("order_amount"),
        F.concat(F.lit(" "), F.lower("o_orderstatus")).alias("currency"),
        F.concat(F.lower("o_orderpriority"), F.lit("\t")).alias("category"),
        F.lit("batch").alias("load_note"),
    )


def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).select(
        F.lower("customer_id").alias("customer_id"),
        F.concat(F.lit("  "), "customer_name", F.lit("\t")).alias("customer_name"),
        F.lower("segment").alias("segment"),
        F.initcap("status").alias("status"),
        F.date_format("created_date", "yyyy/MM/dd").alias("created_date"),
    )


def raw_controls(spark: SparkSession, sf: str, drift: bool = False) -> DataFrame:
    return gl_controls(spark, sf, drift).select(
        F.date_format("control_date", "d-M-yyyy").alias("control_date"),
        F.concat(F.lower("source_system"), F.lit(" ")).alias("source_system"),
        F.concat(F.lit(" "), F.col("order_count").cast("string")).alias("order_count"),
        F.format_number("order_amount", 2).alias("order_amount"),
        F.lower("currency").alias("currency"),
    )


def failing_extracts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Extracts in which every kind of control finds something, by the last digits of the keys.

    Customers: some are missing, some come twice, some have no segment. Orders: some come twice, some have no currency;
    dates and amounts are spoiled as in `raw_orders`. Controls lack their source system and the largest orders.
    """
    buyers, sales = raw_customers(spark, sf), raw_orders(spark, sf, faulty=True)
    buyer = F.regexp_extract("customer_id", r"\d+", 0).cast("bigint")
    order = F.regexp_extract("order_id", r"\d+", 0).cast("bigint")
    buyers = buyers.where(buyer % 50 != 0).withColumn("segment", F.when(buyer % 30 == 2, " ").otherwise(F.col("segment")))
    sales = sales.withColumn("currency", F.when(order % 70 == 4, " ").otherwise(F.col("currency")))
    return {
        "customers": buyers.unionByName(buyers.where(buyer % 40 == 1)),
        "sales_orders": sales.unionByName(sales.where(order % 100 == 3)),
        "gl_controls": raw_controls(spark, sf, drift=True).drop("source_system"),
    }


# --- governance -----------------------------------------------------------------------------------


def rule_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "sales_orders": sales_orders(spark, sf),
        "customers": table(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("customer_id")),
        "order_lines": table(spark, sf, "lineitem").select(
            F.concat(F.lit("SO"), "l_orderkey").alias("order_id"),
            F.col("l_quantity").cast(MONEY).alias("quantity"),
            F.col("l_discount").cast(MONEY).alias("discount"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        ),
        "events": table(spark, sf, "events"),
    }


def exceptions(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as an exception. Its value is the time to assign it in hours; the larger `k` of its
    properties, the lower its severity and the longer its resolution; the smallest are unresolved."""
    k = F.get_json_object("props", "$.k").cast("int")
    seconds = F.round(F.col("value") * 100).cast("bigint") * 36

    def later(amount):
        return F.timestamp_add("SECOND", amount, F.col("ts"))

    return table(spark, sf, "events").select(
        F.col("event_id").alias("exception_id"),
        F.upper("event_type").alias("rule_id"),
        F.concat(F.lit("CAUSE_"), F.floor(k / 10)).alias("root_cause"),
        F.col("event_type").alias("domain"),
        F.when(k < 25, "CRITICAL").when(k < 50, "HIGH").when(k < 75, "MEDIUM").otherwise("LOW").alias("severity"),
        F.concat(F.lit("STEWARD_"), "user_id").alias("owner"),
        F.col("ts").alias("opened_at"),
        F.when(k < 95, later(seconds)).alias("assigned_at"),
        F.when(k >= 10, later(seconds * k)).alias("resolved_at"),
        F.when(k.between(5, 9) | (k < 5) & (F.col("event_type") == "click"), "ACCEPTED").alias("disposition"),
    )


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of the events that a multiple of nine days lies before."""
    day = F.to_date("ts")
    return table(spark, sf, "events").select(day.alias("day")).where(F.date_diff(day, F.lit("2024-01-02").cast("date")) % 9 == 0).distinct()


def fine_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values of events at a scale of nine decimals."""
    return table(spark, sf, "events").select(
        "event_id", (F.col("value").cast(MONEY) * F.lit(Decimal("0.0000001"))).cast("decimal(27,9)").alias("value")
    )


def line_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Floating measures of order lines; the price of returned ones and the tax of small ones is not a number."""
    none = F.lit(float("nan"))
    return table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "R", none).otherwise(F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_quantity") < 5, none).otherwise(F.col("l_tax")).alias("tax"),
    )


def refreshes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Each user as a data product that refreshes daily by noon; its events are the loads."""
    loads = table(spark, sf, "events").select(
        F.concat(F.lit("P"), "user_id").alias("product"),
        F.to_date("ts").alias("due_date"),
        F.col("ts").alias("received_at"),
    )
    span = loads.groupBy("product").agg(F.min("due_date").alias("first"), F.max("due_date").alias("last"))
    schedule = span.select("product", F.explode(F.sequence("first", "last")).alias("due_date")).withColumn(
        "due_at", F.timestamp_add("HOUR", F.lit(12), F.col("due_date").cast("timestamp_ntz"))
    )
    return schedule, loads


def event_incidents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """An incident per event type and day, and every event as a stewardship update to it."""
    events = table(spark, sf, "events")
    day = F.to_date("ts")
    key = F.concat_ws("|", F.upper("event_type"), F.lit("events"), day.cast("string"))
    incidents = events.groupBy("event_type", day.alias("day")).agg(
        F.min("ts").alias("opened_at_utc"), F.count("*").alias("failed_rows")
    ).select(
        F.concat(F.lit("INC-"), F.upper("event_type"), F.lit("-"), F.date_format("day", "yyyyMMdd")).alias("incident_id"),
        F.upper("event_type").alias("rule_id"),
        F.lit("events").alias("dataset"),
        F.lit("HIGH").alias("severity"),
        F.lit("Data Engineering").alias("owner"),
        F.lit("OPEN").alias("status"),
        "failed_rows",
        "opened_at_utc",
        F.concat_ws("|", F.upper("event_type"), F.lit("events"), F.col("day").cast("string")).alias("deduplication_key"),
    )
    k = F.get_json_object("props", "$.k").cast("int")
    updates = events.select(
        key.alias("deduplication_key"),
        F.col("ts").alias("updated_at"),
        F.when(k >= 50, "RESOLVED").otherwise("IN_PROGRESS").alias("status"),
        F.when(k >= 50, "FIXED").otherwise("PENDING").alias("disposition"),
        F.concat(F.lit("CAUSE_"), F.floor(k / 10)).alias("root_cause"),
        F.when(k >= 50, F.col("ts")).alias("resolved_at"),
    )
    return incidents, updates


def evaluations(spark: SparkSession, sf: str) -> DataFrame:
    """An evaluation an hour after every event; it passes for a tenth of them."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        F.upper("event_type").alias("rule_id"),
        F.lit("events").alias("dataset"),
        F.when(k % 10 == 7, "PASS").otherwise("FAIL").alias("status"),
        F.timestamp_add("HOUR", F.lit(1), F.col("ts")).alias("evaluated_at"),
    )


def rule_history(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Daily outcomes per event type, and two versions per rule, the second from a fortnight on."""
    daily = table(spark, sf, "events").groupBy(
        F.upper("event_type").alias("rule_id"), F.to_date("ts").alias("evaluation_day")
    ).agg(F.count("*").alias("failed_rows"))
    first = daily.groupBy("rule_id").agg(F.min("evaluation_day").alias("first"))
    change = F.date_add("first", 14)
    none = F.lit(None).cast("date")
    versions = first.select(
        "rule_id",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("version"), F.col("first").alias("effective_from"), change.alias("effective_to")),
                F.struct(F.lit(2).alias("version"), change.alias("effective_from"), none.alias("effective_to")),
            )
        ),
    )
    return daily, versions


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels, where they have any."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
