"""Cleaning of raw extracts into typed datasets, and the rows that cannot be typed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.functions import parsing, text
from plumbline.sources.contracts import CLEAN_COLUMNS

# How each column is standardised, in contract order.
CLEANERS = {
    "customers": {
        "customer_id": text.normalize_key,
        "customer_name": text.strip,
        "segment": text.normalize_enum,
        "status": text.normalize_enum,
        "created_date": parsing.parse_date,
    },
    "sales_orders": {
        "order_id": text.normalize_key,
        "customer_id": text.normalize_key,
        "order_date": parsing.parse_date,
        "order_amount": parsing.parse_amount,
        "currency": text.normalize_code,
        "category": text.normalize_enum,
    },
    "gl_controls": {
        "control_date": parsing.parse_date,
        "source_system": text.normalize_code,
        "order_count": parsing.parse_integer,
        "order_amount": parsing.parse_amount,
        "currency": text.normalize_code,
    },
}


class RejectedRows(ValueError):
    """Strict cleaning met a value it cannot parse."""


def _parsed_columns(dataset: str) -> list[str]:
    return [name for name, kind in CLEAN_COLUMNS[dataset].items() if kind != "string"]


def standardize(raw: DataFrame, dataset: str) -> DataFrame:
    """Every raw row with its typed columns; extra raw columns are dropped."""
    return raw.select(*[cleaner(F.col(name)).alias(name) for name, cleaner in CLEANERS[dataset].items()])


def parse(raw: DataFrame, dataset: str) -> DataFrame:
    """Every raw row with its typed columns, `reject_reason`, and `raw_row` where there is a reason (C11).

    The reason names the dates, amounts and counts that are absent or do not parse. Written once, this
    answers both for the accepted rows and for the rejects, so that raw text is parsed in one pass.
    """
    names = list(CLEANERS[dataset])
    # The raw columns step aside, so that the reason can be read off the typed ones.
    kept = raw.select(F.struct(*names).alias("raw_row"))
    typed = kept.select(*[cleaner(F.col(f"raw_row.{name}")).alias(name) for name, cleaner in CLEANERS[dataset].items()], "raw_row")
    failed = [F.when(F.col(name).isNull(), F.lit(name)) for name in _parsed_columns(dataset)]
    reason = F.nullif(F.concat_ws(", ", *failed), F.lit(""))
    return typed.withColumn("reject_reason", reason).withColumn(
        "raw_row", F.when(F.col("reject_reason").isNotNull(), F.col("raw_row"))
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Typed rows of a parsed dataset that are not rejected."""
    return parsed.where("reject_reason IS NULL").drop("reject_reason", "raw_row")


def rejects(parsed: DataFrame) -> DataFrame:
    """Raw text of the rejected rows of a parsed dataset, with the reason."""
    return parsed.where("reject_reason IS NOT NULL").select("raw_row.*", "reject_reason")


def clean(parsed: DataFrame, mode: str = "strict") -> DataFrame:
    """Typed dataset. `strict` raises if any row is rejected; `quarantine` leaves rejected rows out."""
    if mode == "strict":
        bad = rejects(parsed).first()
        if bad is not None:
            raise RejectedRows(f"cannot parse {bad['reject_reason']}: {bad.asDict()}")
    elif mode != "quarantine":
        raise ValueError(f"unknown mode: {mode}")
    return accepted(parsed)


def clean_customers(raw: DataFrame, mode: str = "strict") -> DataFrame:
    return clean(parse(raw, "customers"), mode)


def clean_orders(raw: DataFrame, mode: str = "strict") -> DataFrame:
    return clean(parse(raw, "sales_orders"), mode)


def clean_controls(raw: DataFrame, mode: str = "strict") -> DataFrame:
    return clean(parse(raw, "gl_controls"), mode)
