"""Parsing of text into typed values; what cannot be parsed becomes NULL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from plumbline.functions.text import strip

# Accepted date layouts, year first with either separator, or day first.
YEAR_FIRST = r"^(?!0000)\d{4}(-\d{1,2}-|/\d{1,2}/)\d{1,2}$"
DAY_FIRST = r"^(\d{1,2})-(\d{1,2})-((?!0000)\d{4})$"

MONEY = "decimal(18,2)"


def parse_date(c: Column) -> Column:
    """Date in any accepted layout.

    The layout is told by its shape and the text put into ISO order, which the cast reads fast; trying
    formats in turn would raise and catch an error per row and format.
    """
    text = strip(c)
    iso = F.when(text.rlike(YEAR_FIRST), F.replace(text, F.lit("/"), F.lit("-"))).when(
        text.rlike(DAY_FIRST), F.regexp_replace(text, DAY_FIRST, "$3-$2-$1")
    )
    return iso.try_cast("date")


def parse_amount(c: Column) -> Column:
    """Thousands separators dropped, then rounded half-even to cents (C4)."""
    exact = F.replace(strip(c), F.lit(","), F.lit("")).try_cast("decimal(38,20)")
    return F.bround(exact, 2).try_cast(MONEY)


def parse_integer(c: Column) -> Column:
    """Whole number."""
    return strip(c).try_cast("bigint")


def date_key(d: Column) -> Column:
    """YYYYMMDD as INT."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_start(d: Column) -> Column:
    """First day of the month (C14)."""
    return F.trunc(d, "MM")


def utc_stamp(moment: datetime) -> Column:
    """A moment as a timestamp; one without a zone is in UTC, whatever zone the session has."""
    return F.lit(moment.isoformat() + ("" if moment.tzinfo else "+00:00")).cast("timestamp")
