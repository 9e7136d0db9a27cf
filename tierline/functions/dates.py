"""Date repair and date keys. Nothing here raises under ANSI mode: bad input becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted input patterns, first match wins, so an ambiguous value is read day first.
DATE_PATTERNS = (
    "yyyy-MM-dd",
    "dd-MMM-yy",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
    "dd/MM/yy",
    "MM/dd/yy",
    "yyyy/MM/dd",
)


def iso_date_text(value: Column) -> Column:
    """``yyyyMMdd`` becomes ``yyyy-MM-dd``; any other text, blank or NULL is returned unchanged."""
    dashed = F.concat_ws("-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2))
    return F.when(value.rlike(r"^\d{8}$"), dashed).otherwise(value)


def parse_date(value: Column) -> Column:
    text = F.trim(value)
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in DATE_PATTERNS])


def date_key(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def year_month(value: Column) -> Column:
    return F.date_format(F.trunc(value, "month"), "yyyy-MM")
