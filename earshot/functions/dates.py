"""Date and time column expressions. The session zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.functions.numbers import round_to_long

# Output and input formats that must match existing tables.
MONTH_FORMAT = "yyyy-MM"
DATE_FORMAT = "yyyy-M-d"


def ns_to_timestamp(ns: Column) -> Column:
    """Nanoseconds since 1970 (bigint) to a timestamp, rounded to microseconds.

    The division is in floating point and then rounded, which can differ by one
    microsecond from an integer division.
    """
    return F.timestamp_micros(round_to_long(ns / 1000))


def ns_to_date(ns: Column) -> Column:
    return F.to_date(ns_to_timestamp(ns))


def epoch_ns(timestamp: Column) -> Column:
    """Timestamp to nanoseconds since 1970 (bigint), the raw tables' form."""
    return F.unix_micros(timestamp.cast("timestamp")) * 1000


def month_key(moment: Column) -> Column:
    """DATE or TIMESTAMP to 'YYYY-MM'."""
    return F.date_format(moment, MONTH_FORMAT)


def safe_date(text: Column) -> Column:
    """'Y-M-D' text to DATE; anything else, a bare year included, is NULL."""
    return F.try_to_date(text, DATE_FORMAT)
