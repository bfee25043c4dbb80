"""Column expressions. Everything here maps a Column to a Column on the JVM."""

from earshot.functions.dates import (
    epoch_ns,
    month_key,
    ns_to_date,
    ns_to_timestamp,
    safe_date,
)
from earshot.functions.numbers import (
    percent,
    round_to_long,
    rounded_quotient,
    rounded_ratio,
    safe_long,
    scaled_long,
)
from earshot.functions.text import (
    NULL_WORDS,
    before_separator,
    contains_any,
    null_words_to_null,
)

__all__ = [
    "NULL_WORDS",
    "before_separator",
    "contains_any",
    "epoch_ns",
    "month_key",
    "ns_to_date",
    "ns_to_timestamp",
    "null_words_to_null",
    "percent",
    "round_to_long",
    "rounded_quotient",
    "rounded_ratio",
    "safe_date",
    "safe_long",
    "scaled_long",
]
