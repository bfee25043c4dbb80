"""Text column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words a CSV field is read as missing for (the pandas defaults).
NULL_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def null_words_to_null(text: Column) -> Column:
    """NULL where the whole field is one of NULL_WORDS."""
    return F.when(~text.isin(*NULL_WORDS), text)


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """True where the lower-cased text holds any needle; NULL text gives NULL."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(n) for n in needles])


def before_separator(text: Column, separator: str) -> Column:
    """The part before the first separator; the whole text if there is none."""
    return F.substring_index(text, separator, 1)
