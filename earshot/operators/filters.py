"""Row filters and the date handling of the readers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Date column names tried in this order, and the default window.
DATE_COLUMNS = ("snapshot_date", "date", "rank_date", "created_at")
START_DATE = "2022-01-01"
END_DATE = "2025-12-31"

# Text layouts recognised for a date column. The last field of each is the part
# of the layout that carries a zone offset, if any.
DATE_LAYOUTS = (
    "yyyy-M-d",
    "yyyy-M-d H:mm",
    "yyyy-M-d H:mm:ss",
    "yyyy-M-d H:mm:ss.SSSSSS",
    "yyyy-M-d'T'H:mm:ss",
    "yyyy-M-d'T'H:mm:ss.SSSSSS",
    "yyyy-M-d H:mm:ssXXX",
    "yyyy-M-d'T'H:mm:ssXXX",
    "yyyy-M-d'T'H:mm:ss.SSSSSSXXX",
    "yyyy/M/d",
    "M/d/yyyy",
    "d/M/yyyy",
)


@dataclass(frozen=True)
class Window:
    """Both ends are midnights and both are kept: 10:00 on the last day is out."""

    start: str = START_DATE
    end: str = END_DATE


def keep_complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of the columns is NULL.

    Written as separate conditions, which reach the Parquet scan; `na.drop` is
    one opaque expression that does not.
    """
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def rename_dots(df: DataFrame) -> DataFrame:
    """Column names with '.' replaced by '_'."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def pick_date_column(columns: Sequence[str]) -> str | None:
    """The first known date column name present, or None."""
    return next((c for c in DATE_COLUMNS if c in columns), None)


def in_window(moment: Column, window: Window, offset: str = "+00:00", zoned: bool = True) -> Column:
    """True inside the window, whose ends are midnights at the given offset.

    The ends are constants of the column's own type, so on a stored column the
    filter reaches the Parquet scan. `zoned` is False for a timestamp without
    time zone.
    """
    if zoned:
        ends = [F.lit(f"{d}T00:00:00{offset}").cast("timestamp") for d in (window.start, window.end)]
    else:
        ends = [F.lit(d).cast("timestamp_ntz") for d in (window.start, window.end)]
    return moment.between(*ends)


def detect_layout(df: DataFrame, column: str, layouts: Sequence[str] = DATE_LAYOUTS) -> tuple[str | None, str]:
    """(layout, offset) of the first non-null value of a text date column. This reads the head of the first input split, not the data.
    """
    text = F.col(column)
    first = (
        df.filter(text.isNotNull())
        .select(
            F.regexp_extract(text, r"([+-]\d\d:\d\d)$", 1).alias("offset"),
            *[F.try_to_timestamp(text, F.lit(p)).isNotNull().alias(str(i)) for i, p in enumerate(layouts)],
        )
        .first()
    )
    if first is None:
        return None, "+00:00"
    layout = next((p for i, p in enumerate(layouts) if first[str(i)]), None)
    return layout, first["offset"] or "+00:00"


def parse_moment(text: Column, layouts: Sequence[str]) -> Column:
    """Text to timestamp by the first layout that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in layouts])


# Instead of layouts: the layout of the first value is used for all of a column.
FIRST_VALUE = "first value"


def offset_of(text: Column) -> Column:
    """Seconds of the zone offset at the end of a text, 0 without one."""
    sign, hours, minutes = (F.regexp_extract(text, r"([+-])(\d\d):(\d\d)$", i) for i in (1, 2, 3))
    seconds = (hours.try_cast("int") * 60 + minutes.try_cast("int")) * 60
    return F.coalesce(F.when(sign == "-", -seconds).otherwise(seconds), F.lit(0))


def parse_and_window(
    df: DataFrame,
    column: str,
    window: Window,
    layouts: Sequence[str] | str | None = None,
    head: DataFrame | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Parse a text date column, drop rows without a date, keep the window.

    `layouts` are tried in order, by default all of DATE_LAYOUTS (where a text fits
    both, the month comes before the day). The window's ends are midnights at the
    offset of each text. With FIRST_VALUE the first value decides layout and offset
    for all, and rows in another layout are dropped; `head` is a cheaper frame to
    find that value in, for a `df` whose first row would need all of the input.

    `observation` gets total_rows, dated_rows and kept_rows when the result is
    computed, so that what is dropped is known without another pass.
    """
    text = F.col(column)
    if layouts == FIRST_VALUE:
        layout, offset = detect_layout(head or df, column)
        dated = df.withColumn(column, parse_moment(text, [layout] if layout else DATE_LAYOUTS))
        inside = in_window(text, window, offset)
    else:
        local = "__local"
        moment = parse_moment(text, layouts or DATE_LAYOUTS)
        dated = df.withColumns({local: moment + F.make_dt_interval(secs=offset_of(text)), column: moment})
        inside = in_window(F.col(local), window)
    if observation:
        dated = dated.observe(
            observation,
            F.count(F.lit(1)).alias("total_rows"),
            F.count(column).alias("dated_rows"),
            F.count_if(inside).alias("kept_rows"),
        )
    return keep_complete(dated, column).filter(inside).select(*[F.col(f"`{c}`") for c in df.columns])


def window_report(df: DataFrame, column: str, window: Window) -> DataFrame:
    """Dated rows, rows kept by the window and rows dropped by it, in one pass."""
    dated = F.count(column)
    kept = F.count_if(in_window(F.col(column), window))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        dated.alias("dated_rows"),
        kept.alias("kept_rows"),
        (dated - kept).alias("dropped_rows"),
    )
