"""DataFrame to DataFrame operators shared by the sources, models and views."""

from earshot.operators.aggregate import (
    Measure,
    aggregate_with_distincts,
    count_where,
    distinct_values,
    group_known,
    mean,
    one_row_of_totals,
    one_row_per_key,
    row_count,
    share_where,
    total,
    value_at_largest,
)
from earshot.operators.filters import (
    Window,
    in_window,
    keep_complete,
    parse_and_window,
    pick_date_column,
    rename_dots,
    window_report,
)
from earshot.operators.joins import (
    full_join_on_month,
    left_join_fanout,
    lookup_or_keep,
    pair_months_with,
)
from earshot.operators.order import with_place
from earshot.operators.quality import QualityError, enforce, quality_report
from earshot.operators.topk import top_ascending

__all__ = [
    "Measure",
    "QualityError",
    "Window",
    "aggregate_with_distincts",
    "count_where",
    "distinct_values",
    "enforce",
    "full_join_on_month",
    "group_known",
    "in_window",
    "keep_complete",
    "left_join_fanout",
    "lookup_or_keep",
    "mean",
    "one_row_of_totals",
    "one_row_per_key",
    "pair_months_with",
    "parse_and_window",
    "pick_date_column",
    "quality_report",
    "rename_dots",
    "row_count",
    "share_where",
    "top_ascending",
    "total",
    "value_at_largest",
    "window_report",
    "with_place",
]
