"""Readers for the raw inputs, and table reads and writes."""

from earshot.sources.datasets import (
    merge_categories,
    read_music_charts,
    read_music_charts_historical,
    read_podcast_charts,
    read_podcast_reviews,
    read_podcast_shows,
)
from earshot.sources.files import input_profile, read_csv, read_json
from earshot.sources.tables import (
    RAW_LAYOUT,
    create_database,
    load_raw,
    publish,
    raw_form,
    raw_path,
    read_table,
    read_table_by_month,
    refresh_partitions,
    write_buckets,
    write_table,
)

__all__ = [
    "RAW_LAYOUT",
    "create_database",
    "input_profile",
    "load_raw",
    "merge_categories",
    "publish",
    "raw_form",
    "raw_path",
    "read_csv",
    "read_json",
    "read_music_charts",
    "read_music_charts_historical",
    "read_podcast_charts",
    "read_podcast_reviews",
    "read_podcast_shows",
    "read_table",
    "read_table_by_month",
    "refresh_partitions",
    "write_buckets",
    "write_table",
]
