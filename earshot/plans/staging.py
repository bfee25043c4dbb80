"""Raw tables to clean, typed tables. Every model is one narrow pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import (
    month_key,
    ns_to_date,
    ns_to_timestamp,
    round_to_long,
    safe_date,
    safe_long,
)
from earshot.operators.filters import keep_complete
from earshot.operators.quality import Checks


def music_charts(raw: DataFrame) -> DataFrame:
    """Track x country x day, with audio features."""
    return keep_complete(raw, "spotify_id", "snapshot_date").select(
        "spotify_id",
        F.col("name").alias("track_name"),
        "artists",
        "album_name",
        "daily_rank",
        "daily_movement",
        "weekly_movement",
        "country",
        ns_to_date(F.col("snapshot_date")).alias("snapshot_date"),
        "popularity",
        "is_explicit",
        "duration_ms",
        safe_date(F.col("album_release_date")).alias("album_release_date"),
        "danceability",
        "energy",
        "speechiness",
        "acousticness",
        "instrumentalness",
        "liveness",
        "valence",
        "tempo",
        "loudness",
        "key",
        "mode",
        "time_signature",
    )


def music_charts_historical(raw: DataFrame) -> DataFrame:
    """Track x country x day, with genres."""
    day = ns_to_date(F.col("date"))
    return keep_complete(raw, "date", "position", "name").select(
        "track_id",
        F.col("name").alias("track_name"),
        "artists",
        "artist_genres",
        round_to_long(F.col("position")).alias("position"),
        "country",
        day.alias("chart_date"),
        round_to_long(F.col("streams")).alias("streams"),
        round_to_long(F.col("duration")).alias("duration_ms"),
        F.col("explicit").alias("is_explicit"),
        month_key(day).alias("chart_month"),
    )


def podcast_reviews(raw: DataFrame) -> DataFrame:
    """One row per review with a valid rating."""
    moment = ns_to_timestamp(F.col("created_at"))
    complete = keep_complete(raw, "podcast_id", "created_at", "rating")
    return complete.filter(F.col("rating").between(1, 5)).select(
        "podcast_id",
        "author_id",
        "rating",
        F.col("title").alias("review_title"),
        F.col("content").alias("review_content"),
        moment.alias("created_at"),
        F.to_date(moment).alias("review_date"),
        month_key(moment).alias("review_month"),
    )


def podcast_shows(raw: DataFrame) -> DataFrame:
    """Show x category."""
    return keep_complete(raw, "podcast_id", "category").select(
        "podcast_id",
        F.col("itunes_id_x").alias("itunes_id"),
        F.col("title").alias("show_title"),
        F.col("author").alias("show_author"),
        F.col("description").alias("show_description"),
        "category",
        "average_rating",
        safe_long(F.col("ratings_count")).alias("ratings_count"),
    )


def podcast_charts(raw: DataFrame) -> DataFrame:
    """Episode x region x day."""
    day = ns_to_date(F.col("date"))
    return keep_complete(raw, "date", "rank").select(
        day.alias("chart_date"),
        "rank",
        "region",
        F.col("chartRankMove").alias("chart_rank_move"),
        F.col("episodeUri").alias("episode_uri"),
        F.col("showUri").alias("show_uri"),
        F.col("episodeName").alias("episode_name"),
        "show_name",
        "show_publisher",
        "show_description",
        "show_media_type",
        round_to_long(F.col("show_total_episodes")).alias("show_total_episodes"),
        round_to_long(F.col("duration_ms")).alias("duration_ms"),
        F.col("explicit").alias("is_explicit"),
        "languages",
        safe_date(F.col("release_date")).alias("release_date"),
        month_key(day).alias("chart_month"),
    )


@dataclass(frozen=True)
class StagedTable:
    """A staged model, the checks on its table, and the table's layout."""

    build: Callable[[DataFrame], DataFrame]
    checks: Checks
    partition_by: tuple[str, ...] = field(default=())
    cluster_by: tuple[str, ...] = field(default=())


STAGED = {
    "music_charts": StagedTable(
        music_charts,
        {"spotify_id": ["not_null"], "snapshot_date": ["not_null"], "daily_rank": ["positive"]},
        partition_by=("snapshot_date",),
        cluster_by=("country",),
    ),
    "music_charts_historical": StagedTable(
        music_charts_historical,
        {"track_id": ["not_null"], "chart_date": ["not_null"], "position": ["positive"]},
    ),
    "podcast_reviews": StagedTable(
        podcast_reviews,
        {"podcast_id": ["not_null"], "rating": ["not_null", "positive"], "created_at": ["not_null"]},
    ),
    "podcast_shows": StagedTable(
        podcast_shows,
        {"podcast_id": ["not_null"], "category": ["not_null"]},
    ),
    "podcast_charts": StagedTable(
        podcast_charts,
        {"chart_date": ["not_null"], "rank": ["positive"]},
    ),
}
