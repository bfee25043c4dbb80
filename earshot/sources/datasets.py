"""The five raw inputs: file format, column types, date window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot.operators.filters import FIRST_VALUE, Window, parse_and_window, pick_date_column, rename_dots
from earshot.operators.joins import left_join_fanout
from earshot.sources.files import csv_head, is_json_array, json_fields, read_csv, read_json

# Column names and types of the inputs. Dates stay text here and
# are parsed by the window step.
MUSIC_CHARTS = {
    "spotify_id": "string",
    "name": "string",
    "artists": "string",
    "album_name": "string",
    "daily_rank": "bigint",
    "daily_movement": "bigint",
    "weekly_movement": "bigint",
    "country": "string",
    "snapshot_date": "string",
    "popularity": "bigint",
    "is_explicit": "boolean",
    "duration_ms": "bigint",
    "album_release_date": "string",
    "danceability": "double",
    "energy": "double",
    "speechiness": "double",
    "acousticness": "double",
    "instrumentalness": "double",
    "liveness": "double",
    "valence": "double",
    "tempo": "double",
    "loudness": "double",
    "key": "bigint",
    "mode": "bigint",
    "time_signature": "bigint",
}
MUSIC_CHARTS_HISTORICAL = {
    "track_id": "string",
    "name": "string",
    "artists": "string",
    "artist_genres": "string",
    "country": "string",
    "date": "string",
    "position": "double",
    "streams": "double",
    "duration": "double",
    "explicit": "boolean",
}
SHOWS = {
    "podcast_id": "string",
    "itunes_id": "bigint",
    "title": "string",
    "author": "string",
    "description": "string",
    "average_rating": "double",
    "ratings_count": "string",
}
CATEGORIES = {"podcast_id": "string", "itunes_id": "bigint", "category": "string"}
REVIEWS = {
    "podcast_id": "string",
    "author_id": "string",
    "title": "string",
    "content": "string",
    "rating": "bigint",
    "created_at": "string",
}
PODCAST_CHARTS = {
    "rank": "bigint",
    "show.total_episodes": "double",
    "duration_ms": "double",
    "explicit": "boolean",
}


def head_for(spark: SparkSession, folder: str, layouts: Sequence[str] | str | None) -> DataFrame | None:
    """The beginning of the first file, where its first value is asked for."""
    return csv_head(spark, folder) if layouts == FIRST_VALUE else None


def observed(df: DataFrame, observation: Observation | None) -> DataFrame:
    """Count the rows of an input without a date window as they pass."""
    return df.observe(observation, F.count(F.lit(1)).alias("total_rows")) if observation else df


def read_music_charts(
    spark: SparkSession,
    folder: str,
    window: Window = Window(),
    layouts: Sequence[str] | str | None = None,
    files: str = "all",
    observation: Observation | None = None,
) -> DataFrame:
    """Current music charts, inside the window by snapshot date."""
    df = read_csv(spark, folder, MUSIC_CHARTS, "music charts", files)
    return parse_and_window(df, "snapshot_date", window, layouts, head_for(spark, folder, layouts), observation)


def read_music_charts_historical(
    spark: SparkSession,
    folder: str,
    window: Window = Window(),
    layouts: Sequence[str] | str | None = None,
    files: str = "all",
    observation: Observation | None = None,
) -> DataFrame:
    """Historical music charts, inside the window by chart date."""
    df = read_csv(spark, folder, MUSIC_CHARTS_HISTORICAL, "historical music charts", files)
    return parse_and_window(df, "date", window, layouts, head_for(spark, folder, layouts), observation)


def read_podcast_charts(
    spark: SparkSession,
    folder: str,
    window: Window = Window(),
    layouts: Sequence[str] | str | None = None,
    files: str = "all",
    observation: Observation | None = None,
) -> DataFrame:
    """Podcast charts with dots in names replaced. The date column is looked up
    among the known names; without one every row is kept."""
    df = rename_dots(read_csv(spark, folder, PODCAST_CHARTS, "podcast charts", files))
    column = pick_date_column(df.columns)
    if column is None:
        return observed(df, observation)
    head = head_for(spark, folder, layouts)
    return parse_and_window(df, column, window, layouts, rename_dots(head) if head else None, observation)


KEY = "podcast_id"


def merge_categories(shows: DataFrame, categories: DataFrame | None) -> DataFrame:
    """Shows with one row per category; unchanged if there is nothing to join."""
    if categories is None or KEY not in categories.columns or KEY not in shows.columns:
        return shows
    return left_join_fanout(shows, categories, KEY)


def read_podcast_shows(spark: SparkSession, folder: str, observation: Observation | None = None) -> DataFrame:
    """Shows, joined with their categories if the folder has that file and the
    objects of both files have the key."""
    path, more = f"{folder}/podcasts.json", f"{folder}/categories.json"
    own = json_fields(spark, path, "podcast shows")
    shows = observed(read_json(spark, path, SHOWS, "podcast shows", own), observation)
    try:
        found = json_fields(spark, more, "categories")
    except FileNotFoundError:
        return shows
    if KEY not in found or KEY not in own:
        return shows
    return merge_categories(shows, read_json(spark, more, CATEGORIES, "categories", found))


def read_podcast_reviews(
    spark: SparkSession,
    folder: str,
    window: Window = Window(),
    layouts: Sequence[str] | str | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Reviews inside the window by creation time.

    FIRST_VALUE is refused for an array, whose objects come in no order.
    """
    path = f"{folder}/reviews.json"
    df = read_json(spark, path, REVIEWS, "podcast reviews")
    if layouts == FIRST_VALUE and is_json_array(spark, path):
        raise ValueError("podcast reviews: an array has no first row, give the layouts")
    return parse_and_window(df, "created_at", window, layouts, observation=observation)
