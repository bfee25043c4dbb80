"""Row counts the stand-ins are known to give at sf0.01, and mart quirks."""

import pytest
from pyspark.sql import functions as F

from earshot.plans import marts, views
from workload.registry import QUERIES
from workload.standins import RAW

RAW_ROWS = {
    "music_charts": 60000,
    "music_charts_historical": 60000,
    "podcast_reviews": 15000,
    "podcast_shows": 2000,
    "podcast_charts": 10000,
}
MART_ROWS = {
    "music_trends": 525,
    "review_monthly": 36,
    "chart_monthly": 15,
    "category_summary_shows": 25,
    "category_summary_ratings": 25,
    "podcast_trends": 1175,
    "genre_monthly": 18,
    "genre_category_matrix": 300,
    "ecosystem_window_1": 42,
    "current_music": 21,
    "current_podcasts": 47,
    "ecosystem_window_2": 47,
    "ecosystem_timeline": 89,
}


@pytest.mark.parametrize("name, rows", RAW_ROWS.items())
def test_raw_rows(spark, sf_dir, name, rows):
    assert RAW[name](spark, sf_dir).count() == rows


@pytest.mark.parametrize("name, rows", MART_ROWS.items())
def test_mart_rows(spark, sf_dir, name, rows):
    assert QUERIES[name](spark, sf_dir).count() == rows


def test_timeline_quirks(spark, sf_dir):
    timeline = QUERIES["ecosystem_timeline"](spark, sf_dir).toPandas()
    assert (timeline["trend_month"].value_counts() == 2).sum() == 36
    ratio = timeline["podcast_to_music_ratio"].notna()
    assert ratio.sum() == 12
    assert set(timeline.loc[ratio, "podcast_data_source"]) == {"reviews"}
    assert timeline["trend_month"].is_monotonic_increasing
    assert len(timeline.columns) == 22


def test_column_counts(spark, sf_dir):
    widths = {"stg_music_charts": 25, "stg_music_charts_historical": 11, "stg_podcast_reviews": 8,
              "stg_podcast_shows": 8, "stg_podcast_charts": 17, "music_trends": 15, "podcast_trends": 14,
              "genre_category_matrix": 30}
    assert {n: len(QUERIES[n](spark, sf_dir).columns) for n in widths} == widths


def test_genre_buckets_overlap(spark):
    historical = spark.createDataFrame(
        [("2022-01", "t", "a", "us", 1, "K-Pop, trap"), ("2022-01", "t", "a", "us", 2, None)],
        "chart_month string, track_id string, artists string, country string, streams long, artist_genres string",
    )
    row = marts.genre_monthly(historical).first()
    assert (row.pop_entries, row.hiphop_entries, row.kpop_entries, row.rock_entries) == (1, 1, 1, 0)
    assert (row.total_chart_entries, row.unique_tracks, row.countries_active) == (2, 1, 1)


def test_current_music_sums_countries_and_averages_rounded_means(spark):
    trends = spark.createDataFrame(
        [("2024-01", None, 2, 1, 5, 10.0), ("2024-01", "US", 3, 1, 7, 10.1)],
        "trend_month string, country string, unique_tracks long, unique_artists long, "
        "total_chart_entries long, avg_popularity double",
    ).withColumns({c: F.lit(0.1) for c in ("avg_danceability", "avg_energy", "avg_speechiness", "avg_valence",
                                           "avg_acousticness", "explicit_ratio")})
    row = marts.current_music(trends).first()
    assert (row.music_chart_entries, row.countries_active, row.music_unique_tracks) == (12, 1, 5)
    assert row.music_avg_popularity == 10.1  # 10.05 rounded away from zero


def test_country_list_names_and_unknown_codes(spark):
    music = spark.createDataFrame([("US",), ("XX",), (None,), ("US",)], "country string")
    assert [tuple(r) for r in views.country_list(music).select("country", "display_name").collect()] == [
        ("US", "US – United States"), ("XX", "XX"),
    ]


def test_there_are_72_markets():
    assert len(views.COUNTRY_NAMES) == 72
    assert all(name.startswith(code + views.SEPARATOR) for code, name in views.COUNTRY_NAMES.items())


def test_polygon_is_closed(spark, sf_dir):
    points = QUERIES["country_profile_long"](spark, sf_dir).toPandas()
    assert list(points.columns) == ["country", "display_name", "position", "feature", "value"]
    for _, corner in points.groupby("country"):
        assert len(corner) == 7
        first, last = corner.iloc[0], corner.iloc[-1]
        assert first["feature"] == last["feature"] == "Danceability" and first["value"] == last["value"]


def test_genre_shares_skip_unknown_labels(spark):
    matrix = spark.createDataFrame(
        [("2022-01", "c1", 7, 0.5), ("2022-01", "c2", 7, 0.5), ("2022-02", "c1", None, 0.1)],
        "trend_month string, category string, review_count long, pop_pct double",
    )
    got = views.genre_share_vs_reviews(matrix, ["Pop", "Rock", "Polka"]).collect()
    assert [tuple(r) for r in got] == [("2022-01", "Pop", 50.0, 7)]
    with pytest.raises(ValueError, match="at least one genre"):
        views.genre_share_vs_reviews(matrix, ["Polka"])


def test_headline_of_empty_marts(spark, sf_dir):
    names = ("genre_monthly", "review_monthly", "chart_monthly", "music_trends", "category_summary_shows")
    tables = {n: QUERIES[n](spark, sf_dir) for n in names}
    empty = {n: df.limit(0) for n, df in tables.items()}
    assert [tuple(r) for r in views.headline_numbers(*empty.values()).collect()] == [(0, 0, None, None)]
    no_months = empty | {"category_summary_shows": tables["category_summary_shows"]}
    assert views.headline_numbers(*no_months.values()).first()["avg_podcast_rating"] is None


def test_views_are_the_same_from_the_mart(spark, sf_dir):
    """The tables the views read now hold what the marts repeat per month or category."""
    trends, matrix = QUERIES["podcast_trends"](spark, sf_dir), QUERIES["genre_category_matrix"](spark, sf_dir)
    for view, mart in (("top_categories_by_ratings", trends), ("top_categories_by_score", trends),
                       ("genre_share_vs_reviews", matrix)):
        own = [tuple(r) for r in getattr(views, view)(mart).collect()]
        round9 = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in own]
        assert round9 == [tuple(r) for r in QUERIES[view](spark, sf_dir).collect()]


def test_no_category_no_current_podcasts(spark, sf_dir):
    reviews, charts = QUERIES["review_monthly"](spark, sf_dir), QUERIES["chart_monthly"](spark, sf_dir)
    none = QUERIES["category_summary_shows"](spark, sf_dir).limit(0)
    assert marts.current_podcasts(reviews, charts, none).count() == 0
