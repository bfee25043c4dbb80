"""Staged tables to monthly marts.

Each fact table is reduced once to a small monthly table (`review_monthly`,
`genre_monthly`, `chart_monthly`); the marts are built from those, so no mart
has to scan a fact table another one has already scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import contains_any, month_key, rounded_ratio
from earshot.operators.aggregate import (
    aggregate_with_distincts,
    count_where,
    mean,
    row_count,
    share_where,
    total,
    value_at_largest,
)
from earshot.operators.joins import MONTH, full_join_on_month, pair_months_with

MS_PER_MINUTE = 60_000
# Digits to which durations are added up; other values go to the library's default.
DURATION_DIGITS = 3

# A chart entry counts for a genre if its genre text holds one of
# the words. The words overlap on purpose ("pop" is in "k-pop").
GENRE_WORDS = {
    "pop": ["pop"],
    "hiphop": ["hip hop", "rap"],
    "rock": ["rock"],
    "latin": ["latin", "reggaeton"],
    "rnb": ["r&b", "soul"],
    "electronic": ["electronic", "edm", "house"],
    "country": ["country"],
    "indie": ["indie"],
    "kpop": ["k-pop", "korean"],
}

# Digits kept of each monthly mean in the music mart.
MUSIC_MEANS = {
    "popularity": 1,
    "danceability": 3,
    "energy": 3,
    "speechiness": 3,
    "acousticness": 3,
    "valence": 3,
    "tempo": 1,
    "instrumentalness": 3,
}

# Columns of the timeline that only one of its two windows can fill.
MUSIC_PROFILE = [
    "music_avg_popularity",
    "music_avg_danceability",
    "music_avg_energy",
    "music_avg_speechiness",
    "music_avg_valence",
    "music_avg_acousticness",
    "music_explicit_ratio",
]
REVIEW_COLUMNS = {
    "podcast_total_reviews": "bigint",
    "podcast_shows_reviewed": "bigint",
    "podcast_unique_reviewers": "bigint",
    "podcast_avg_rating": "double",
}
CHART_COLUMNS = {
    "podcast_categories_active": "bigint",
    "podcast_chart_entries": "bigint",
    "podcast_shows_charting": "bigint",
    "podcast_top_category": "string",
}
# The column that names the window of a row, and its two values.
SOURCE, REVIEWS, CHARTS = "podcast_data_source", "reviews", "charts"
# Shows and ratings a category needs.
MIN_SHOWS = 10
MIN_RATINGS = 1000


def _missing(columns: dict[str, str]) -> list:
    return [F.lit(None).cast(dtype).alias(name) for name, dtype in columns.items()]


# ---- music ---------------------------------------------------------------


def music_trends(charts: DataFrame) -> DataFrame:
    """Month x country: volume, popularity and sound profile."""
    # Grouping by the first day of the month is several times cheaper per row
    # than by formatted text; the text is made once per group.
    by_month = aggregate_with_distincts(
        charts,
        keys={"month_start": F.trunc("snapshot_date", "month"), "country": F.col("country")},
        measures=[
            row_count("total_chart_entries"),
            *[mean(c, digits, f"avg_{c}") for c, digits in MUSIC_MEANS.items()],
            share_where(F.col("is_explicit"), 3, "explicit_ratio"),
            mean("duration_ms", 1, "avg_duration_minutes", MS_PER_MINUTE, DURATION_DIGITS),
        ],
        distincts={"unique_artists": "artists", "unique_tracks": "spotify_id"},
    )
    return by_month.select(
        month_key(F.col("month_start")).alias(MONTH),
        "country",
        "unique_tracks",
        "unique_artists",
        "total_chart_entries",
        *[f"avg_{c}" for c in MUSIC_MEANS],
        "explicit_ratio",
        "avg_duration_minutes",
    )


def genre_monthly(historical: DataFrame) -> DataFrame:
    """Month: volume and entries per genre bucket of the historical charts."""
    return aggregate_with_distincts(
        historical,
        keys={MONTH: F.col("chart_month")},
        measures=[
            row_count("total_chart_entries"),
            mean("streams", 0, "avg_streams", input_digits=0),
            *[
                count_where(contains_any(F.col("artist_genres"), words), f"{genre}_entries")
                for genre, words in GENRE_WORDS.items()
            ],
        ],
        distincts={
            "countries_active": "country",
            "unique_artists": "artists",
            "unique_tracks": "track_id",
        },
    ).select(
        MONTH,
        "total_chart_entries",
        "unique_tracks",
        "unique_artists",
        "countries_active",
        "avg_streams",
        *[f"{genre}_entries" for genre in GENRE_WORDS],
    )


# ---- podcasts ------------------------------------------------------------


def review_monthly(reviews: DataFrame) -> DataFrame:
    """Month: review volume and ratings."""
    return aggregate_with_distincts(
        reviews,
        keys={MONTH: F.col("review_month")},
        measures=[
            row_count("review_count"),
            mean("rating", 2, "avg_rating", input_digits=0),
            count_where(F.col("rating") == 5, "five_star_count"),
            count_where(F.col("rating") == 1, "one_star_count"),
        ],
        distincts={"podcasts_reviewed": "podcast_id", "unique_reviewers": "author_id"},
    ).select(
        MONTH,
        "review_count",
        "podcasts_reviewed",
        "unique_reviewers",
        "avg_rating",
        "five_star_count",
        "one_star_count",
    )


def monthly_reviews(by_month: DataFrame) -> DataFrame:
    """The part of `review_monthly` shown next to genres."""
    return by_month.select(MONTH, "review_count", "podcasts_reviewed", "unique_reviewers", "avg_rating")


def chart_monthly(charts: DataFrame) -> DataFrame:
    """Month: podcast chart activity."""
    return aggregate_with_distincts(
        charts,
        keys={MONTH: F.col("chart_month")},
        measures=[
            row_count("chart_entries"),
            mean("duration_ms", 1, "avg_episode_duration_minutes", MS_PER_MINUTE, 0),
        ],
        distincts={"unique_shows_charting": "show_name"},
    ).select(MONTH, "chart_entries", "unique_shows_charting", "avg_episode_duration_minutes")


def category_totals(shows: DataFrame) -> DataFrame:
    """Category: shows, mean rating, total ratings. Both summaries filter this."""
    return aggregate_with_distincts(
        shows,
        keys={"category": F.col("category")},
        measures=[
            mean("average_rating", 2, "category_avg_rating"),
            total("ratings_count", "category_total_ratings"),
        ],
        distincts={"shows_in_category": "podcast_id"},
    ).select("category", "shows_in_category", "category_avg_rating", "category_total_ratings")


def category_summary_by_shows(totals: DataFrame) -> DataFrame:
    """Categories with enough shows."""
    return totals.filter(F.col("shows_in_category") >= MIN_SHOWS)


def category_summary_by_ratings(totals: DataFrame) -> DataFrame:
    """Categories with enough ratings."""
    return totals.filter(F.col("category_total_ratings") >= MIN_RATINGS).select(
        "category", "shows_in_category", "category_total_ratings"
    )


def podcast_trends(reviews: DataFrame, charts: DataFrame, totals: DataFrame) -> DataFrame:
    """Month x category, from `review_monthly`, `chart_monthly`, `category_totals`.

    Show ids of the reviews do not match those of the shows, so categories are
    static and stand next to every month.
    """
    months = full_join_on_month(reviews, charts)
    return pair_months_with(months, category_summary_by_shows(totals)).select(
        MONTH,
        "review_count",
        "podcasts_reviewed",
        "unique_reviewers",
        "avg_rating",
        "five_star_count",
        "one_star_count",
        F.col("chart_entries").alias("total_chart_entries"),
        "unique_shows_charting",
        "avg_episode_duration_minutes",
        "category",
        "shows_in_category",
        "category_avg_rating",
        "category_total_ratings",
    )


def genre_category_matrix(genres: DataFrame, reviews: DataFrame, totals: DataFrame) -> DataFrame:
    """Month x category for the months with both charts and reviews, from
    `genre_monthly`, `review_monthly`, `category_totals`."""
    months = genre_review_months(genres, reviews)
    categories = ["category", "shows_in_category", "category_total_ratings"]
    own = [c for c in months.columns if c != MONTH]
    return pair_months_with(months, category_summary_by_ratings(totals)).select(MONTH, *categories, *own)


def genre_review_months(genres: DataFrame, reviews: DataFrame) -> DataFrame:
    """Month: reviews, chart entries and genre shares, for the months with both."""
    return genres.join(monthly_reviews(reviews), MONTH, "inner").select(
        MONTH,
        "review_count",
        "podcasts_reviewed",
        "unique_reviewers",
        "avg_rating",
        "total_chart_entries",
        "unique_tracks",
        "unique_artists",
        "avg_streams",
        *[f"{genre}_entries" for genre in GENRE_WORDS],
        *[
            rounded_ratio(f"{genre}_entries", "total_chart_entries", 4).alias(f"{genre}_pct")
            for genre in GENRE_WORDS
        ],
    )


# ---- both: one timeline of two windows -------------------------------------


def historical_music(genres: DataFrame) -> DataFrame:
    """Window 1, music side, from `genre_monthly`. No audio features back then."""
    return genres.select(
        MONTH,
        F.col("total_chart_entries").alias("music_chart_entries"),
        "countries_active",
        F.col("unique_tracks").alias("music_unique_tracks"),
        F.col("unique_artists").alias("music_unique_artists"),
        *_missing(dict.fromkeys(MUSIC_PROFILE, "double")),
    )


def historical_podcasts(reviews: DataFrame) -> DataFrame:
    """Window 1, podcast side, from `review_monthly`."""
    return reviews.select(
        MONTH,
        F.col("review_count").alias("podcast_total_reviews"),
        F.col("podcasts_reviewed").alias("podcast_shows_reviewed"),
        F.col("unique_reviewers").alias("podcast_unique_reviewers"),
        F.col("avg_rating").alias("podcast_avg_rating"),
        *_missing(CHART_COLUMNS),
    )


def current_music(trends: DataFrame) -> DataFrame:
    """Window 2, music side, from `music_trends`.

    Tracks and artists are sums over countries, and the means are unweighted
    means of the already rounded country means.
    """
    digits = {f"avg_{c}": n for c, n in MUSIC_MEANS.items()} | {"explicit_ratio": 3}
    # A country stands once a month.
    known = count_where(F.col("country").isNotNull(), "countries_active")
    return aggregate_with_distincts(
        trends,
        keys={MONTH: F.col(MONTH)},
        measures=[
            total("total_chart_entries", "music_chart_entries"),
            known,
            total("unique_tracks", "music_unique_tracks"),
            total("unique_artists", "music_unique_artists"),
            *[mean(c, digits[c], f"music_{c}") for c in (name.removeprefix("music_") for name in MUSIC_PROFILE)],
        ],
    )


def active_categories(totals: DataFrame) -> DataFrame:
    """One row: categories with enough shows, and the one with the most ratings; no row without a category."""
    return category_summary_by_shows(totals).agg(
        F.count("category").alias("podcast_categories_active"),
        value_at_largest("category", "category_total_ratings").alias("podcast_top_category"),
        F.count(F.lit(1)).alias("__rows"),
    ).filter("__rows > 0").drop("__rows")


def current_podcasts(reviews: DataFrame, charts: DataFrame, totals: DataFrame) -> DataFrame:
    """Window 2, podcast side, from the tables `podcast_trends` is made of.

    Categories do not depend on the month: they are reduced to one row, which
    stands next to every month; no month without a category.
    """
    months = full_join_on_month(reviews, charts).select(
        MONTH,
        F.col("chart_entries").alias("podcast_chart_entries"),
        F.col("unique_shows_charting").alias("podcast_shows_charting"),
    )
    paired = pair_months_with(months, active_categories(totals), slots=1)
    return paired.select(MONTH, *_missing(REVIEW_COLUMNS), *CHART_COLUMNS)


def _timeline_window(music: DataFrame, podcasts: DataFrame, source: str) -> DataFrame:
    return full_join_on_month(music, podcasts).select(
        MONTH,
        "music_chart_entries",
        "countries_active",
        "music_unique_tracks",
        "music_unique_artists",
        *MUSIC_PROFILE,
        *REVIEW_COLUMNS,
        *CHART_COLUMNS,
        F.lit(source).alias(SOURCE),
    )


def ecosystem_window_1(genres: DataFrame, reviews: DataFrame) -> DataFrame:
    """Historical charts next to reviews, by month."""
    return _timeline_window(historical_music(genres), historical_podcasts(reviews), REVIEWS)


def ecosystem_window_2(music: DataFrame, podcasts: DataFrame) -> DataFrame:
    """Current music charts next to podcast charts, by month, from `music_trends` and `current_podcasts`."""
    return _timeline_window(current_music(music), podcasts, CHARTS)


def both_podcast_windows(reviews: DataFrame, charts: DataFrame, totals: DataFrame) -> DataFrame:
    """`historical_podcasts` and `current_podcasts` stacked, with their source; each table is read once.

    Reviews and charts are joined by month once; a month then gives a row for each
    window it stands in.
    """
    marked = reviews.withColumn("__reviewed", F.lit(True))
    months = full_join_on_month(marked, charts)
    windows = months.withColumn(SOURCE, F.explode(F.array(F.lit(REVIEWS), F.lit(CHARTS))))
    # A key made from the row keeps this an equality join; a constant would make it a nested loop.
    active = active_categories(totals).withColumn(SOURCE, F.when(F.col("podcast_categories_active") >= 0, CHARTS))
    rows = windows.join(active, SOURCE, "left").filter(
        F.when(F.col(SOURCE) == REVIEWS, F.col("__reviewed")).otherwise(F.col("podcast_categories_active").isNotNull())
    )
    reviewed = {
        "podcast_total_reviews": "review_count",
        "podcast_shows_reviewed": "podcasts_reviewed",
        "podcast_unique_reviewers": "unique_reviewers",
        "podcast_avg_rating": "avg_rating",
    }
    charted = {
        "podcast_categories_active": "podcast_categories_active",
        "podcast_chart_entries": "chart_entries",
        "podcast_shows_charting": "unique_shows_charting",
        "podcast_top_category": "podcast_top_category",
    }
    return rows.select(
        MONTH, SOURCE,
        *[F.when(F.col(SOURCE) == REVIEWS, F.col(c)).alias(name) for name, c in reviewed.items()],
        *[F.when(F.col(SOURCE) == CHARTS, F.col(c)).alias(name) for name, c in charted.items()],
    )


def ecosystem_timeline(
    genres: DataFrame, reviews: DataFrame, music: DataFrame, charts: DataFrame, totals: DataFrame
) -> DataFrame:
    """Both windows stacked, from `genre_monthly`, `review_monthly`, `music_trends`,
    `chart_monthly` and `category_totals`, each read once. A month may stand in both
    windows; both rows are kept."""
    both_music = historical_music(genres).withColumn(SOURCE, F.lit(REVIEWS)).unionByName(
        current_music(music).withColumn(SOURCE, F.lit(CHARTS)))
    windows = both_music.join(both_podcast_windows(reviews, charts, totals), [MONTH, SOURCE], "full_outer")
    ratio = rounded_ratio("podcast_total_reviews", "music_chart_entries", 4)
    return windows.select(
        MONTH, "music_chart_entries", "countries_active", "music_unique_tracks", "music_unique_artists",
        *MUSIC_PROFILE, *REVIEW_COLUMNS, *CHART_COLUMNS, SOURCE, ratio.alias("podcast_to_music_ratio"),
    )


# Row order of each mart. Tables store none, so it is applied on
# read; a leading '-' is descending.
SORT_KEYS = {
    "music_trends": ["trend_month", "country"],
    "podcast_trends": ["trend_month", "-category_total_ratings"],
    "genre_category_matrix": ["trend_month", "-category_total_ratings"],
    "ecosystem_timeline": ["trend_month"],
}


def mart_order(mart: str) -> list[Column]:
    """What a mart is sorted by (NULLs first ascending, last descending)."""
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in SORT_KEYS[mart]]


def in_mart_order(df: DataFrame, mart: str) -> DataFrame:
    """The mart sorted as published."""
    return df.orderBy(*mart_order(mart))
