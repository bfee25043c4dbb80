"""Marts to the small tables behind the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import before_separator, percent
from earshot.operators.aggregate import distinct_values, group_known, one_row_of_totals, one_row_per_key
from earshot.operators.joins import MONTH, lookup_or_keep
from earshot.operators.topk import top_ascending
from earshot.plans.marts import MIN_RATINGS

# Display names of the markets, their separator, the countries
# shown first, and the labels of features and genres.
SEPARATOR = " – "
COUNTRY_NAMES = {
    "AE": "AE – United Arab Emirates",
    "AR": "AR – Argentina",
    "AT": "AT – Austria",
    "AU": "AU – Australia",
    "BE": "BE – Belgium",
    "BG": "BG – Bulgaria",
    "BO": "BO – Bolivia",
    "BR": "BR – Brazil",
    "BY": "BY – Belarus",
    "CA": "CA – Canada",
    "CH": "CH – Switzerland",
    "CL": "CL – Chile",
    "CO": "CO – Colombia",
    "CR": "CR – Costa Rica",
    "CZ": "CZ – Czech Republic",
    "DE": "DE – Germany",
    "DK": "DK – Denmark",
    "DO": "DO – Dominican Republic",
    "EC": "EC – Ecuador",
    "EE": "EE – Estonia",
    "EG": "EG – Egypt",
    "ES": "ES – Spain",
    "FI": "FI – Finland",
    "FR": "FR – France",
    "GB": "GB – United Kingdom",
    "GR": "GR – Greece",
    "GT": "GT – Guatemala",
    "HK": "HK – Hong Kong",
    "HN": "HN – Honduras",
    "HU": "HU – Hungary",
    "ID": "ID – Indonesia",
    "IE": "IE – Ireland",
    "IL": "IL – Israel",
    "IN": "IN – India",
    "IS": "IS – Iceland",
    "IT": "IT – Italy",
    "JP": "JP – Japan",
    "KR": "KR – South Korea",
    "KZ": "KZ – Kazakhstan",
    "LT": "LT – Lithuania",
    "LU": "LU – Luxembourg",
    "LV": "LV – Latvia",
    "MA": "MA – Morocco",
    "MX": "MX – Mexico",
    "MY": "MY – Malaysia",
    "NG": "NG – Nigeria",
    "NI": "NI – Nicaragua",
    "NL": "NL – Netherlands",
    "NO": "NO – Norway",
    "NZ": "NZ – New Zealand",
    "PA": "PA – Panama",
    "PE": "PE – Peru",
    "PH": "PH – Philippines",
    "PK": "PK – Pakistan",
    "PL": "PL – Poland",
    "PT": "PT – Portugal",
    "PY": "PY – Paraguay",
    "RO": "RO – Romania",
    "SA": "SA – Saudi Arabia",
    "SE": "SE – Sweden",
    "SG": "SG – Singapore",
    "SK": "SK – Slovakia",
    "SV": "SV – El Salvador",
    "TH": "TH – Thailand",
    "TR": "TR – Turkey",
    "TW": "TW – Taiwan",
    "UA": "UA – Ukraine",
    "US": "US – United States",
    "UY": "UY – Uruguay",
    "VE": "VE – Venezuela",
    "VN": "VN – Vietnam",
    "ZA": "ZA – South Africa",
}
DEFAULT_COUNTRIES = ["US", "GB", "JP", "BR"]
FEATURE_LABELS = {
    "avg_danceability": "Danceability",
    "avg_energy": "Energy",
    "avg_speechiness": "Speechiness",
    "avg_acousticness": "Acousticness",
    "avg_valence": "Valence",
    "avg_instrumentalness": "Instrumentalness",
}
GENRE_LABELS = {
    "Pop": "pop_pct",
    "Hip-Hop/Rap": "hiphop_pct",
    "Rock": "rock_pct",
    "Latin": "latin_pct",
    "R&B/Soul": "rnb_pct",
    "Electronic": "electronic_pct",
    "Country": "country_pct",
    "Indie": "indie_pct",
    "K-Pop": "kpop_pct",
}
DEFAULT_GENRES = ["Pop", "Hip-Hop/Rap", "Latin", "Rock"]


def headline_numbers(
    genres: DataFrame, reviews: DataFrame, charts: DataFrame, music: DataFrame, categories: DataFrame
) -> DataFrame:
    """One row: chart entries, reviews, mean popularity, mean category rating.

    From `genre_monthly`, `review_monthly`, `chart_monthly`, `music_trends` and the
    categories of `podcast_trends`: the timeline holds the entries of both music
    tables and the reviews of one, and `podcast_trends` repeats every category once
    a month, which leaves the mean as it is (and empty where there is no month).
    """
    entries = "total_chart_entries"
    months = F.count(F.lit(1))
    totals = one_row_of_totals(
        [
            (genres, [F.sum(entries).alias("old_entries")]),
            (music, [F.sum(entries).alias("new_entries"), F.avg("avg_popularity").alias("avg_music_popularity")]),
            (reviews, [F.sum("review_count").alias("total_podcast_reviews"), months.alias("review_months")]),
            (charts, [months.alias("chart_months")]),
            (categories, [F.avg("category_avg_rating").alias("avg_category_rating")]),
        ]
    )
    zero = F.lit(0)  # the sum of nothing is 0
    return totals.select(
        (F.coalesce("old_entries", zero) + F.coalesce("new_entries", zero)).alias("total_music_entries"),
        F.coalesce("total_podcast_reviews", zero).alias("total_podcast_reviews"),
        "avg_music_popularity",
        F.when(F.col("review_months") + F.col("chart_months") > 0, F.col("avg_category_rating")).alias(
            "avg_podcast_rating"
        ),
    )


def top_categories_by_ratings(categories: DataFrame, n: int = 15) -> DataFrame:
    """From the categories of `podcast_trends`, or from `podcast_trends` itself, which
    holds each of them once a month (and none where there is no month)."""
    totals = group_known(
        categories, "category", F.max("category_total_ratings").alias("category_total_ratings")
    )
    return top_ascending(totals, "category_total_ratings", tie="category", n=n)


def speechiness_by_month(music: DataFrame) -> DataFrame:
    return group_known(music, MONTH, F.avg("avg_speechiness").alias("avg_speechiness")).orderBy(MONTH)


def top_categories_by_score(categories: DataFrame, n: int = 15) -> DataFrame:
    """Best rated categories among those with enough ratings; input as above."""
    scores = group_known(
        categories,
        "category",
        F.avg("category_avg_rating").alias("category_avg_rating"),
        F.max("category_total_ratings").alias("category_total_ratings"),
    ).filter(F.col("category_total_ratings") >= MIN_RATINGS)
    return top_ascending(scores, "category_avg_rating", tie="category", n=n)


def with_display_name(df: DataFrame) -> DataFrame:
    """Add `display_name`; an unknown code is its own name."""
    return lookup_or_keep(df, COUNTRY_NAMES, "country", "display_name")


def country_list(music: DataFrame) -> DataFrame:
    """Countries to pick from, with display names, in code order."""
    return with_display_name(distinct_values(music, "country")).orderBy("country")


def label_codes(labels: DataFrame, column: str) -> DataFrame:
    """Display labels back to codes: country."""
    return labels.withColumn("country", before_separator(F.col(column), SEPARATOR))


def country_profile(music: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES) -> DataFrame:
    """Mean sound profile of the chosen countries, given as codes or labels."""
    codes = [c.split(SEPARATOR)[0] for c in countries]
    chosen = music.filter(F.col("country").isin(codes))
    return group_known(chosen, "country", *[F.avg(c).alias(c) for c in FEATURE_LABELS])


def country_profile_long(music: DataFrame, countries: Sequence[str] = DEFAULT_COUNTRIES) -> DataFrame:
    """The profile as points of a closed polygon: country, display_name,
    position, feature, value. The first feature is repeated at the end."""
    corners = [*FEATURE_LABELS.items(), next(iter(FEATURE_LABELS.items()))]
    points = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(label).alias("feature"),
                F.col(column).alias("value"),
            )
            for i, (column, label) in enumerate(corners)
        ]
    )
    profile = with_display_name(country_profile(music, countries))
    return profile.select("country", "display_name", F.inline(points)).orderBy("country", "position")


def genre_share_vs_reviews(months: DataFrame, genres: Sequence[str] = DEFAULT_GENRES) -> DataFrame:
    """Month x chosen genre: share of chart entries in percent, and reviews.

    `months` is `genre_review_months`, or `genre_category_matrix`, which repeats its
    rows per category: one row per month is kept.
    Unknown genres, and ones the table has no column for, are left out.
    """
    columns = {g: GENRE_LABELS[g] for g in genres if GENRE_LABELS.get(g) in months.columns}
    if not columns:
        raise ValueError("choose at least one genre")
    overlap = months.filter(F.col("review_count").isNotNull())
    single = one_row_per_key(overlap, MONTH, ["review_count", *columns.values()])
    shares = single.select(
        MONTH, "review_count", *[percent(column).alias(label) for label, column in columns.items()]
    )
    long = shares.unpivot([MONTH, "review_count"], list(columns), "genre", "share_percent")
    return long.select(MONTH, "genre", "share_percent", "review_count").orderBy(MONTH, "genre")
