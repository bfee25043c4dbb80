"""SQL twins of the registered queries, for DuckDB over the same tables.

`TABLES` holds named sub-queries; a twin lists only its own SELECT, and the
sub-queries it needs are put in front of it.
"""

from __future__ import annotations

import re

from earshot.functions import NULL_WORDS
from earshot.plans.marts import GENRE_WORDS
from earshot.plans.staging import STAGED
from earshot.plans.views import COUNTRY_NAMES, FEATURE_LABELS, GENRE_LABELS
from workload.standins import GENRES_BY_TYPE, HISTORICAL_DAYS, MARKET_CODES, MUSIC_CHARTS_DAYS, REVIEWS_DAYS


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def moment(ns: str) -> str:
    return f"make_timestamp(CAST(round({ns} / 1000.0) AS BIGINT))"


def parsed_date(text: str) -> str:
    return f"CAST(try_strptime({text}, '%Y-%m-%d') AS DATE)"


def whole_number(text: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') THEN CAST(trim({text}) AS BIGINT) END"


def ratio(part: str, whole: str, digits: int, unit: int = 1) -> str:
    """part / (whole * unit) of non-negative integers, rounded once, halves up, in whole numbers."""
    part, whole = f"CAST({part} AS HUGEINT)", f"(CAST({whole} AS HUGEINT) * {unit})"
    return f"CAST(({part} * {2 * 10**digits} + {whole}) // nullif(2 * {whole}, 0) AS DOUBLE) / 1e{digits}"


def mean(value: str, digits: int, divisor: int = 1, input_digits: int = 9) -> str:
    """Mean of non-negative values as a quotient of whole numbers: each value is taken to its digits first."""
    scaled = f"CAST(round({value} * 1e{input_digits}) AS HUGEINT)"
    return ratio(f"sum({scaled})", f"count({value})", digits, 10**input_digits * divisor)


def any_word(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), {sql_text(w)})" for w in words) + ")"


def cases(value: str, options: dict, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN {key} THEN {sql_text(result)}" for key, result in options.items())
    return f"CASE {value} {arms} ELSE {otherwise} END"


def date_text(value: str, variant: str) -> str:
    return (
        f"CASE {variant} WHEN 0 THEN strftime({value}, '%Y') WHEN 1 THEN strftime({value}, '%Y-%m') "
        f"ELSE strftime({value}, '%Y-%m-%d') END"
    )


def shifted(value: str, days: tuple[int, int]) -> str:
    """Nanoseconds of the day, moved into the days of the input."""
    first, count = days
    return f"(date_diff('day', DATE '1970-01-01', CAST({value} AS DATE)) % {count} + {first}) * 86400000000000"


SOLD = """FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

TABLES: dict[str, str] = {}

# ---- raw inputs --------------------------------------------------------------

TABLES["raw_music_charts"] = f"""
  SELECT CASE WHEN l_partkey % 101 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS spotify_id, p_name AS name, p_brand AS artists, p_type AS album_name,
    CASE WHEN l_orderkey % 79 = 0 THEN 0 ELSE CAST(l_linenumber AS BIGINT) END AS daily_rank, CAST(l_linenumber - 4 AS BIGINT) AS daily_movement,
    l_partkey % 7 - 3 AS weekly_movement,
    CASE WHEN s_nationkey <> 0 THEN {cases("s_nationkey", MARKET_CODES, "n_name")} END AS country,
    {shifted("l_shipdate", MUSIC_CHARTS_DAYS)} AS snapshot_date, l_quantity AS popularity,
    l_returnflag = 'R' AS is_explicit, l_extendedprice AS duration_ms,
    {date_text("l_shipdate", "l_linenumber % 3")} AS album_release_date,
    l_discount AS danceability, l_tax AS energy, l_discount * l_tax AS speechiness,
    p_size / 50.0 AS acousticness, l_tax / 2 AS instrumentalness, l_tax * 2 AS liveness,
    l_discount + l_tax AS valence, l_quantity + 60 AS tempo, l_quantity / -2 AS loudness,
    l_orderkey % 12 AS "key", CAST(l_linenumber % 2 AS BIGINT) AS mode,
    CAST(l_linenumber % 3 + 3 AS BIGINT) AS time_signature
  {SOLD}"""

TABLES["raw_music_charts_historical"] = f"""
  SELECT CASE WHEN l_partkey % 89 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS track_id, p_name AS name, p_brand AS artists,
    CASE WHEN p_size > 42 THEN 'EDM, deep house' WHEN p_size < 6 THEN 'contemporary country, soul'
      ELSE CASE p_type {" ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in GENRES_BY_TYPE.items())} END
    END AS artist_genres,
    CASE WHEN l_orderkey % 83 = 0 THEN 0 ELSE CAST(l_linenumber AS DOUBLE) END AS position, n_name AS country,
    {shifted("l_shipdate", HISTORICAL_DAYS)} AS date,
    l_extendedprice AS streams, l_extendedprice * 10 AS duration, l_returnflag = 'R' AS explicit
  {SOLD}"""

TABLES["raw_podcast_reviews"] = f"""
  SELECT 'r' || CAST(o_orderkey % 311 AS VARCHAR) AS podcast_id, CAST(o_custkey AS VARCHAR) AS author_id,
    o_orderpriority AS title, o_orderstatus || ' ' || CAST(o_orderkey AS VARCHAR) AS content,
    CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 51 = 0 THEN NULL
      ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS rating,
    {shifted("o_orderdate", REVIEWS_DAYS)} AS created_at
  FROM orders"""

TABLES["raw_podcast_shows"] = """
  SELECT CASE WHEN p_partkey % 103 <> 0 THEN 's' || CAST(p_partkey AS VARCHAR) END AS podcast_id, p_partkey AS itunes_id_x, p_name AS title,
    'studio ' || p_brand AS author, p_name || ', ' || p_type AS description,
    p_retailprice / 400.0 AS average_rating,
    CASE p_partkey % 9 WHEN 0 THEN '12.0' WHEN 1 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS ratings_count,
    p_partkey AS itunes_id_y,
    CASE WHEN p_partkey % 211 = 0 THEN 'Rare ' || p_type WHEN p_partkey % 97 = 0 THEN NULL
      ELSE p_brand END AS category
  FROM part"""

TABLES["raw_podcast_charts"] = f"""
  SELECT epoch_us(ts) * 1000 + ((event_id % 15) * 30 - 8522) * 86400000000000 AS date,
    CASE WHEN event_id % 173 <> 0 THEN event_id % 200 END AS rank, event_type AS region,
    CASE event_id % 3 WHEN 0 THEN 'UP' WHEN 1 THEN 'DOWN' ELSE 'UNCHANGED' END AS "chartRankMove",
    'episode:' || CAST(event_id AS VARCHAR) AS "episodeUri", 'show:' || CAST(user_id AS VARCHAR) AS "showUri",
    'episode ' || CAST(event_id AS VARCHAR) AS "episodeName", 'show ' || CAST(user_id AS VARCHAR) AS show_name,
    'publisher ' || CAST(user_id % 50 AS VARCHAR) AS show_publisher, props AS show_description,
    'audio' AS show_media_type, value / 2 AS show_total_episodes, value * 60000 AS duration_ms,
    event_id % 2 = 0 AS explicit, CASE event_id % 2 WHEN 0 THEN 'en' ELSE 'es,pt' END AS languages,
    {date_text("ts", "event_id % 3")} AS release_date
  FROM events"""

# ---- staged tables -------------------------------------------------------------

TABLES["music_charts"] = f"""
  SELECT spotify_id, name AS track_name, artists, album_name, daily_rank, daily_movement, weekly_movement,
    country, CAST({moment("snapshot_date")} AS DATE) AS snapshot_date, popularity, is_explicit, duration_ms,
    {parsed_date("album_release_date")} AS album_release_date, danceability, energy, speechiness,
    acousticness, instrumentalness, liveness, valence, tempo, loudness, "key", mode, time_signature
  FROM raw_music_charts WHERE spotify_id IS NOT NULL AND snapshot_date IS NOT NULL"""

TABLES["music_charts_historical"] = f"""
  SELECT track_id, name AS track_name, artists, artist_genres, CAST(round(position) AS BIGINT) AS position,
    country, CAST({moment("date")} AS DATE) AS chart_date, CAST(round(streams) AS BIGINT) AS streams,
    CAST(round(duration) AS BIGINT) AS duration_ms, explicit AS is_explicit,
    strftime({moment("date")}, '%Y-%m') AS chart_month
  FROM raw_music_charts_historical
  WHERE date IS NOT NULL AND position IS NOT NULL AND name IS NOT NULL"""

TABLES["podcast_reviews"] = f"""
  SELECT podcast_id, author_id, rating, title AS review_title, content AS review_content,
    {moment("created_at")} AS created_at, CAST({moment("created_at")} AS DATE) AS review_date,
    strftime({moment("created_at")}, '%Y-%m') AS review_month
  FROM raw_podcast_reviews
  WHERE podcast_id IS NOT NULL AND created_at IS NOT NULL AND rating BETWEEN 1 AND 5"""

TABLES["podcast_shows"] = f"""
  SELECT podcast_id, itunes_id_x AS itunes_id, title AS show_title, author AS show_author,
    description AS show_description, category, average_rating, {whole_number("ratings_count")} AS ratings_count
  FROM raw_podcast_shows WHERE podcast_id IS NOT NULL AND category IS NOT NULL"""

TABLES["podcast_charts"] = f"""
  SELECT CAST({moment("date")} AS DATE) AS chart_date, rank, region, "chartRankMove" AS chart_rank_move,
    "episodeUri" AS episode_uri, "showUri" AS show_uri, "episodeName" AS episode_name, show_name,
    show_publisher, show_description, show_media_type,
    CAST(round(show_total_episodes) AS BIGINT) AS show_total_episodes,
    CAST(round(duration_ms) AS BIGINT) AS duration_ms, explicit AS is_explicit, languages,
    {parsed_date("release_date")} AS release_date, strftime({moment("date")}, '%Y-%m') AS chart_month
  FROM raw_podcast_charts WHERE date IS NOT NULL AND rank IS NOT NULL"""

# ---- monthly tables and marts ------------------------------------------------

MUSIC_MEANS = ", ".join(
    f"{mean(c, d)} AS avg_{c}"
    for c, d in [
        ("popularity", 1), ("danceability", 3), ("energy", 3), ("speechiness", 3),
        ("acousticness", 3), ("valence", 3), ("tempo", 1), ("instrumentalness", 3),
    ]
)
TABLES["music_by_month"] = f"""
  SELECT strftime(snapshot_date, '%Y-%m') AS trend_month, country,
    count(DISTINCT spotify_id) AS unique_tracks, count(DISTINCT artists) AS unique_artists,
    count(*) AS total_chart_entries, {MUSIC_MEANS},
    {ratio('count(*) FILTER (WHERE is_explicit)', 'count(*)', 3)} AS explicit_ratio,
    {mean('duration_ms', 1, 60000, 3)} AS avg_duration_minutes
  FROM music_charts GROUP BY 1, 2"""

TABLES["reviews_by_month"] = f"""
  SELECT review_month AS trend_month, count(*) AS review_count, count(DISTINCT podcast_id) AS podcasts_reviewed,
    count(DISTINCT author_id) AS unique_reviewers, {mean('rating', 2, 1, 0)} AS avg_rating,
    count(*) FILTER (WHERE rating = 5) AS five_star_count, count(*) FILTER (WHERE rating = 1) AS one_star_count
  FROM podcast_reviews GROUP BY review_month"""

TABLES["charts_by_month"] = f"""
  SELECT chart_month AS trend_month, count(*) AS chart_entries,
    count(DISTINCT show_name) AS unique_shows_charting,
    {mean('duration_ms', 1, 60000, 0)} AS avg_episode_duration_minutes
  FROM podcast_charts GROUP BY chart_month"""

TABLES["big_categories"] = f"""
  SELECT category, count(DISTINCT podcast_id) AS shows_in_category,
    {mean('average_rating', 2)} AS category_avg_rating,
    CAST(sum(ratings_count) AS BIGINT) AS category_total_ratings
  FROM podcast_shows GROUP BY category HAVING count(DISTINCT podcast_id) >= 10"""

TABLES["rated_categories"] = """
  SELECT category, count(DISTINCT podcast_id) AS shows_in_category,
    CAST(sum(ratings_count) AS BIGINT) AS category_total_ratings
  FROM podcast_shows GROUP BY category HAVING sum(ratings_count) >= 1000"""

TABLES["podcasts_by_month"] = """
  SELECT coalesce(r.trend_month, c.trend_month) AS trend_month, review_count, podcasts_reviewed,
    unique_reviewers, avg_rating, five_star_count, one_star_count, chart_entries AS total_chart_entries,
    unique_shows_charting, avg_episode_duration_minutes, category, shows_in_category, category_avg_rating,
    category_total_ratings
  FROM reviews_by_month r FULL JOIN charts_by_month c ON r.trend_month = c.trend_month
    CROSS JOIN big_categories"""

TABLES["genres_by_month"] = f"""
  SELECT chart_month AS trend_month, count(*) AS total_chart_entries,
    count(DISTINCT track_id) AS unique_tracks, count(DISTINCT artists) AS unique_artists,
    count(DISTINCT country) AS countries_active, {mean('streams', 0, 1, 0)} AS avg_streams,
    {", ".join(f"count(*) FILTER (WHERE {any_word('artist_genres', w)}) AS {g}_entries"
               for g, w in GENRE_WORDS.items())}
  FROM music_charts_historical GROUP BY chart_month"""

ENTRIES = ", ".join(f"{g}_entries" for g in GENRE_WORDS)
SHARES = ", ".join(
    f"{ratio(f'{g}_entries', 'total_chart_entries', 4)} AS {g}_pct" for g in GENRE_WORDS
)
TABLES["genre_matrix"] = f"""
  SELECT g.trend_month, category, shows_in_category, category_total_ratings, review_count,
    podcasts_reviewed, unique_reviewers, avg_rating, total_chart_entries, unique_tracks, unique_artists,
    avg_streams, {ENTRIES}, {SHARES}
  FROM genres_by_month g JOIN reviews_by_month r ON g.trend_month = r.trend_month
    CROSS JOIN rated_categories"""

PROFILE = [
    ("popularity", 1), ("danceability", 3), ("energy", 3), ("speechiness", 3), ("valence", 3), ("acousticness", 3),
]
NO_PROFILE = ", ".join(f"CAST(NULL AS DOUBLE) AS music_avg_{c}" for c, _ in PROFILE)
TABLES["old_music"] = f"""
  SELECT trend_month, total_chart_entries AS music_chart_entries, countries_active,
    unique_tracks AS music_unique_tracks, unique_artists AS music_unique_artists,
    {NO_PROFILE}, CAST(NULL AS DOUBLE) AS music_explicit_ratio
  FROM genres_by_month"""

TABLES["old_podcasts"] = """
  SELECT trend_month, review_count AS podcast_total_reviews, podcasts_reviewed AS podcast_shows_reviewed,
    unique_reviewers AS podcast_unique_reviewers, avg_rating AS podcast_avg_rating,
    CAST(NULL AS BIGINT) AS podcast_categories_active, CAST(NULL AS BIGINT) AS podcast_chart_entries,
    CAST(NULL AS BIGINT) AS podcast_shows_charting, CAST(NULL AS VARCHAR) AS podcast_top_category
  FROM reviews_by_month"""

TABLES["new_music"] = f"""
  SELECT trend_month, CAST(sum(total_chart_entries) AS BIGINT) AS music_chart_entries,
    count(DISTINCT country) AS countries_active, CAST(sum(unique_tracks) AS BIGINT) AS music_unique_tracks,
    CAST(sum(unique_artists) AS BIGINT) AS music_unique_artists,
    {", ".join(f"{mean(f'avg_{c}', d)} AS music_avg_{c}" for c, d in PROFILE)},
    {mean('explicit_ratio', 3)} AS music_explicit_ratio
  FROM music_by_month GROUP BY trend_month"""

TABLES["new_podcasts"] = """
  SELECT trend_month, CAST(NULL AS BIGINT) AS podcast_total_reviews,
    CAST(NULL AS BIGINT) AS podcast_shows_reviewed, CAST(NULL AS BIGINT) AS podcast_unique_reviewers,
    CAST(NULL AS DOUBLE) AS podcast_avg_rating, count(DISTINCT category) AS podcast_categories_active,
    max(total_chart_entries) AS podcast_chart_entries, max(unique_shows_charting) AS podcast_shows_charting,
    (array_agg(category ORDER BY category_total_ratings DESC NULLS LAST, category DESC))[1]
      AS podcast_top_category
  FROM podcasts_by_month GROUP BY trend_month"""


def window(music: str, podcasts: str, source: str) -> str:
    return f"""
  SELECT coalesce(m.trend_month, p.trend_month) AS trend_month, m.* EXCLUDE (trend_month),
    p.* EXCLUDE (trend_month), '{source}' AS podcast_data_source
  FROM {music} m FULL JOIN {podcasts} p ON m.trend_month = p.trend_month"""


TABLES["old_window"] = window("old_music", "old_podcasts", "reviews")
TABLES["new_window"] = window("new_music", "new_podcasts", "charts")
TABLES["timeline"] = f"""
  SELECT *, {ratio('podcast_total_reviews', 'music_chart_entries', 4)} AS podcast_to_music_ratio
  FROM (SELECT * FROM old_window UNION ALL BY NAME SELECT * FROM new_window)"""

TABLES["names"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({sql_text(code)}, {sql_text(name)})" for code, name in COUNTRY_NAMES.items()
) + ") AS names(country, display_name)"

TABLES["countries"] = """
  SELECT country, coalesce(display_name, country) AS display_name
  FROM (SELECT DISTINCT country FROM music_by_month WHERE country IS NOT NULL) LEFT JOIN names USING (country)"""


def with_tables(select: str) -> str:
    """The SELECT with the sub-queries it reads, directly or not, in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(TABLES[name])
                needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name]})" for name in needed) + "\n" + select


def checks_sql() -> str:
    rows = []
    for table, model in STAGED.items():
        for column, names in model.checks.items():
            for check in names:
                broken = f"{column} IS NULL" if check == "not_null" else f"{column} <= 0"
                rows.append(
                    f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
                    f"count(*) FILTER (WHERE {broken}) AS violations, "
                    f"count(*) FILTER (WHERE {broken}) = 0 AS passed FROM {table}"
                )
    return "\nUNION ALL\n".join(rows)


def profile_sql() -> str:
    rows = []
    for name, columns in INPUT_COLUMNS.items():
        rows.append(
            f"SELECT '{name}' AS dataset, count(*) AS row_count, "
            f"CAST({len(columns)} AS BIGINT) AS column_count, "
            f"'{','.join(columns)}' AS column_names FROM raw_{name}"
        )
    return "\nUNION ALL\n".join(rows)


# Columns of each raw input, in order.
INPUT_COLUMNS = {
    "music_charts": [
        "spotify_id", "name", "artists", "album_name", "daily_rank", "daily_movement", "weekly_movement",
        "country", "snapshot_date", "popularity", "is_explicit", "duration_ms", "album_release_date",
        "danceability", "energy", "speechiness", "acousticness", "instrumentalness", "liveness", "valence",
        "tempo", "loudness", "key", "mode", "time_signature",
    ],
    "music_charts_historical": [
        "track_id", "name", "artists", "artist_genres", "position", "country", "date", "streams",
        "duration", "explicit",
    ],
    "podcast_reviews": ["podcast_id", "author_id", "title", "content", "rating", "created_at"],
    "podcast_shows": [
        "podcast_id", "itunes_id_x", "title", "author", "description", "average_rating", "ratings_count",
        "itunes_id_y", "category",
    ],
    "podcast_charts": [
        "date", "rank", "region", "chartRankMove", "episodeUri", "showUri", "episodeName", "show_name",
        "show_publisher", "show_description", "show_media_type", "show_total_episodes", "duration_ms",
        "explicit", "languages", "release_date",
    ],
}

MIXED_DATES = """CASE WHEN event_id % 5 = 4 THEN strftime(ts, '%d/%m/%Y')
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""
CREATED = f"(SELECT event_id, try_strptime({MIXED_DATES}, '%Y-%m-%d %H:%M:%S') AS created_at FROM events)"
IN_WINDOW = "created_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"
NULL_LIST = ", ".join(sql_text(w) for w in NULL_WORDS)
CHOSEN = "('US', 'GB', 'JP', 'BR', 'NATION_7')"
CHOSEN_LONG = "('US', 'ZA', 'NATION_7')"


def polygon_sql() -> str:
    corners = [*FEATURE_LABELS.items(), next(iter(FEATURE_LABELS.items()))]
    return "\nUNION ALL\n".join(
        f"SELECT country, coalesce(display_name, country) AS display_name, {i} AS position, "
        f"'{label}' AS feature, round(avg({column}), 9) AS value "
        f"FROM music_by_month LEFT JOIN names USING (country) WHERE country IN {CHOSEN_LONG} "
        f"GROUP BY country, display_name"
        for i, (column, label) in enumerate(corners)
    )


def shares_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT DISTINCT trend_month, '{genre}' AS genre, round({GENRE_LABELS[genre]} * 100, 9) AS share_percent, "
        f"review_count FROM genre_matrix WHERE review_count IS NOT NULL"
        for genre in ["Pop", "Hip-Hop/Rap", "Latin", "Rock"]
    )


def top_sql(source: str, by: str, tie: str) -> str:
    return f"SELECT * FROM ({source}) ORDER BY {by} DESC NULLS FIRST, {tie} DESC LIMIT 15"


SELECTS: dict[str, str] = {
    "ns_epoch_to_timestamp": f"""SELECT event_id,
        {moment("(epoch_us(ts) * 1000 + event_id % 1000)")} AS moment FROM events""",
    "ns_epoch_to_date": """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem""",
    "month_key_of_order": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_of_timestamp,
        strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month_of_date FROM orders""",
    "safe_parse_date": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 6 IN (2, 3) THEN CAST(o_orderdate AS DATE) END AS release_date FROM orders""",
    "safe_cast_int": f"""SELECT p_partkey, {whole_number("t")} AS ratings_count FROM (
        SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN ' ' || p_size || ' '
          WHEN 2 THEN p_size || '.0' WHEN 3 THEN p_size || 'e3' WHEN 4 THEN p_name END AS t FROM part)""",
    "round_cast_int": """SELECT l_orderkey, l_linenumber, CAST(round((l_quantity - 25) / 2) AS BIGINT) AS half_rounded,
        CAST(round(l_extendedprice) AS BIGINT) AS price_rounded FROM lineitem""",
    "null_words": f"""SELECT p_partkey, CASE WHEN t NOT IN ({NULL_LIST}) THEN t END AS name FROM (
        SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'NA' WHEN 1 THEN 'None' WHEN 2 THEN 'null' WHEN 3 THEN ''
          WHEN 4 THEN 'nan' WHEN 5 THEN 'Nancy' ELSE p_name END AS t FROM part)""",
    "genre_words": f"""SELECT doc_id,
        {", ".join(f"{any_word('text', w)} AS {g}_hit" for g, w in GENRE_WORDS.items())} FROM documents""",
    "date_window_filter": f"SELECT event_id, created_at FROM {CREATED} WHERE {IN_WINDOW}",
    "first_value_layout": f"SELECT event_id, created_at FROM {CREATED} WHERE {IN_WINDOW}",
    "mixed_layouts": f"""SELECT event_id, created_at FROM (SELECT event_id, CASE WHEN event_id % 5 = 4
        THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS created_at FROM events) WHERE {IN_WINDOW}""",
    "optional_categories": """SELECT 'with' AS file, CAST(c_custkey AS VARCHAR) AS podcast_id, c_name AS title,
        o_orderpriority AS category FROM customer LEFT JOIN orders ON c_custkey = o_custkey
      UNION ALL SELECT f.*, CAST(c_custkey AS VARCHAR), c_name, NULL
        FROM customer, (VALUES ('without'), ('no key')) f(file)""",
    "missing_input": """SELECT 'podcast reviews' AS dataset, count(*) AS row_count, NULL AS error FROM orders
      UNION ALL SELECT 'podcast shows', NULL, 'podcast shows'""",
    "load_partitioned": "SELECT *, count(*) OVER () AS loaded_rows FROM orders",
    "filter_report": f"""SELECT count(*) AS total_rows, count(created_at) AS dated_rows,
        count(*) FILTER (WHERE {IN_WINDOW}) AS kept_rows,
        count(created_at) - count(*) FILTER (WHERE {IN_WINDOW}) AS dropped_rows FROM {CREATED}""",
    "null_drop": """SELECT * FROM raw_podcast_reviews
        WHERE podcast_id IS NOT NULL AND created_at IS NOT NULL AND rating IS NOT NULL""",
    "rating_between": "SELECT * FROM raw_podcast_reviews WHERE rating BETWEEN 1 AND 5",
    "rename_dots_in_names": """SELECT event_id, user_id AS show_user_id, props AS show_description FROM events""",
    "pick_first_date_column": """SELECT o_orderkey, 'rank_date' AS date_column,
        strftime(CAST(o_orderdate AS DATE) + 31, '%Y-%m') AS month FROM orders""",
    "profile_of_inputs": profile_sql(),
    "left_join_with_fanout": """SELECT s.podcast_id, c_nationkey AS itunes_id_x, c_name AS title,
        o_orderkey AS itunes_id_y, o_orderpriority AS category
      FROM (SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS podcast_id, * FROM customer) s
        LEFT JOIN (SELECT CASE WHEN o_orderkey % 997 <> 0 THEN o_custkey END AS podcast_id, * FROM orders) o
        ON s.podcast_id IS NOT DISTINCT FROM o.podcast_id""",
    "csv_roundtrip": f"""SELECT doc_id, CASE WHEN text NOT IN ({NULL_LIST}) THEN text END AS text,
        CASE WHEN lang NOT IN ({NULL_LIST}) THEN lang END AS lang,
        CASE WHEN source NOT IN ({NULL_LIST}) THEN source END AS source, n_chars FROM documents""",
    "json_lines_roundtrip": "SELECT conv_id, turn, role, text FROM conversations",
    "json_array_roundtrip": "SELECT page_id, url, html FROM pages",
    "parquet_overwrite_roundtrip": "SELECT * FROM raw_podcast_reviews",
    "raw_load": "SELECT *, count(*) OVER () AS loaded_rows FROM supplier",
    "partitioned_roundtrip": "SELECT * FROM music_charts",
    "daily_refresh": """SELECT * REPLACE (CASE WHEN day(snapshot_date) % 2 = 0 THEN popularity + 100 ELSE popularity END
        AS popularity) FROM music_charts""",
    "bucketed_reviews": """SELECT author_id, count(*) AS review_count, max(review_date) AS last_review
        FROM podcast_reviews GROUP BY author_id""",
    "mart_read_by_month": "SELECT * FROM music_by_month ORDER BY trend_month",
    "stg_music_charts": "SELECT * FROM music_charts",
    "stg_music_charts_historical": "SELECT * FROM music_charts_historical",
    "stg_podcast_reviews": "SELECT * FROM podcast_reviews",
    "stg_podcast_shows": "SELECT * FROM podcast_shows",
    "stg_podcast_charts": "SELECT * FROM podcast_charts",
    "quality_of_staged": checks_sql(),
    "music_trends": "SELECT * FROM music_by_month ORDER BY trend_month NULLS FIRST, country NULLS FIRST",
    "review_monthly": "SELECT * FROM reviews_by_month",
    "monthly_reviews": """SELECT trend_month, review_count, podcasts_reviewed, unique_reviewers, avg_rating
        FROM reviews_by_month""",
    "chart_monthly": "SELECT * FROM charts_by_month",
    "category_summary_shows": "SELECT * FROM big_categories",
    "category_summary_ratings": "SELECT * FROM rated_categories",
    "podcast_trends": "SELECT * FROM podcasts_by_month ORDER BY trend_month, category_total_ratings DESC",
    "genre_monthly": "SELECT * FROM genres_by_month",
    "genre_category_matrix": "SELECT * FROM genre_matrix ORDER BY trend_month, category_total_ratings DESC",
    "historical_music": "SELECT * FROM old_music",
    "historical_podcasts": "SELECT * FROM old_podcasts",
    "ecosystem_window_1": "SELECT * FROM old_window",
    "current_music": "SELECT * FROM new_music",
    "current_podcasts": "SELECT * FROM new_podcasts",
    "ecosystem_window_2": "SELECT * FROM new_window",
    "ecosystem_timeline": "SELECT * FROM timeline ORDER BY trend_month",
    "mart_order": """SELECT 'music_trends' AS mart, trend_month, country AS second,
        row_number() OVER (ORDER BY trend_month NULLS FIRST, country NULLS FIRST) AS position FROM music_by_month
      UNION ALL SELECT 'podcast_trends', trend_month, CAST(category_total_ratings AS VARCHAR),
        row_number() OVER (ORDER BY trend_month, category_total_ratings DESC) FROM podcasts_by_month
      UNION ALL SELECT 'genre_category_matrix', trend_month, CAST(category_total_ratings AS VARCHAR),
        row_number() OVER (ORDER BY trend_month, category_total_ratings DESC) FROM genre_matrix
      UNION ALL SELECT 'ecosystem_timeline', trend_month, NULL,
        row_number() OVER (ORDER BY trend_month) FROM timeline""",
    "top_category": """SELECT p_brand,
        (array_agg(p_name ORDER BY CASE WHEN p_size >= 6 THEN p_size END DESC NULLS LAST, p_name DESC))[1]
          AS top_name
      FROM part GROUP BY p_brand""",
    "headline_numbers": """SELECT
        (SELECT CAST(coalesce(sum(music_chart_entries), 0) AS BIGINT) FROM timeline) AS total_music_entries,
        (SELECT CAST(coalesce(sum(podcast_total_reviews), 0) AS BIGINT) FROM timeline) AS total_podcast_reviews,
        (SELECT round(avg(avg_popularity), 9) FROM music_by_month) AS avg_music_popularity,
        (SELECT round(avg(category_avg_rating), 9) FROM podcasts_by_month) AS avg_podcast_rating""",
    "top_categories_by_ratings": top_sql(
        """SELECT category, max(category_total_ratings) AS category_total_ratings
           FROM podcasts_by_month WHERE category IS NOT NULL GROUP BY category""",
        "category_total_ratings",
        "category",
    ),
    "speechiness_by_month": """SELECT trend_month, round(avg(avg_speechiness), 9) AS avg_speechiness
        FROM music_by_month WHERE trend_month IS NOT NULL GROUP BY trend_month""",
    "top_categories_by_score": top_sql(
        """SELECT category, round(avg(category_avg_rating), 9) AS category_avg_rating,
             max(category_total_ratings) AS category_total_ratings
           FROM podcasts_by_month WHERE category IS NOT NULL GROUP BY category
           HAVING max(category_total_ratings) >= 1000""",
        "category_avg_rating",
        "category",
    ),
    "top_with_missing": top_sql(
        "SELECT user_id, max(CASE WHEN value >= 50 THEN value END) AS top_value FROM events GROUP BY user_id",
        "top_value",
        "user_id",
    ),
    "country_list": "SELECT * FROM countries ORDER BY country",
    "country_of_label": "SELECT display_name, split_part(display_name, ' – ', 1) AS country FROM countries",
    "country_profile": f"""SELECT country,
        {", ".join(f"round(avg({c}), 9) AS {c}" for c in FEATURE_LABELS)}
        FROM music_by_month WHERE country IN {CHOSEN} GROUP BY country""",
    "country_profile_long": polygon_sql(),
    "genre_share_vs_reviews": shares_sql(),
}

ORACLE: dict[str, str] = {name: with_tables(select) for name, select in SELECTS.items()}
