"""The five raw inputs, shaped from the driver's tables (FIXTURES.md).

Each stand-in holds a row for every row of its driver table: dates are shifted
into the months of the input, none is cut off. Columns that no mart needs are
derived from the same rows. The driver's tables hold no NULLs, so some are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import prepare

# First day (days since 1970-01-01) and number of days of each
# input. They overlap in part, as in the source: 1999-10 to 2001-06, 1997-07 to
# 1998-12, and 1998-01 to 2000-12; podcast charts start in 2000-09.
MUSIC_CHARTS_DAYS = (10865, 639)
HISTORICAL_DAYS = (10043, 549)
REVIEWS_DAYS = (10227, 1096)

# Some nations carry the code of a known market, so the name
# lookup has hits and misses; nation 0 is the global list without a country.
MARKET_CODES = {1: "US", 2: "GB", 3: "JP", 4: "BR", 5: "AE", 6: "ZA"}

# Genre text of the part types.
GENRES_BY_TYPE = {
    "STANDARD": "dance pop, pop",
    "ECONOMY": "Hip Hop, trap",
    "MEDIUM": "indie rock",
    "SMALL": "latin, reggaeton",
    "LARGE": "k-pop, korean r&b",
}

# Schemas of the driver's tables; with them a read needs no look at the files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cases(value: str, options: dict, otherwise: str) -> str:
    arms = " ".join(f"when {key!r} then {result!r}" for key, result in options.items())
    return f"case {value} {arms} else {otherwise} end"


def _epoch_ns(moment: str) -> str:
    return f"unix_micros(cast({moment} as timestamp)) * 1000"


def _date_text(moment: str, variant: str) -> str:
    """Year, year-month or full date text, by variant 0, 1, 2."""
    return (
        f"case {variant} when 0 then date_format({moment}, 'yyyy') "
        f"when 1 then date_format({moment}, 'yyyy-MM') else date_format({moment}, 'yyyy-MM-dd') end"
    )


def _shifted_ns(moment: str, days: tuple[int, int]) -> str:
    """Nanoseconds of a day, moved into the given days by its remainder."""
    first, count = days
    return f"(unix_date(cast({moment} as date)) % {count} + {first}) * 86400000000000"


def _sold_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part and the supplier's nation."""
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    markets = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey")
    )
    return lines.join(part, F.expr("l_partkey = p_partkey")).join(markets, F.expr("l_suppkey = s_suppkey"))


def raw_music_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold_parts(spark, sf_dir).selectExpr(
        "case when l_partkey % 101 <> 0 then cast(l_partkey as string) end as spotify_id",
        "p_name as name",
        "p_brand as artists",
        "p_type as album_name",
        "case when l_orderkey % 79 = 0 then 0L else cast(l_linenumber as bigint) end as daily_rank",
        "cast(l_linenumber - 4 as bigint) as daily_movement",
        "l_partkey % 7 - 3 as weekly_movement",
        f"case when s_nationkey <> 0 then {_cases('s_nationkey', MARKET_CODES, 'n_name')} end as country",
        f"{_shifted_ns('l_shipdate', MUSIC_CHARTS_DAYS)} as snapshot_date",
        "l_quantity as popularity",
        "l_returnflag = 'R' as is_explicit",
        "l_extendedprice as duration_ms",
        f"{_date_text('l_shipdate', 'l_linenumber % 3')} as album_release_date",
        "l_discount as danceability",
        "l_tax as energy",
        "l_discount * l_tax as speechiness",
        "p_size / 50.0D as acousticness",
        "l_tax / 2 as instrumentalness",
        "l_tax * 2 as liveness",
        "l_discount + l_tax as valence",
        "l_quantity + 60 as tempo",
        "l_quantity / -2 as loudness",
        "l_orderkey % 12 as key",
        "cast(l_linenumber % 2 as bigint) as mode",
        "cast(l_linenumber % 3 + 3 as bigint) as time_signature",
    )


def raw_music_charts_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold_parts(spark, sf_dir).selectExpr(
        "case when l_partkey % 89 <> 0 then cast(l_partkey as string) end as track_id",
        "p_name as name",
        "p_brand as artists",
        "case when p_size > 42 then 'EDM, deep house' when p_size < 6 then 'contemporary country, soul' "
        f"else {_cases('p_type', GENRES_BY_TYPE, 'null')} end as artist_genres",
        "case when l_orderkey % 83 = 0 then 0.0D else cast(l_linenumber as double) end as position",
        "n_name as country",
        f"{_shifted_ns('l_shipdate', HISTORICAL_DAYS)} as date",
        "l_extendedprice as streams",
        "l_extendedprice * 10 as duration",
        "l_returnflag = 'R' as explicit",
    )


def raw_podcast_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "'r' || cast(o_orderkey % 311 as string) as podcast_id",
        "cast(o_custkey as string) as author_id",
        "o_orderpriority as title",
        "o_orderstatus || ' ' || cast(o_orderkey as string) as content",
        "case when o_orderkey % 50 = 0 then 0L when o_orderkey % 51 = 0 then null "
        "else cast(substr(o_orderpriority, 1, 1) as bigint) end as rating",
        f"{_shifted_ns('o_orderdate', REVIEWS_DAYS)} as created_at",
    )


def raw_podcast_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "case when p_partkey % 103 <> 0 then 's' || cast(p_partkey as string) end as podcast_id",
        "p_partkey as itunes_id_x",
        "p_name as title",
        "'studio ' || p_brand as author",
        "p_name || ', ' || p_type as description",
        "p_retailprice / 400.0D as average_rating",
        "case p_partkey % 9 when 0 then '12.0' when 1 then 'n/a' else cast(p_size as string) end as ratings_count",
        "p_partkey as itunes_id_y",
        "case when p_partkey % 211 = 0 then 'Rare ' || p_type when p_partkey % 97 = 0 then null "
        "else p_brand end as category",
    )


def raw_podcast_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        f"{_epoch_ns('ts')} + ((event_id % 15) * 30 - 8522) * 86400000000000 as date",
        "case when event_id % 173 <> 0 then event_id % 200 end as rank",
        "event_type as region",
        "case event_id % 3 when 0 then 'UP' when 1 then 'DOWN' else 'UNCHANGED' end as chartRankMove",
        "'episode:' || cast(event_id as string) as episodeUri",
        "'show:' || cast(user_id as string) as showUri",
        "'episode ' || cast(event_id as string) as episodeName",
        "'show ' || cast(user_id as string) as show_name",
        "'publisher ' || cast(user_id % 50 as string) as show_publisher",
        "props as show_description",
        "'audio' as show_media_type",
        "value / 2 as show_total_episodes",
        "value * 60000 as duration_ms",
        "event_id % 2 = 0 as explicit",
        "case event_id % 2 when 0 then 'en' else 'es,pt' end as languages",
        f"{_date_text('ts', 'event_id % 3')} as release_date",
    )


RAW = {
    "music_charts": raw_music_charts,
    "music_charts_historical": raw_music_charts_historical,
    "podcast_reviews": raw_podcast_reviews,
    "podcast_shows": raw_podcast_shows,
    "podcast_charts": raw_podcast_charts,
}
