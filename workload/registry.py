"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query runs over the whole of the tables it reads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions import (
    contains_any,
    epoch_ns,
    month_key,
    ns_to_date,
    ns_to_timestamp,
    null_words_to_null,
    round_to_long,
    safe_date,
    safe_long,
)
from earshot.operators import (
    Window,
    group_known,
    keep_complete,
    left_join_fanout,
    parse_and_window,
    pick_date_column,
    quality_report,
    rename_dots,
    top_ascending,
    value_at_largest,
    window_report,
    with_place,
)
from earshot.operators.filters import FIRST_VALUE, parse_moment
from earshot.plans import marts, views
from earshot.plans.staging import STAGED
from earshot.session import prepare, scratch_folder
from earshot.sources import (
    create_database,
    input_profile,
    load_raw,
    publish,
    raw_path,
    read_csv,
    read_json,
    read_podcast_reviews,
    read_podcast_shows,
    read_table,
    read_table_by_month,
    refresh_partitions,
    write_buckets,
    write_table,
)
from workload.standins import RAW, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Means that the views leave unrounded are compared to this many digits, because
# the two engines add in different orders.
DIGITS = 9


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW[name](prepare(spark), sf_dir)


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return STAGED[name].build(raw(spark, sf_dir, name))


def scratch_database(spark: SparkSession) -> str:
    """A new database in the shared scratch folder."""
    folder = scratch_folder(prepare(spark), "database")
    return create_database(spark, "scratch_" + folder.rsplit("-", 1)[1], folder)


# ---- column functions ------------------------------------------------------


@query
def ns_epoch_to_timestamp(spark, sf_dir):
    # nanoseconds below a microsecond, so that the rounding shows
    ns = epoch_ns(F.col("ts")) + F.col("event_id") % 1000
    return table(spark, sf_dir, "events").select("event_id", ns_to_timestamp(ns).alias("moment"))


@query
def ns_epoch_to_date(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", ns_to_date(epoch_ns(F.col("l_shipdate"))).alias("ship_date")
    )


@query
def month_key_of_order(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month_key(F.col("o_orderdate")).alias("month_of_timestamp"),
        month_key(F.to_date("o_orderdate")).alias("month_of_date"),
    )


@query
def safe_parse_date(spark, sf_dir):
    kind = F.col("o_orderkey") % 6
    day = F.col("o_orderdate")
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy"))
        .when(kind == 1, F.date_format(day, "yyyy-MM"))
        .when(kind == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 3, F.date_format(day, "yyyy-M-d"))
        .when(kind == 4, F.date_format(day, "yyyy-MM-dd HH:mm"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", safe_date(text).alias("release_date"))


@query
def safe_cast_int(spark, sf_dir):
    kind = F.col("p_partkey") % 6
    size = F.col("p_size").cast("string")
    text = (
        F.when(kind == 0, size)
        .when(kind == 1, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(kind == 2, F.concat(size, F.lit(".0")))
        .when(kind == 3, F.concat(size, F.lit("e3")))
        .when(kind == 4, F.col("p_name"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", safe_long(text).alias("ratings_count"))


@query
def round_cast_int(spark, sf_dir):
    half = (F.col("l_quantity") - 25) / 2  # halves on both sides of zero
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_to_long(half).alias("half_rounded"),
        round_to_long(F.col("l_extendedprice")).alias("price_rounded"),
    )


@query
def null_words(spark, sf_dir):
    kind = F.col("p_partkey") % 8
    text = (
        F.when(kind == 0, "NA")
        .when(kind == 1, "None")
        .when(kind == 2, "null")
        .when(kind == 3, "")
        .when(kind == 4, "nan")
        .when(kind == 5, "Nancy")
        .otherwise(F.col("p_name"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", null_words_to_null(text).alias("name"))


@query
def genre_words(spark, sf_dir):
    """Keyword buckets over whole document texts."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        *[
            F.coalesce(contains_any(text, words), F.lit(False)).alias(f"{genre}_hit")
            for genre, words in marts.GENRE_WORDS.items()
        ],
    )


# ---- readers and filters ---------------------------------------------------


def events_with_mixed_dates(spark, sf_dir):
    text = F.when(F.col("event_id") % 5 == 4, F.date_format("ts", "dd/MM/yyyy")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("created_at"))


@query
def date_window_filter(spark, sf_dir):
    """Text dates in a given layout, a fifth of them unreadable; the last day is
    kept at midnight only."""
    events = events_with_mixed_dates(spark, sf_dir)
    return parse_and_window(events, "created_at", Window("2024-01-05", "2024-01-20"), ["yyyy-M-d H:mm:ss"])


@query
def first_value_layout(spark, sf_dir):
    """The same by the layout of the first value, looked up in the data."""
    events = events_with_mixed_dates(spark, sf_dir)
    return parse_and_window(events, "created_at", Window("2024-01-05", "2024-01-20"), FIRST_VALUE)


@query
def mixed_layouts(spark, sf_dir):
    """The same with a layout for every text: nothing is unreadable."""
    events = events_with_mixed_dates(spark, sf_dir)
    layouts = ["yyyy-M-d H:mm:ss", "d/M/yyyy"]
    return parse_and_window(events, "created_at", Window("2024-01-05", "2024-01-20"), layouts)


@query
def filter_report(spark, sf_dir):
    text = F.when(F.col("event_id") % 5 == 4, F.date_format("ts", "dd/MM/yyyy")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    events = table(spark, sf_dir, "events").select(parse_moment(text, ["yyyy-M-d H:mm:ss"]).alias("created_at"))
    return window_report(events, "created_at", Window("2024-01-05", "2024-01-20"))


@query
def null_drop(spark, sf_dir):
    return keep_complete(raw(spark, sf_dir, "podcast_reviews"), "podcast_id", "created_at", "rating")


@query
def rating_between(spark, sf_dir):
    return raw(spark, sf_dir, "podcast_reviews").filter(F.col("rating").between(1, 5))


@query
def rename_dots_in_names(spark, sf_dir):
    dotted = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("show.user.id"), F.col("props").alias("show.description")
    )
    return rename_dots(dotted)


@query
def pick_first_date_column(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("created_at"),
        F.date_add("o_orderdate", 31).alias("rank_date"),
    )
    column = pick_date_column(orders.columns)
    return orders.select("o_orderkey", F.lit(column).alias("date_column"), month_key(F.col(column)).alias("month"))


@query
def profile_of_inputs(spark, sf_dir):
    profiles = [input_profile(raw(spark, sf_dir, name), name) for name in RAW]
    report = profiles[0]
    for profile in profiles[1:]:
        report = report.unionByName(profile)
    return report


@query
def left_join_with_fanout(spark, sf_dir):
    """Customers as shows, their orders as categories; some customers have none, and
    missing keys on both sides meet."""
    shows = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("podcast_id"),
        F.col("c_nationkey").alias("itunes_id"),
        F.col("c_name").alias("title"),
    )
    categories = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 997 != 0, F.col("o_custkey")).alias("podcast_id"),
        F.col("o_orderkey").alias("itunes_id"),
        F.col("o_orderpriority").alias("category"),
    )
    return left_join_fanout(shows, categories, "podcast_id")


# ---- file round trips ------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Whole documents (newlines, quotes) through CSV text."""
    path = scratch_folder(spark, "csv")
    documents = table(spark, sf_dir, "documents")
    (
        documents.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_csv(spark, path, {"doc_id": "bigint", "n_chars": "bigint"}, "documents", files="all")


@query
def json_lines_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "jsonl")
    table(spark, sf_dir, "conversations").write.json(path)
    types = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    return read_json(spark, path, types, "conversations")


def _array_lines() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function (nested, so that it travels by value) from the JSON rows of a
    partition to the lines of one array."""

    def lines_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for batch in batches:
            lines = batch["value"].tolist()
            yield batch.assign(value=[(lead if i == 0 else ",") + line for i, line in enumerate(lines)])
            lead = "," if lines else lead
        yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})

    return lines_of


@query
def json_array_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "json")
    rows = table(spark, sf_dir, "pages").select(F.to_json(F.struct("page_id", "url", "html")).alias("value"))
    rows.mapInPandas(_array_lines(), "value string").write.text(path)
    return read_json(spark, path, {"page_id": "bigint", "url": "string", "html": "string"}, "pages")


@query
def optional_categories(spark, sf_dir):
    """Shows read with a categories file, without one, and with one that lacks the key."""
    shows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("podcast_id"), F.col("c_name").alias("title")
    )
    categories = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("podcast_id"), F.col("o_orderpriority").alias("category")
    )
    files = {"with": categories, "without": None, "no key": categories.withColumnRenamed("podcast_id", "id")}
    found = []
    for case, file in files.items():
        folder = scratch_folder(spark, "shows")
        shows.write.json(f"{folder}/podcasts.json")
        if file is not None:
            file.write.json(f"{folder}/categories.json")
        read = read_podcast_shows(spark, folder)
        category = F.col("category") if "category" in read.columns else F.lit(None).cast("string")
        found.append(read.select(F.lit(case).alias("file"), "podcast_id", "title", category.alias("category")))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def missing_input(spark, sf_dir):
    """Required inputs that are there, with their rows, and one that is not, with the error that names it."""
    folder = scratch_folder(spark, "required")
    table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("podcast_id"), F.col("o_orderdate").cast("string").alias("created_at")
    ).write.json(f"{folder}/reviews.json")
    found = None
    for dataset, reader in (("podcast reviews", read_podcast_reviews), ("podcast shows", read_podcast_shows)):
        try:
            frame = reader(spark, folder, Window("1900-01-01", "2100-01-01")) if "reviews" in dataset else reader(spark, folder)
            row = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(dataset).alias("dataset"), "row_count", F.lit(None).cast("string").alias("error"))
        except FileNotFoundError as error:
            row = spark.range(1).select(
                F.lit(dataset).alias("dataset"), F.lit(None).cast("bigint").alias("row_count"),
                F.lit(str(error).split(":")[0]).alias("error"))
        found = row if found is None else found.unionByName(row)
    return found


@query
def load_partitioned(spark, sf_dir):
    """A Parquet input loaded into a raw table with a partition column and a cluster column."""
    name = f"{scratch_database(spark)}.orders"
    rows = load_raw(spark, f"{sf_dir}/orders.parquet", name, "o_orderstatus", ["o_custkey"])
    return read_table(spark, name).withColumn("loaded_rows", F.lit(rows).cast("bigint"))


@query
def parquet_overwrite_roundtrip(spark, sf_dir):
    """A second write replaces the first."""
    lake = scratch_folder(spark, "lake")
    name, folder = f"{scratch_database(spark)}.podcast_reviews", raw_path(lake, "podcast_reviews")
    write_table(raw(spark, sf_dir, "podcast_shows"), name, folder=folder)
    write_table(raw(spark, sf_dir, "podcast_reviews"), name, folder=folder)
    return read_table(spark, name)


@query
def raw_load(spark, sf_dir):
    """A Parquet input loaded into a raw table, clustered; with the loaded count."""
    name = f"{scratch_database(spark)}.supplier"
    rows = load_raw(spark, f"{sf_dir}/supplier.parquet", name, None, ["s_nationkey"])
    return read_table(spark, name).withColumn("loaded_rows", F.lit(rows).cast("bigint"))


@query
def partitioned_roundtrip(spark, sf_dir):
    """Staged music charts, partitioned by day and clustered by country."""
    name = f"{scratch_database(spark)}.music_charts"
    model = STAGED["music_charts"]
    write_table(staged(spark, sf_dir, "music_charts"), name, model.partition_by, model.cluster_by)
    return read_table(spark, name)


@query
def daily_refresh(spark, sf_dir):
    """Staged music charts; then the days of even number are staged again, with other popularities."""
    name = f"{scratch_database(spark)}.music_charts"
    model = STAGED["music_charts"]
    charts = staged(spark, sf_dir, "music_charts")
    write_table(charts, name, model.partition_by, model.cluster_by)
    again = charts.filter(F.dayofmonth("snapshot_date") % 2 == 0).withColumn("popularity", F.col("popularity") + 100)
    return refresh_partitions(again, name, model.partition_by, model.cluster_by)


@query
def bucketed_reviews(spark, sf_dir):
    """Reviews per reviewer from a table in buckets of the reviewer: no shuffle after the load."""
    name = f"{scratch_database(spark)}.reviews"
    publish(write_buckets(staged(spark, sf_dir, "podcast_reviews"), name, "author_id", 16))
    by_reviewer = read_table(spark, name).groupBy("author_id")
    return by_reviewer.agg(F.count(F.lit(1)).alias("review_count"), F.max("review_date").alias("last_review"))


@query
def mart_read_by_month(spark, sf_dir):
    name = f"{scratch_database(spark)}.music_trends"
    write_table(music_trends_mart(spark, sf_dir), name)
    return read_table_by_month(spark, name)


# ---- staged tables -----------------------------------------------------------


@query
def stg_music_charts(spark, sf_dir):
    return staged(spark, sf_dir, "music_charts")


@query
def stg_music_charts_historical(spark, sf_dir):
    return staged(spark, sf_dir, "music_charts_historical")


@query
def stg_podcast_reviews(spark, sf_dir):
    return staged(spark, sf_dir, "podcast_reviews")


@query
def stg_podcast_shows(spark, sf_dir):
    return staged(spark, sf_dir, "podcast_shows")


@query
def stg_podcast_charts(spark, sf_dir):
    return staged(spark, sf_dir, "podcast_charts")


@query
def quality_of_staged(spark, sf_dir):
    reports = [
        quality_report(staged(spark, sf_dir, name), name, model.checks) for name, model in STAGED.items()
    ]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


# ---- monthly tables and marts ------------------------------------------------


def music_trends_mart(spark, sf_dir):
    return marts.music_trends(staged(spark, sf_dir, "music_charts"))


def totals(spark, sf_dir):
    return marts.category_totals(staged(spark, sf_dir, "podcast_shows"))


def podcast_trends_mart(spark, sf_dir):
    return marts.podcast_trends(
        review_monthly(spark, sf_dir), chart_monthly(spark, sf_dir), totals(spark, sf_dir)
    )


def matrix_mart(spark, sf_dir):
    return marts.genre_category_matrix(
        genre_monthly(spark, sf_dir), review_monthly(spark, sf_dir), totals(spark, sf_dir)
    )


def timeline_mart(spark, sf_dir):
    return marts.ecosystem_timeline(
        genre_monthly(spark, sf_dir), review_monthly(spark, sf_dir), music_trends_mart(spark, sf_dir),
        chart_monthly(spark, sf_dir), totals(spark, sf_dir),
    )


def podcast_window(spark, sf_dir):
    return marts.current_podcasts(review_monthly(spark, sf_dir), chart_monthly(spark, sf_dir), totals(spark, sf_dir))


@query
def music_trends(spark, sf_dir):
    return marts.in_mart_order(music_trends_mart(spark, sf_dir), "music_trends")


@query
def review_monthly(spark, sf_dir):
    return marts.review_monthly(staged(spark, sf_dir, "podcast_reviews"))


@query
def monthly_reviews(spark, sf_dir):
    return marts.monthly_reviews(review_monthly(spark, sf_dir))


@query
def chart_monthly(spark, sf_dir):
    return marts.chart_monthly(staged(spark, sf_dir, "podcast_charts"))


@query
def category_summary_shows(spark, sf_dir):
    return marts.category_summary_by_shows(totals(spark, sf_dir))


@query
def category_summary_ratings(spark, sf_dir):
    return marts.category_summary_by_ratings(totals(spark, sf_dir))


@query
def podcast_trends(spark, sf_dir):
    return marts.in_mart_order(podcast_trends_mart(spark, sf_dir), "podcast_trends")


@query
def genre_monthly(spark, sf_dir):
    return marts.genre_monthly(staged(spark, sf_dir, "music_charts_historical"))


@query
def genre_category_matrix(spark, sf_dir):
    return marts.in_mart_order(matrix_mart(spark, sf_dir), "genre_category_matrix")


@query
def historical_music(spark, sf_dir):
    return marts.historical_music(genre_monthly(spark, sf_dir))


@query
def historical_podcasts(spark, sf_dir):
    return marts.historical_podcasts(review_monthly(spark, sf_dir))


@query
def ecosystem_window_1(spark, sf_dir):
    return marts.ecosystem_window_1(genre_monthly(spark, sf_dir), review_monthly(spark, sf_dir))


@query
def current_music(spark, sf_dir):
    return marts.current_music(music_trends_mart(spark, sf_dir))


@query
def current_podcasts(spark, sf_dir):
    return podcast_window(spark, sf_dir)


@query
def ecosystem_window_2(spark, sf_dir):
    return marts.ecosystem_window_2(music_trends_mart(spark, sf_dir), podcast_window(spark, sf_dir))


@query
def ecosystem_timeline(spark, sf_dir):
    return marts.in_mart_order(timeline_mart(spark, sf_dir), "ecosystem_timeline")


@query
def mart_order(spark, sf_dir):
    """The place of each row in the published order of the marts, with what it is ordered by."""
    built = {"music_trends": music_trends_mart, "podcast_trends": podcast_trends_mart,
             "genre_category_matrix": matrix_mart, "ecosystem_timeline": timeline_mart}
    found = None
    for mart, second in (("music_trends", "country"), ("podcast_trends", "category_total_ratings"),
                         ("genre_category_matrix", "category_total_ratings"), ("ecosystem_timeline", None)):
        rows = with_place(built[mart](spark, sf_dir), *marts.mart_order(mart)).select(
            F.lit(mart).alias("mart"), "trend_month",
            (F.col(second).cast("string") if second else F.lit(None).cast("string")).alias("second"), "position",
        )
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def top_category(spark, sf_dir):
    """Value at the largest measure, with missing measures and ties: per brand,
    the part type of the largest size; sizes below 6 count as missing."""
    part = table(spark, sf_dir, "part").withColumn("size", F.when(F.col("p_size") >= 6, F.col("p_size")))
    return part.groupBy("p_brand").agg(value_at_largest("p_name", "size").alias("top_name"))


# ---- views -------------------------------------------------------------------


@query
def headline_numbers(spark, sf_dir):
    numbers = views.headline_numbers(
        genre_monthly(spark, sf_dir), review_monthly(spark, sf_dir), chart_monthly(spark, sf_dir),
        music_trends_mart(spark, sf_dir), category_summary_shows(spark, sf_dir),
    )
    return rounded(numbers, "avg_music_popularity", "avg_podcast_rating")


@query
def top_categories_by_ratings(spark, sf_dir):
    return views.top_categories_by_ratings(category_summary_shows(spark, sf_dir))


@query
def speechiness_by_month(spark, sf_dir):
    return rounded(views.speechiness_by_month(music_trends_mart(spark, sf_dir)), "avg_speechiness")


@query
def top_categories_by_score(spark, sf_dir):
    return rounded(views.top_categories_by_score(category_summary_shows(spark, sf_dir)), "category_avg_rating")


@query
def top_with_missing(spark, sf_dir):
    """The top 15 report where missing measures rank first: users by their
    largest value, values below 50 counting as missing."""
    events = table(spark, sf_dir, "events")
    totals = group_known(events, "user_id", F.max(F.when(F.col("value") >= 50, F.col("value"))).alias("top_value"))
    return top_ascending(totals, "top_value", tie="user_id")


@query
def country_list(spark, sf_dir):
    return views.country_list(music_trends_mart(spark, sf_dir))


@query
def country_of_label(spark, sf_dir):
    labels = views.country_list(music_trends_mart(spark, sf_dir)).select("display_name")
    return views.label_codes(labels, "display_name")


@query
def country_profile(spark, sf_dir):
    profile = views.country_profile(music_trends_mart(spark, sf_dir), [*views.DEFAULT_COUNTRIES, "NATION_7"])
    return rounded(profile, *views.FEATURE_LABELS)


@query
def country_profile_long(spark, sf_dir):
    long = views.country_profile_long(
        music_trends_mart(spark, sf_dir), ["US – United States", "ZA – South Africa", "NATION_7"]
    )
    return rounded(long, "value")


@query
def genre_share_vs_reviews(spark, sf_dir):
    """From the matrix, which repeats a month once per category."""
    return rounded(views.genre_share_vs_reviews(matrix_mart(spark, sf_dir)), "share_percent")
