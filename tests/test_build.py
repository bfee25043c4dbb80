import csv
import json
import random
import uuid
from pathlib import Path

import duckdb
import pytest

from earshot.operators import QualityError
from earshot.plans import marts
from earshot.plans.build import build_all, ingest, refresh_days, stage
from earshot.plans.staging import STAGED
from earshot.sources import raw_path, read_table
from workload.standins import RAW

GENRES = ["dance pop", "Trap, Hip Hop", "indie rock", "k-pop", "", "soul", "deep house"]


@pytest.fixture
def prefix(spark):
    """Names of databases of its own for a test."""
    own = f"b{uuid.uuid4().hex}_"
    yield own
    for name in ("lake", "raw", "staged", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS {own}{name} CASCADE")


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    """Small source folders with quirks: dotted names, quotes, null words, bad dates."""
    rng = random.Random(11)
    root = tmp_path_factory.mktemp("sources")
    folders = {k: root / k for k in ("music_charts", "music_charts_historical", "podcast_reviews", "podcast_charts")}
    for folder in folders.values():
        folder.mkdir()

    def table(folder, header, rows):
        with open(folder / "data.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(header)
            writer.writerows(rows)

    def day(year, month):
        return f"{year}-{month:02d}-{rng.randint(1, 28):02d}"

    features = ["danceability", "energy", "speechiness", "acousticness", "instrumentalness", "liveness",
                "valence", "tempo", "loudness"]
    header = ["spotify_id", "name", "artists", "daily_rank", "daily_movement", "weekly_movement", "country",
              "snapshot_date", "popularity", "is_explicit", "duration_ms", "album_name", "album_release_date",
              *features, "key", "mode", "time_signature"]
    table(folders["music_charts"], header, [
        [f"t{rng.randint(0, 30)}", 'Say "hi",\nagain' if i % 40 == 0 else "Song", f"A{rng.randint(0, 9)}",
         rng.randint(1, 50), 0, 0, rng.choice(["US", "GB", "", "NA"]),
         "bad" if i % 90 == 1 else day(rng.choice([2019, 2024]), rng.randint(1, 6)), rng.randint(0, 100),
         rng.choice(["True", "False"]), rng.randint(60000, 300000), "Album",
         rng.choice(["1998", "2020-05-01"]), *[round(rng.random(), 3) for _ in features], 1, 0, 4]
        for i in range(400)
    ])
    table(folders["music_charts_historical"],
          ["date", "country", "position", "streams", "track_id", "artists", "artist_genres", "duration", "explicit", "name"],
          [[day(2022, rng.randint(1, 9)), "us", rng.randint(1, 200), rng.randint(1, 10**6), f"h{rng.randint(0, 20)}",
            f"A{rng.randint(0, 9)}", rng.choice(GENRES), rng.randint(1, 10**5), "False", "Song"] for _ in range(300)])
    table(folders["podcast_charts"],
          ["date", "rank", "region", "chartRankMove", "episodeUri", "showUri", "episodeName", "show.name",
           "show.publisher", "show.description", "show.media_type", "show.total_episodes", "duration_ms",
           "explicit", "languages", "release_date"],
          [[day(2024, rng.randint(3, 9)), rng.randint(1, 200), "us", "UP", "e", "s", "Ep", f"Show {rng.randint(0, 9)}",
            "P", "D", "audio", "12.0", "1800000.5", "True", "en", "2024-01-01"] for _ in range(200)])

    reviews = [{"podcast_id": f"r{rng.randint(0, 9)}", "author_id": f"u{rng.randint(0, 40)}",
                "rating": rng.choice([0, 1, 3, 5]), "title": "T", "content": "line\nline",
                "created_at": f"{day(2022, rng.randint(4, 12))}T10:00:00-07:00"} for _ in range(300)]
    (folders["podcast_reviews"] / "reviews.json").write_text("\n".join(map(json.dumps, reviews)))
    shows = [{"podcast_id": f"s{i}", "itunes_id": i, "title": "T", "author": "A", "description": "D",
              "average_rating": 4.5, "ratings_count": "n/a" if i % 9 == 0 else str(100 + i)} for i in range(60)]
    (folders["podcast_reviews"] / "podcasts.json").write_text(json.dumps(shows))
    categories = [{"podcast_id": f"s{i}", "itunes_id": i, "category": c} for i in range(50)
                  for c in (["comedy", "news"] if i % 2 else ["comedy"])] + [
                  {"podcast_id": "s1", "itunes_id": 1, "category": "rare"}]
    (folders["podcast_reviews"] / "categories.json").write_text("\n".join(map(json.dumps, categories)))
    return {k: str(v) for k, v in folders.items()}


def test_sources_to_marts(spark, sources, tmp_path, prefix):
    written = ingest(spark, sources, str(tmp_path / "lake"), prefix=prefix)
    assert all(Path(raw_path(str(tmp_path / "lake"), name)).is_dir() for name in written)
    raw = {name: read_table(spark, table) for name, table in written.items()}
    report = {r["dataset"]: r for r in read_table(spark, f"{prefix}lake.ingest_report").collect()}
    assert set(report) == set(written)
    charts = report["music_charts"]
    assert charts["total_rows"] == 400 > charts["dated_rows"] > charts["kept_rows"] == charts["written_rows"] > 0
    for name, df in raw.items():
        assert report[name]["written_rows"] == df.count() and report[name]["column_names"] == ",".join(df.columns)
    assert report["podcast_shows"]["total_rows"] == 60 and report["podcast_shows"]["kept_rows"] is None
    assert dict(raw["music_charts"].dtypes)["snapshot_date"] == "bigint"
    assert dict(raw["podcast_reviews"].dtypes)["created_at"] == "bigint"

    tables = build_all(spark, str(tmp_path / "out"), prefix)
    frames = {name: df.toPandas() for name, df in tables.items()}
    assert set(marts.SORT_KEYS) < set(frames)

    # 200 or so rows of 2024 stay, the bad dates and 2019 go; NULL country is a group
    music = frames["music_trends"]
    expected = duckdb.sql(f"""
        SELECT count(*) FROM read_csv('{sources["music_charts"]}/data.csv', all_varchar=true, header=true)
        WHERE snapshot_date LIKE '2024%'""").fetchall()[0][0]
    assert music["total_chart_entries"].sum() == expected
    assert music["country"].isna().any() and set(music["country"].dropna()) == {"US", "GB"}

    # months x categories; "rare" has one show and 100 ratings
    podcasts = frames["podcast_trends"]
    months = set(frames["review_monthly"]["trend_month"]) | set(frames["chart_monthly"]["trend_month"])
    assert set(podcasts["category"]) == {"comedy", "news"}
    assert len(podcasts) == len(months) * 2

    matrix = frames["genre_category_matrix"]
    shared = set(frames["genre_monthly"]["trend_month"]) & set(frames["review_monthly"]["trend_month"])
    assert len(matrix) == len(shared) * 2
    shares = matrix[[c for c in matrix if c.endswith("_pct")]]
    assert ((shares >= 0) & (shares <= 1)).all().all()

    timeline = frames["ecosystem_timeline"]
    first = set(frames["genre_monthly"]["trend_month"]) | set(frames["review_monthly"]["trend_month"])
    second = set(music["trend_month"]) | set(podcasts["trend_month"])
    assert len(timeline) == len(first) + len(second)
    charts = timeline[timeline["podcast_data_source"] == "charts"]
    assert charts["podcast_to_music_ratio"].isna().all()

    # a second run replaces everything and gives the same tables
    again = build_all(spark, str(tmp_path / "out"), prefix)
    for name, df in again.items():
        key = [c for c in ("trend_month", "country", "category", "podcast_data_source") if c in df.columns]
        left = df.toPandas().sort_values(key).reset_index(drop=True)
        right = frames[name].sort_values(key).reset_index(drop=True)
        assert left.equals(right), name


def test_a_failed_check_stops_the_build(spark, sf_dir, tmp_path, prefix):
    raw = {name: RAW[name](spark, sf_dir) for name in STAGED}
    raw["music_charts_historical"] = raw["music_charts_historical"].selectExpr(
        "if(position = 1, null, track_id) as track_id", "* except (track_id)"
    )
    with pytest.raises(QualityError, match="music_charts_historical.track_id not_null"):
        stage(raw, str(tmp_path / "out"), prefix)


def sound(spark, sf_dir):
    """The stand-ins without the rows that break a check."""
    raw = {name: RAW[name](spark, sf_dir) for name in STAGED}
    raw["music_charts"] = raw["music_charts"].filter("daily_rank > 0")
    raw["music_charts_historical"] = raw["music_charts_historical"].filter("track_id is not null and position > 0")
    raw["podcast_charts"] = raw["podcast_charts"].filter("rank > 0")
    return raw


def test_a_failed_check_leaves_every_table(spark, sf_dir, tmp_path, prefix):
    out, raw = str(tmp_path / "out"), sound(spark, sf_dir)
    rows = {name: df.count() for name, df in stage(raw, out, prefix).items()}
    raw["podcast_shows"] = raw["podcast_shows"].limit(10)
    raw["podcast_charts"] = RAW["podcast_charts"](spark, sf_dir)
    with pytest.raises(QualityError, match="podcast_charts.rank positive"):
        stage(raw, out, prefix)
    assert {name: read_table(spark, f"{prefix}staged.{name}").count() for name in rows} == rows


def test_a_failed_write_leaves_every_table(spark, sf_dir, tmp_path, prefix):
    out, raw = str(tmp_path / "out"), sound(spark, sf_dir)
    rows = {name: df.count() for name, df in stage(raw, out, prefix).items()}
    raw["podcast_reviews"] = raw["podcast_reviews"].selectExpr(
        "* except (title)", "if(author_id = '7', raise_error('lost'), title) as title")
    raw["podcast_shows"] = raw["podcast_shows"].limit(10)
    with pytest.raises(Exception, match="lost"):
        stage(raw, out, prefix)
    assert {name: read_table(spark, f"{prefix}staged.{name}").count() for name in rows} == rows


def test_a_daily_refresh_of_a_staged_table(spark, sf_dir, tmp_path, prefix):
    raw = sound(spark, sf_dir)
    stage(raw, str(tmp_path / "out"), prefix)
    before = read_table(spark, f"{prefix}staged.music_charts").groupBy("snapshot_date").count().collect()
    days = sorted(r["snapshot_date"] for r in before)
    one = raw["music_charts"].filter(f"date_from_unix_date(snapshot_date div 86400000000000) = date '{days[3]}'").limit(2)
    refresh_days(one, "music_charts", prefix)
    after = {r["snapshot_date"]: r["count"] for r in
             read_table(spark, f"{prefix}staged.music_charts").groupBy("snapshot_date").count().collect()}
    assert after == {r["snapshot_date"]: r["count"] for r in before} | {days[3]: 2}
    with pytest.raises(QualityError, match="daily_rank positive"):
        refresh_days(one.selectExpr("* except (daily_rank)", "0L as daily_rank"), "music_charts", prefix)
    with pytest.raises(ValueError, match="not partitioned"):
        refresh_days(raw["podcast_shows"], "podcast_shows", prefix)
