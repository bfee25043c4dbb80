import csv
import json
import random
import uuid
from contextlib import contextmanager
from datetime import datetime
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from earshot.operators.filters import FIRST_VALUE
from earshot.session import scratch_folder
from earshot.sources import (
    create_database,
    input_profile,
    load_raw,
    merge_categories,
    publish,
    raw_form,
    raw_path,
    read_csv,
    read_json,
    read_music_charts,
    read_music_charts_historical,
    read_podcast_charts,
    read_podcast_reviews,
    read_podcast_shows,
    read_table,
    read_table_by_month,
    refresh_partitions,
    write_buckets,
    write_table,
)
from earshot.sources.files import typed


def write(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


# ---- CSV ---------------------------------------------------------------------


def test_csv_quotes_newlines_and_null_words(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'name,country,rank\n"He said ""hi""\nline2",NA,1\nNone,US,x\nnull,"",12.0\n')
    got = read_csv(spark, path, {"rank": "bigint"}).collect()
    assert {tuple(r) for r in got} == {
        ('He said "hi"\nline2', None, 1), (None, "US", None), (None, None, 12),
    }
    assert len(got) == 3


@contextmanager
def splits_of(spark, size):
    keys = ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")
    for key, value in zip(keys, (size, 0, 1)):
        spark.conf.set(f"spark.sql.files.{key}", str(value))
    try:
        yield
    finally:
        for key in keys:
            spark.conf.unset(f"spark.sql.files.{key}")


def test_lines_without_spanning_fields_are_read_in_splits(spark, tmp_path):
    path = write(tmp_path / "big.csv", "a,b\n" + '"q ""x""",1\n' * 20000)
    with splits_of(spark, 20000):
        df = read_csv(spark, path, {"b": "bigint"}, spanning=False)
        assert df.select("a", F.spark_partition_id().alias("p")).select("p").distinct().count() > 4
        assert tuple(df.agg(F.count("a"), F.sum("b")).first()) == (20000, 20000)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split_bytes", [40, 10_000_000])
def test_one_result_at_every_split_size(spark, tmp_path, split_bytes, end):
    """Blank lines, doubled and stray quotes, short rows: pandas' rows at any size."""
    rng = random.Random(8)
    lines = ["id,text,more"]
    for i in range(300):
        lines.append(f"{i}," + rng.choice([
            '"lone\rreturn",x', '"two\nlines",x', '"both\r\nends",x', 'plain,"x ""y"" z"', '5" vinyl,x', 'short', '"",x',
        ]))
        lines += rng.choice([[], [], [""], ["   "]])
    path = tmp_path / "a.csv"
    path.write_bytes((end.join(lines) + end).encode())
    expected = pd.read_csv(path, dtype=str, keep_default_na=False, na_values=[""])
    with splits_of(spark, split_bytes):
        got = read_csv(spark, str(path), {"id": "bigint"}).toPandas()
    # where lines end in two characters, so do those in quotes, and both are read as one
    want = [tuple(None if pd.isna(v) else v.replace(end, "\n") for v in r) for r in expected.itertuples(index=False)]
    found = [(str(a), b, c) for a, b, c in got.itertuples(index=False)]
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("more", ["1,x\n", ""])
def test_an_unbalanced_quote_raises_with_its_place(spark, tmp_path, more):
    path = write(tmp_path / "a.csv", "a,b,c\n" + "1,x,y\n" * 50 + '2,"open\n' + more * 50)
    for use in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("b").collect()):
        with pytest.raises(Exception, match=r"unbalanced quote.*a\.csv"):
            use(read_csv(spark, path))


def test_more_fields_than_the_header_raise(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\n1,x\n2,y,z\n")
    with pytest.raises(Exception, match=r"more fields than the header.*a\.csv"):
        read_csv(spark, path).collect()


def test_a_header_of_many_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,"' + "long\n" * 200 + 'name"\n1,x\n')
    got = read_csv(spark, path)
    assert got.columns == ["a", "long\n" * 200 + "name"] and [tuple(r) for r in got.collect()] == [("1", "x")]


def test_no_number_is_cut(spark):
    texts = ["12", "12.0", "12.7", "1e3", "-0.5", "x", None, "9007199254740993", "1e300"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in sorted(frame.select("i", typed(F.col("t"), "bigint")).collect())]
    assert got == [12, 12, None, 1000, None, None, None, 9007199254740993, None]


@pytest.mark.parametrize("split_bytes", [40, 100000])
def test_spanning_records_equal_a_whole_file_read(spark, tmp_path, split_bytes):
    """Records over several lines and splits, against pandas reading the file at once."""
    rng = random.Random(split_bytes)
    folder = tmp_path / "many"
    folder.mkdir()
    frames = []
    for name in ("a", "b"):
        rows = [
            [str(i), "".join(rng.choice(['"', "\n", ",", "x", "yz", " "]) for _ in range(rng.randint(1, 25))) + "."]
            for i in range(60)
        ]
        with open(folder / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\n" if name == "a" else "\r\n")
            writer.writerow(["id", "text"])
            writer.writerows(rows)
        frames.append(pd.read_csv(folder / f"{name}.csv", dtype=str))
    with splits_of(spark, split_bytes):
        got = read_csv(spark, str(folder), {"id": "bigint"}, files="all").toPandas()
    expected = pd.concat(frames)
    assert sorted(zip(got["id"], got["text"])) == sorted(zip(expected["id"].astype(int), expected["text"]))


@pytest.mark.parametrize("split_bytes", [10, 1000])
def test_files_with_another_header_are_refused(spark, tmp_path, split_bytes):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    write(tmp_path / "d" / "a.csv", "x,y\n" + '1,"a\nb"\n' * 50)
    write(tmp_path / "d" / "b.csv", "y,x\n" + '1,"a\nb"\n' * 50)
    try:
        with pytest.raises(Exception, match="another header|CSV header does not conform"):
            read_csv(spark, str(tmp_path / "d"), files="all").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_takes_the_first_file_of_a_folder_or_all(spark, tmp_path):
    write(tmp_path / "d" / "b.csv", "x\n2\n")
    write(tmp_path / "d" / "a.csv", "x\n1\n")
    write(tmp_path / "d" / "notes.txt", "ignored")
    folder = str(tmp_path / "d")
    assert [r.x for r in read_csv(spark, folder, {"x": "bigint"}, files="first").collect()] == [1]
    assert sorted(r.x for r in read_csv(spark, folder, {"x": "bigint"}).collect()) == [1, 2]


def test_csv_columns_go_by_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", "extra,rank,explicit,energy\nfoo,3,True,0.5\n")
    got = read_csv(spark, path, {"rank": "bigint", "explicit": "boolean", "energy": "double"})
    assert got.columns == ["extra", "rank", "explicit", "energy"]
    assert tuple(got.first()) == ("foo", 3, True, 0.5)


# ---- JSON --------------------------------------------------------------------

ROWS = [{"podcast_id": "p1", "rating": 5}, {"podcast_id": "p2", "rating": "4"}]
TYPES = {"podcast_id": "string", "rating": "bigint"}


@pytest.mark.parametrize(
    "text",
    [
        "\n".join(json.dumps(r) for r in ROWS),
        json.dumps(ROWS),
        json.dumps(ROWS, indent=2),
        "\n  " + json.dumps(ROWS, indent=1),
    ],
    ids=["lines", "one-line array", "indented array", "leading space"],
)
def test_json_array_or_lines(spark, tmp_path, text):
    got = read_json(spark, write(tmp_path / "r.json", text), TYPES)
    assert sorted(map(tuple, got.collect())) == [("p1", 5), ("p2", 4)]


@pytest.mark.parametrize("indent", [None, 0, 2, "none"], ids=["line per object", "line per field", "indented", "one line"])
@pytest.mark.parametrize("split_bytes", [30, 500, 1_000_000])
def test_json_array_in_splits_equals_a_whole_read(spark, tmp_path, indent, split_bytes):
    rng = random.Random(7)
    odd = ['"', "\\", "[", "{", "}", "]", ",", "\n", "x", "é"]
    rows = [{"id": i, "text": "".join(rng.choices(odd, k=rng.randint(0, 12))), "tags": [1, {"a": "]"}]} for i in range(40)]
    if indent is None:
        text = "[" + "\n, ".join(json.dumps(r, ensure_ascii=False) for r in rows) + "]\n"
    else:
        text = json.dumps(rows, indent=None if indent == "none" else indent, ensure_ascii=False)
    path = write(tmp_path / "a.json", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        got = read_json(spark, path, {"id": "bigint", "text": "string"}).collect()
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{key}")
    # undeclared fields are kept as the text that stands in the file
    assert sorted((r["id"], r["text"], json.loads(r["tags"])) for r in got) == [
        (r["id"], r["text"], r["tags"]) for r in rows
    ]


@pytest.mark.parametrize("split_bytes", ["10b", "1m"])
def test_broken_arrays_raise(spark, tmp_path, split_bytes):
    path = write(tmp_path / "r.json", '[{"podcast_id": "p1"},\n{"podcast_id" "p2"}]')
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
            read_json(spark, path, TYPES).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ['[{"a": 1}, {"a": "x}]', '[{"a": 1}, {"a": [2}]', '[{"a": 1}'])
@pytest.mark.parametrize("split_bytes", [5, 1_000_000])
def test_unclosed_arrays_raise(spark, tmp_path, text, split_bytes):
    path = write(tmp_path / "r.json", text)
    with splits_of(spark, split_bytes), pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        read_json(spark, path, {"a": "string"}).collect()


def test_empty_array(spark, tmp_path):
    assert read_json(spark, write(tmp_path / "r.json", " []\n"), TYPES).count() == 0


def test_categories_file_without_the_key_is_not_joined(spark, tmp_path):
    write(tmp_path / "podcasts.json", json.dumps([{"podcast_id": "p1", "title": "T", "itunes_id": 1}, {"podcast_id": None}]))
    write(tmp_path / "categories.json", json.dumps([{"id": "p1", "category": "c"}]))
    got = read_podcast_shows(spark, str(tmp_path))
    assert "category" not in got.columns and got.count() == 2


def test_broken_json_raises(spark, tmp_path):
    path = write(tmp_path / "r.json", json.dumps(ROWS[0]) + "\n{broken\n")
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        read_json(spark, path, TYPES).collect()


# ---- datasets -----------------------------------------------------------------


@pytest.mark.parametrize(
    "reader, name",
    [
        (read_music_charts, "music charts"),
        (read_music_charts_historical, "historical music charts"),
        (read_podcast_charts, "podcast charts"),
        (read_podcast_shows, "podcast shows"),
        (read_podcast_reviews, "podcast reviews"),
    ],
)
def test_missing_input_names_the_dataset(spark, tmp_path, reader, name):
    with pytest.raises(FileNotFoundError, match=name):
        reader(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError, match=name):
        reader(spark, str(tmp_path / "empty"))


def test_music_charts_reader(spark, tmp_path):
    write(
        tmp_path / "c" / "charts.csv",
        "spotify_id,name,country,snapshot_date,is_explicit,popularity\n"
        "t1,One,,2024-05-01,True,90\nt2,Two,NA,2021-05-01,False,80\nt3,Three,US,oops,False,70\n",
    )
    got = read_music_charts(spark, str(tmp_path / "c")).collect()
    assert [(r.spotify_id, r.country, r.snapshot_date, r.is_explicit, r.popularity) for r in got] == [
        ("t1", None, datetime(2024, 5, 1), True, 90)
    ]


def test_layout_comes_from_the_first_row_of_the_file(spark, tmp_path):
    """Records over several lines are regrouped in no order; the head keeps it."""
    rows = "".join(f'"a\n{i}",{"2024-05-01" if i < 3 else "2024/05/01"}\n' for i in range(200))
    write(tmp_path / "c" / "x.csv", "name,date\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert read_music_charts_historical(spark, str(tmp_path / "c"), layouts=FIRST_VALUE).count() == 3
        assert read_music_charts_historical(spark, str(tmp_path / "c")).count() == 200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_podcast_charts_reader(spark, tmp_path):
    write(tmp_path / "c" / "x.csv", "date,rank,show.name,show.total_episodes\n2024-09-01,1,A,10.0\n2030-01-01,2,B,\n")
    got = read_podcast_charts(spark, str(tmp_path / "c"))
    assert got.columns == ["date", "rank", "show_name", "show_total_episodes"]
    assert [(r["rank"], r.show_name, r.show_total_episodes) for r in got.collect()] == [(1, "A", 10.0)]


def test_podcast_charts_without_a_date_keep_all_rows(spark, tmp_path):
    write(tmp_path / "c" / "x.csv", "day,rank\n2030-01-01,2\n,3\n")
    assert read_podcast_charts(spark, str(tmp_path / "c")).count() == 2


def test_shows_with_and_without_categories(spark, tmp_path):
    show = {"podcast_id": "p1", "itunes_id": "7", "title": "T", "ratings_count": 12}
    write(tmp_path / "s" / "podcasts.json", json.dumps([show]))
    alone = read_podcast_shows(spark, str(tmp_path / "s"))
    assert "category" not in alone.columns and alone.first().ratings_count == "12"
    categories = [{"podcast_id": "p1", "itunes_id": 7, "category": c} for c in "ab"]
    write(tmp_path / "s" / "categories.json", "\n".join(map(json.dumps, categories)))
    both = read_podcast_shows(spark, str(tmp_path / "s"))
    assert sorted((r.itunes_id_x, r.itunes_id_y, r.category) for r in both.collect()) == [(7, 7, "a"), (7, 7, "b")]


def test_categories_without_the_key_are_not_joined(spark):
    shows = spark.createDataFrame([("p",)], "podcast_id string")
    assert merge_categories(shows, spark.createDataFrame([("a",)], "category string")) is shows
    assert merge_categories(shows, None) is shows


def test_reviews_reader_keeps_the_instant(spark, tmp_path):
    reviews = [{"podcast_id": "p", "rating": 5, "created_at": t} for t in
               ("2022-01-01T00:00:00-07:00", "2021-12-31T23:00:00-07:00", "bad")]
    write(tmp_path / "r" / "reviews.json", "\n".join(map(json.dumps, reviews)))
    got = raw_form(read_podcast_reviews(spark, str(tmp_path / "r"))).collect()
    assert [r.created_at for r in got] == [int(datetime(2022, 1, 1, 7).timestamp()) * 10**9]


def test_an_array_has_no_first_row(spark, tmp_path):
    write(tmp_path / "r" / "reviews.json", json.dumps([{"created_at": "2024-01-01"}]))
    with pytest.raises(ValueError, match="layouts"):
        read_podcast_reviews(spark, str(tmp_path / "r"), layouts=FIRST_VALUE)


def test_input_profile(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert tuple(input_profile(df, "d").first()) == ("d", 2, 2, "a,b")


# ---- tables -------------------------------------------------------------------


@pytest.fixture
def database(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex
    yield create_database(spark, name, str(tmp_path / "tables"))
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_nanosecond_parquet_is_read_as_bigint(spark, tmp_path, database):
    path = str(tmp_path / "n.parquet")
    pq.write_table(pa.table({"t": pa.array([1735639200123456789, None], pa.timestamp("ns"))}), path)
    got = read_table(spark, path)
    assert got.dtypes == [("t", "bigint")]
    assert load_raw(spark, path, f"{database}.raw") == 2
    assert [r.t for r in read_table(spark, f"{database}.raw").collect()] == [1735639200123456789, None]
    # a table is a source too
    assert load_raw(spark, f"{database}.raw", f"{database}.again") == 2


def test_raw_layout():
    assert raw_path("s3a://lake/", "podcast_shows") == "s3a://lake/raw/podcast_reviews/podcast_shows.parquet"


def test_write_replaces_and_returns_the_table(spark, tmp_path, database):
    name = f"{database}.t"
    write_table(spark.range(5).selectExpr("id as a", "1 as b"), name, ["a"])
    got = write_table(spark.createDataFrame([(9, 1)], "a bigint, b int"), name, ["a"])
    assert got.columns == ["a", "b"] and [tuple(r) for r in got.collect()] == [(9, 1)]
    assert [r.a for r in spark.sql(f"select a from {name}").collect()] == [9]


def test_other_columns_or_layout_define_the_table_anew(spark, database):
    name = f"{database}.t"
    write_table(spark.range(5), name)
    write_table(spark.range(3).selectExpr("id % 2 as day", "cast(id as string) as v"), name, ["day"])
    assert sorted(map(tuple, read_table(spark, name).select("day", "v").collect())) == [(0, "0"), (0, "2"), (1, "1")]
    write_table(spark.range(2).selectExpr("id as day", "'x' as v"), name)
    assert read_table(spark, name).columns == ["day", "v"]


def test_a_failed_write_leaves_the_table(spark, tmp_path, database):
    name, folder = f"{database}.t", str(tmp_path / "elsewhere" / "t.parquet")
    write_table(spark.range(5), name, folder=folder)
    with pytest.raises(Exception, match="lost"):
        write_table(spark.range(7).selectExpr("if(id = 6, raise_error('lost'), id) as id"), name, folder=folder)
    assert read_table(spark, name).count() == 5
    # a table can be replaced by what is computed from it
    write_table(read_table(spark, name).filter("id > 1"), name, folder=folder)
    assert read_table(spark, name).count() == 3


def test_a_running_reader_keeps_its_version(spark, tmp_path, database):
    name = f"{database}.t"
    for rows in (5, 6, 7, 8):
        write_table(spark.range(rows), name)
    open_reader = read_table(spark, name)
    write_table(spark.range(2), name)
    assert open_reader.count() == 8 and read_table(spark, name).count() == 2
    assert len(list((tmp_path / "tables" / "t").glob("version-*"))) == 2


def test_a_missing_table_is_an_error(spark, database):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        read_table(spark, f"{database}.nothing")


def test_names_with_dots(spark, database):
    df = raw_form(spark.sql("select 1 as `a.b`, timestamp '2024-01-01' as `c.d`"))
    assert write_table(df, f"{database}.t").columns == ["a.b", "c.d"]
    assert read_table(spark, f"{database}.t").columns == ["a.b", "c.d"]


def test_replace_is_whole_even_with_dynamic_overwrite_on(spark, database):
    name = f"{database}.t"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(spark.createDataFrame([(1, "x"), (2, "y")], "d int, v string"), name, ["d"])
        write_table(spark.createDataFrame([(2, "z")], "d int, v string"), name, ["d"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [tuple(r) for r in read_table(spark, name).select("d", "v").collect()] == [(2, "z")]


def test_a_refresh_rewrites_only_the_days_it_holds(spark, tmp_path, database):
    name = f"{database}.t"
    days = spark.range(40).selectExpr("id % 4 as v", "date_add(date '2024-01-01', cast(id % 4 as int)) as day")
    write_table(days, name, ["day"], ["v"])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "tables" / "t").rglob("*.parquet")}
    again = spark.createDataFrame([(7, "2024-01-02"), (9, "2024-02-01")], "v bigint, day string").selectExpr("v", "date(day) as day")
    got = refresh_partitions(again, name, ["day"], ["v"])
    counts = {str(r["day"]): (r["n"], r["s"]) for r in got.groupBy("day").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert counts == {"2024-01-01": (10, 0), "2024-01-02": (1, 7), "2024-01-03": (10, 20), "2024-01-04": (10, 30),
                      "2024-02-01": (1, 9)}
    assert read_table(spark, name).count() == 32
    left = {p: p.stat().st_mtime_ns for p in (tmp_path / "tables" / "t").rglob("*.parquet")}
    assert all(left.get(p) == t for p, t in files.items() if "2024-01-02" not in str(p))
    assert not [p for p in files if "2024-01-02" in str(p) and p in left]
    with pytest.raises(Exception, match="lost"):
        refresh_partitions(again.selectExpr("if(v = 9, raise_error('lost'), v) as v", "day"), name, ["day"])
    assert read_table(spark, name).count() == 32
    with pytest.raises(ValueError, match="columns"):
        refresh_partitions(again.withColumn("w", F.lit(1)), name, ["day"])
    # the next whole replacement is as ever
    write_table(days.filter("v = 1"), name, ["day"], ["v"])
    assert read_table(spark, name).count() == 10


def test_buckets_save_the_shuffle(spark, database):
    name = f"{database}.b"
    rows = spark.range(1000).selectExpr("cast(id % 37 as string) as k", "id as v").repartition(5)
    for factor in (1, 2):
        publish(write_buckets(rows.withColumn("v", F.col("v") * factor), name, "k", 4))
        got = read_table(spark, name).groupBy("k").agg(F.sum("v").alias("s"))
        assert "Exchange" not in got._jdf.queryExecution().toString()
        assert {r.k: r.s for r in got.collect()} == {str(k): factor * sum(range(k, 1000, 37)) for k in range(37)}
    joined = read_table(spark, name).join(read_table(spark, name).groupBy("k").count().hint("merge"), "k")
    assert "Exchange" not in joined._jdf.queryExecution().toString() and joined.count() == 1000


def test_hot_partition_is_split_and_files_are_clustered(spark, tmp_path, database):
    """One day holds most rows: it becomes several files, each sorted."""
    name, path = f"{database}.t", tmp_path / "tables" / "t"
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50000")
    try:
        source = spark.range(0, 60000, 1, 16).selectExpr(
            "if(id % 3 < 2, 0, id % 5) as day", "cast(id % 70 as string) as country", "uuid() as v"
        )
        write_table(source, name, ["day"], ["country"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = sorted(path.glob("version-*/day=0/*.parquet"))
    assert len(files) > 3
    assert len(list(path.glob("version-*/day=*"))) == 5
    for file in files:
        countries = pq.read_table(file, partitioning=None)["country"].to_pylist()
        assert countries == sorted(countries)
    assert read_table(spark, name).count() == 60000


def test_partition_pruning_by_day_and_month(spark, database):
    name = f"{database}.t"
    source = spark.range(40).selectExpr("date_add(date '2024-01-01', cast(id as int)) as day", "id")
    write_table(source, name, ["day"])
    for condition in ("day >= date '2024-02-01'", "date_format(day, 'yyyy-MM') = '2024-02'"):
        df = read_table(spark, name).filter(condition)
        plan = df._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(date_format" in plan
        assert df.count() == 9


def test_read_by_month_is_sorted(spark, database):
    months = [(f"20{y:02d}-{m:02d}",) for y in (24, 22, 23) for m in (5, 1, 12)]
    write_table(spark.createDataFrame(months, "trend_month string").repartition(4), f"{database}.t")
    got = [r.trend_month for r in read_table_by_month(spark, f"{database}.t").collect()]
    assert got == sorted(got) and len(got) == 9


def test_scratch_is_below_the_folder_the_session_names(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_folder(spark, "x")
    if base:
        assert path.startswith(base)
    assert path != scratch_folder(spark, "x")
