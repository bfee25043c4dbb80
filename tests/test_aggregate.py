import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from earshot.operators import (
    QualityError,
    aggregate_with_distincts,
    count_where,
    distinct_values,
    enforce,
    group_known,
    mean,
    one_row_of_totals,
    one_row_per_key,
    quality_report,
    row_count,
    share_where,
    top_ascending,
    total,
    value_at_largest,
    with_place,
)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_distincts_equal_count_distinct(spark):
    """NULL keys and values, a group and a value with a third of the rows each."""
    rng = random.Random(5)
    data = [
        (
            "hot" if rng.random() < 0.33 else rng.choice(["a", "b", None]),
            "same" if rng.random() < 0.33 else rng.choice([None, *map(str, range(50))]),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, 0.5, 1.5, float("nan")]),
        )
        for _ in range(5000)
    ] + [("empty", None, None, None)]
    df = spark.createDataFrame(data, "k string, s string, n int, v double").repartition(6)
    got = aggregate_with_distincts(
        df,
        keys={"key": F.col("k")},
        measures=[row_count("c"), mean("v", 3, "m", 2), total("n", "t"), count_where(F.col("n") == 2, "two"),
                  share_where(F.col("n") == 2, 4, "share")],
        distincts={"dn": "n", "ds": "s"},
    )
    expected = {}
    for key in {row[0] for row in data}:
        own = [row for row in data if row[0] == key]
        values = [Fraction(row[3]) for row in own if row[3] is not None and row[3] == row[3]]
        numbers = [row[2] for row in own if row[2] is not None]
        expected[key] = (
            len({row[2] for row in own} - {None}), len({row[1] for row in own} - {None}), len(own),
            half_up(sum(values) / len(values) / 2, 3) if values else None, sum(numbers) if numbers else None,
            numbers.count(2), half_up(Fraction(numbers.count(2), len(own)), 4),
        )
    assert got.columns == ["key", "dn", "ds", "c", "m", "t", "two", "share"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected


def half_up(value: Fraction, digits: int) -> float:
    return int(value * 10**digits + Fraction(1, 2)) / 10**digits


def test_means_do_not_depend_on_partitions(spark):
    # 0.0925 is the mean in any order; the last bits of a sum of doubles are not
    values = [0.09, 0.095] * 500
    for parts in (1, 3, 8):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").repartition(parts)
        for distincts in ({}, {"n": "i"}):
            got = aggregate_with_distincts(frame, {"k": F.lit(1)}, [mean("v", 3, "m")], distincts)
            assert got.first()["m"] == 0.093


def test_one_scan_however_many_distincts(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    got = aggregate_with_distincts(
        df,
        keys={"flag": F.col("l_returnflag")},
        measures=[mean("l_quantity", 2, "q")],
        distincts={"suppliers": "l_suppkey", "parts": "l_partkey"},
    )
    physical = got._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert physical.count("FileScan parquet") == 1
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_returnflag:string>" in physical


def test_aggregate_without_distincts(spark):
    got = aggregate_with_distincts(spark.range(4), {"even": F.col("id") % 2 == 0}, [row_count("n"), total("id", "s")])
    assert rows(got) == ["(False, 2, 4)", "(True, 2, 2)"]


def test_places_over_many_ranges(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("v"), (F.col("id") % 3).alias("w")).repartition(7)
    got = with_place(df, F.desc("v"), name="place")
    assert got.columns == ["v", "w", "place"] and dict(got.dtypes)["place"] == "bigint"
    assert sorted((r.place, r.v) for r in got.collect()) == [(i + 1, 999 - i) for i in range(1000)]
    tied = with_place(spark.range(100).select(F.lit(None).cast("int").alias("x")), "x")
    assert sorted(r.position for r in tied.collect()) == list(range(1, 101))
    assert with_place(df.limit(0), "v").count() == 0


def test_place_has_no_task_with_all_rows(spark):
    got = with_place(spark.range(100).repartition(4), "id")
    assert "SinglePartition" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([("a", 3), ("b", 3), ("c", 1)], "b"),
        ([("a", None), ("b", None)], "b"),
        ([("a", None), ("b", 3)], "b"),
        ([("a", 3), ("b", None)], "a"),
    ],
)
def test_value_at_largest(spark, pairs, expected):
    df = spark.createDataFrame(pairs, "x string, y int")
    assert df.agg(value_at_largest("x", "y")).first()[0] == expected


def test_group_known_drops_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(group_known(df, "k", F.max("v").alias("v"))) == ["('a', 1)"]


def test_top_puts_missing_first_and_shows_ascending(spark):
    df = spark.createDataFrame([("a", 3), ("b", None), ("c", 1)], "k string, v int")
    assert [tuple(r) for r in top_ascending(df, "v", "k", n=2).collect()] == [("a", 3), ("b", None)]


def test_top_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(k, 1) for k in "dbca"], "k string, v int")
    assert [r.k for r in top_ascending(df, "v", "k", n=3).collect()] == ["b", "c", "d"]


def test_totals_of_several_tables(spark):
    a = spark.createDataFrame([(1,), (None,)], "x int")
    b = spark.createDataFrame([], "y double")
    got = one_row_of_totals([
        (a, [F.coalesce(F.sum("x"), F.lit(0)).alias("sx")]),
        (b, [F.coalesce(F.sum("y"), F.lit(0)).alias("sy"), F.avg("y").alias("ay")]),
    ])
    assert [tuple(r) for r in got.collect()] == [(1, 0.0, None)]


def test_distinct_values_and_one_row_per_key(spark):
    df = spark.createDataFrame([("m", 1, "x"), ("m", 1, "y"), ("n", 2, "x"), (None, 3, "x")], "k string, v int, c string")
    assert rows(distinct_values(df, "k")) == ["('m',)", "('n',)"]
    assert rows(one_row_per_key(df, "k", ["v"])) == ["('m', 1)", "('n', 2)", "(None, 3)"]


def test_quality_report_and_enforce(spark):
    df = spark.createDataFrame([(None, 0), ("t", 1), ("u", None)], "track_id string, rank int")
    report = quality_report(df, "charts", {"track_id": ["not_null"], "rank": ["positive"]})
    assert sorted(map(tuple, report.collect())) == [
        ("charts", "rank", "positive", 1, False),
        ("charts", "track_id", "not_null", 1, False),
    ]
    with pytest.raises(QualityError, match="charts.rank positive: 1 rows; charts.track_id not_null: 1 rows"):
        enforce(report)
    enforce(quality_report(df.filter("rank = 1"), "charts", {"track_id": ["not_null"], "rank": ["positive"]}))


def test_unknown_check(spark):
    with pytest.raises(ValueError, match="unknown check"):
        quality_report(spark.range(1), "t", {"id": ["unique"]})
